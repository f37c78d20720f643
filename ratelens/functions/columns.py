"""Scalar column builders (P1-P12, P32-P40): all native Spark expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contracts as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_bucket(amount: str | Column = "amount_usd") -> Column:
    """Chained thresholds; null, NaN and >= 500 fall to the last label."""
    a = col(amount)
    expr = None
    for label, upper in C.AMOUNT_BUCKETS:
        if upper is None:
            return expr.otherwise(F.lit(label))
        cond = a < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def hour_bucket(hour: str | Column = "hour_of_day") -> Column:
    """Half-open hour ranges; anything else (incl. null) is late night."""
    h = col(hour)
    expr = None
    for label, lo, hi in C.HOUR_BUCKETS:
        if lo is None:
            return expr.otherwise(F.lit(label))
        cond = (h >= F.lit(lo)) & (h < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def half_labels(split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> tuple[str, str]:
    return f"weeks_1_{split_week}", f"weeks_{split_week + 1}_{n_weeks}"


def period_half(week: str | Column = "week_number", split_week: int = C.SPLIT_WEEK,
                n_weeks: int = C.N_WEEKS) -> Column:
    """Week <= split -> baseline half, everything else (incl. null) -> current half."""
    first, second = half_labels(split_week, n_weeks)
    return F.when(col(week) <= F.lit(split_week), F.lit(first)).otherwise(F.lit(second))


def week_label(week: str | Column = "week_number") -> Column:
    """P40: 'week_<n>'; a null week gives a null label (the row is in no weekly period)."""
    return F.concat(F.lit("week_"), col(week).cast("string"))


def week_index(ts: str | Column, start: str, period_days: int) -> Column:
    """1-based period index of a timestamp counted from ``start``."""
    days = F.datediff(col(ts).cast("date"), F.lit(start).cast("date"))
    return (F.floor(days / F.lit(period_days)) + F.lit(1)).cast("int")


def is_approved(status: str | Column = "status") -> Column:
    """P11 as a boolean; a null status is not approved."""
    return F.coalesce(col(status) == F.lit(C.STATUS_APPROVED), F.lit(False))


def approved_flag(status: str | Column = "status") -> Column:
    """1/0."""
    return is_approved(status).cast("long")


def safe_rate(approved: str | Column, total: str | Column) -> Column:
    """Approved / total, 0.0 when total is 0 or null."""
    return F.coalesce(F.try_divide(col(approved).cast("double"), col(total).cast("double")), F.lit(0.0))


MONEY_SCALE = 4  # money is summed exactly in integer units of 1e-4 USD


def money_units(amount: str | Column, scale: int = MONEY_SCALE) -> Column:
    """Amount as a long count of 10^-scale units (exact, order-independent sums).

    Long sums stay on Spark's fast aggregation path on raw rows. A null amount
    adds nothing; an amount that no long can hold (NaN, infinity, beyond 2^63
    units) raises, in any session, so no amount ever leaves a sum unnoticed.
    """
    units = F.round(col(amount) * F.lit(float(10 ** scale)), 0)
    problem = F.raise_error(F.concat(F.lit("amount cannot be summed exactly: "), col(amount).cast("string")))
    return (F.when(F.abs(units) < F.lit(2.0 ** 63), units.cast("long"))
            .when(units.isNotNull(), problem.cast("long")))


def money_units_to_double(units: str | Column, scale: int = MONEY_SCALE) -> Column:
    """Summed units back to USD; an all-null sum is 0.0 (polars semantics)."""
    return F.coalesce(col(units).cast("double") / F.lit(float(10 ** scale)), F.lit(0.0))


def rate_band(rate: str | Column = "approval_rate") -> Column:
    """Colour band of a rate."""
    r = col(rate)
    return (F.when(r >= F.lit(C.RATE_GREEN_THRESHOLD), F.lit("green"))
            .when(r >= F.lit(C.RATE_YELLOW_THRESHOLD), F.lit("yellow"))
            .otherwise(F.lit("red")))


def sql_literal(v) -> str:
    """A Python scalar as Spark SQL literal text."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(mapping: dict) -> Column:
    """A literal MAP built in one SQL expression (one JVM call, not one per entry)."""
    body = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in mapping.items())
    return F.expr(f"map({body})")


def lookup(mapping: dict, key: str | Column, default) -> Column:
    """Dictionary lookup with default (P21-P23, P26) as a literal map."""
    return F.coalesce(F.try_element_at(map_literal(mapping), col(key)), F.lit(default))


def severity(impact: str | Column = "estimated_revenue_impact_usd") -> Column:
    """P25: strict thresholds on monthly impact."""
    x = col(impact)
    expr = None
    for label, thr in C.SEVERITY_THRESHOLDS:
        cond = x > F.lit(float(thr))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.SEVERITY_DEFAULT))


def pattern_flags(country: str = C.PATTERN_HOT_COUNTRY, issuer: str = C.PATTERN_HOT_ISSUER,
                  high_value: float = C.PATTERN_HIGH_VALUE_USD, evening_hour: int = C.PATTERN_EVENING_HOUR,
                  split_week: int = C.SPLIT_WEEK) -> dict[str, Column]:
    """The planted-pattern predicates as boolean columns (null -> false)."""
    return {
        "is_hot_issuer": F.coalesce((F.col("country") == F.lit(country)) & (F.col("issuer_bank") == F.lit(issuer)),
                                    F.lit(False)),
        "is_high_value": F.coalesce(F.col("amount_usd") > F.lit(high_value), F.lit(False)),
        "is_evening": F.coalesce(F.col("hour_of_day") >= F.lit(evening_hour), F.lit(False)),
        "is_early": F.coalesce(F.col("week_number") <= F.lit(split_week), F.lit(False)),
    }


def rounded_ratio(num: str | Column, den: str | Column, decimals: int = 4) -> Column:
    """round(num / den, d) half-up on the exact ratio of two non-negative counts; 0.0 if den is 0.

    Integer arithmetic, so every engine gets the same digits (P10).
    """
    n, d = col(num).cast("long"), col(den).cast("long")
    unit = 10 ** decimals
    top = n * F.lit(2 * unit) + d
    bottom = F.greatest(d * F.lit(2), F.lit(2).cast("long"))  # never 0; d = 0 is masked below
    q = F.call_function("div", top, bottom)  # integral: exact beyond 2^53 too
    return F.when(d > 0, q / F.lit(float(unit))).otherwise(F.lit(0.0))
