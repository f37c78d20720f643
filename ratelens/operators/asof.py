"""X2 with the history as of each transaction, and X3 on a dense time axis.

``risk_score_asof`` scores a transaction by what was known before its day: no row of its own day or later ever
counts. Rows are counted once per group and day; a group's days are filled up to a dense series (days
times groups, which grow with the dimensions and the calendar, not with the rows), and running sums give
every day's history. Rates back off from the narrowest level to the next wider one, each smoothed by a prior whose
weight is estimated, day by day, from how much the groups' rates differ beyond chance (the intraclass
correlation of a beta-binomial, by moments): groups that are alike are shrunk strongly, different ones
speak for themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_approved, safe_rate
from ..session import cut_lineage

#: Levels from wide to narrow; each one's dimensions include the one before.
LEVELS = (("country",), ("country", "issuer_bank"))
#: Bounds of a prior's weight in transactions; groups that do not differ take the upper one.
WEAKEST, STRONGEST = 1.0, 10_000.0


def _fill(spine: DataFrame, counted: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows of ``spine`` with the counts n and k of ``counted``, null where it has none; null keys match."""
    named = counted.select(*(F.col(c).alias(f"_{c}") for c in keys), "n", "k")
    return spine.join(named, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys], "left").select(*keys, "n", "k")


def _dense_history(df: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    """(dims, day, n, k): transactions and approvals of the group on all days before ``day``."""
    daily = df.where(F.col("timestamp").isNotNull()).groupBy(*dims, F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_approved()).alias("k"))
    daily = cut_lineage(daily, "daily-history")
    bounds = daily.agg(F.struct(F.min("day").alias("a"), F.max("day").alias("b")).alias("s")).scalar()
    spine = daily.select(*dims).distinct().withColumn(
        "day", F.explode(F.sequence(bounds.getField("a"), bounds.getField("b"), F.expr("interval 1 day"))))
    filled = _fill(spine, daily, (*dims, "day"))
    before = Window.partitionBy(*dims).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return filled.select(*dims, "day", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("n", "k")))


def prior_weight(n_groups: Column, n: Column, k: Column, squares: Column, spread: Column) -> Column:
    """Weight of the prior from additive sums over groups: ``n_groups`` with history, transactions ``n``,
    approvals ``k``, ``squares`` the sum of n_g^2 and ``spread`` the sum of k_g^2 / n_g."""
    n, k = n.cast("double"), k.cast("double")
    variance = k / n * (F.lit(1.0) - k / n)
    excess = F.try_divide(spread - k * k / n, variance) - (n_groups - 1)
    rho = F.try_divide(excess, n - squares / n - (n_groups - 1))
    weight = F.when((n > 0) & (variance > 0) & (rho > 0), (F.lit(1.0) - rho) / rho).otherwise(F.lit(STRONGEST))
    return F.least(F.greatest(weight, F.lit(WEAKEST)), F.lit(STRONGEST))


def risk_history(df: DataFrame, levels=LEVELS) -> DataFrame:
    """(dims of the narrowest level, day, hist_n, hist_approved, expected_approval) for all days and groups."""
    narrow = levels[-1]
    deepest = cut_lineage(_dense_history(df, narrow), "risk-days")

    def sums(dims):
        return deepest.groupBy(*dims, "day").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    overall = sums(())
    expected = overall.select("day", ((F.col("k") + 1.0) / (F.col("n") + 2.0)).alias("p"))
    above: tuple[str, ...] = ()
    for dims in levels:
        group = deepest if dims == narrow else sums(dims)
        double = F.col("n").cast("double")
        weights = group.groupBy("day").agg(
            F.count_if(F.col("n") > 0).alias("g"), F.sum("n").alias("n"), F.sum("k").alias("k"),
            F.sum(double * double).alias("s2"), F.sum(F.try_divide(F.col("k").cast("double") * F.col("k"), double)).alias("sp"))
        weights = weights.select("day", F.when(F.col("n") > 0, prior_weight(
            F.col("g"), F.col("n"), F.col("k"), F.col("s2"), F.coalesce(F.col("sp"), F.lit(0.0)))).otherwise(F.lit(STRONGEST)).alias("w"))
        wider = expected.select(*(F.col(d).alias(f"_{d}") for d in above), F.col("day").alias("_day"), "p")
        group = group.join(weights, "day")
        group = group.join(wider, [group[d].eqNullSafe(wider[f"_{d}"]) for d in above] + [group["day"] == wider["_day"]])
        group = group.select(*dims, "day", "n", "k", ((F.col("k") + F.col("w") * F.col("p")) / (F.col("n") + F.col("w"))).alias("p"))
        expected, above = group.select(*dims, "day", "p"), dims
    return group.select(*narrow, "day", F.col("n").alias("hist_n"), F.col("k").alias("hist_approved"),
                        F.col("p").alias("expected_approval"))


def risk_score_asof(df: DataFrame, levels=LEVELS) -> DataFrame:
    """Every transaction with hist_n, hist_approved (its narrowest group before its day), expected_approval
    and risk_score = 1 - expected_approval.

    A transaction without a timestamp has no history: 0, 0 and an expectation of one half.
    """
    narrow = levels[-1]
    history = cut_lineage(risk_history(df, levels), "risk-asof")
    known = history.select(*(F.col(d).alias(f"_{d}") for d in narrow), F.col("day").alias("_day"),
                           "hist_n", "hist_approved", "expected_approval")
    rows = df.select("transaction_id", *narrow, F.to_date("timestamp").alias("day"))
    on = [rows[d].eqNullSafe(known[f"_{d}"]) for d in narrow] + [rows["day"] == known["_day"]]
    zero = F.lit(0).cast("long")
    expected = F.coalesce("expected_approval", F.lit(0.5))
    return rows.join(known, on, "left").select(
        "transaction_id", *narrow, F.coalesce("hist_n", zero).alias("hist_n"), F.coalesce("hist_approved", zero).alias("hist_approved"),
        expected.alias("expected_approval"), (F.lit(1.0) - expected).alias("risk_score"))


def dense_hourly_rates(df: DataFrame, dims: list[str], unit: str = "hour") -> DataFrame:
    """X3 on a dense axis: a row per value of ``dims`` and hour (or other unit) from the first to the
    last of the table; hours without traffic have counts 0 and a null rate.

    Rows without a timestamp are in no hour. The spine is made per dimension value from the
    counted table's bounds, so the result grows with the calendar and the dimensions alone.
    """
    at = F.date_trunc(unit, F.col("timestamp"))
    counted = cut_lineage(df.where(F.col("timestamp").isNotNull()).groupBy(*dims, at.alias("at")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_approved()).alias("k")), "hourly")
    bounds = counted.agg(F.struct(F.min("at").alias("a"), F.max("at").alias("b")).alias("s")).scalar()
    spine = counted.select(*dims).distinct().withColumn(
        "at", F.explode(F.sequence(bounds.getField("a"), bounds.getField("b"), F.expr(f"interval 1 {unit}"))))
    n, k = (F.coalesce(c, F.lit(0).cast("long")) for c in ("n", "k"))
    return _fill(spine, counted, (*dims, "at")).select(
        *dims, F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("bucket"),
        n.alias("total_transactions"), k.alias("approved_transactions"), F.when(n > 0, safe_rate(k, n)).alias("approval_rate"))
