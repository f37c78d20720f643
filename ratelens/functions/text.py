"""Text builders for insights and views.

Numbers are rounded half-up to an integer count of units first and then
printed with integer arithmetic, so the text does not depend on how an engine
rounds binary ties when it formats a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contracts as C
from .columns import col, lookup


def scaled_int(x: str | Column, decimals: int) -> Column:
    """round(x * 10^d) as a long (half away from zero)."""
    return F.round(col(x) * F.lit(float(10 ** decimals)), 0).cast("long")


def fixed(x: str | Column, decimals: int, grouping: bool = False, plus: bool = False) -> Column:
    """Like Python's f"{x:[+][,].{d}f}" for finite x, half-up on the decimal digit."""
    n = scaled_int(x, decimals)
    a = F.abs(n)
    unit = 10 ** decimals
    whole = a if decimals == 0 else F.call_function("div", a, F.lit(unit))
    whole_txt = F.format_number(whole, 0) if grouping else whole.cast("string")
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit("+" if plus else ""))
    if decimals == 0:
        return F.concat(sign, whole_txt)
    frac = F.lpad((a % F.lit(unit)).cast("string"), decimals, "0")
    return F.concat(sign, whole_txt, F.lit("."), frac)


def segment_label(key: str | Column = "segment_key") -> Column:
    """Human label of a segment key, default the key itself."""
    k = col(key)
    return F.coalesce(lookup(C.SEGMENT_LABELS, k, None), k)


# FIXED VALUES: the sentences of titles and descriptions must equal the
# reference's.

def insight_title(key="segment_key", rate_change="rate_change") -> Column:
    """P27."""
    rc = col(rate_change)
    pp = fixed(F.abs(rc) * F.lit(100.0), 0)
    label = segment_label(key)
    return F.when(rc < 0, F.concat(label, F.lit(" Approval Rate Collapsed ("), pp, F.lit("pp Drop)"))) \
        .otherwise(F.concat(label, F.lit(" Approval Rate Anomaly ("), pp, F.lit("pp Change)")))


def insight_description(key="segment_key", baseline="baseline_rate", current="current_rate",
                        rate_change="rate_change", impact="estimated_revenue_impact_usd",
                        affected="affected_transactions", p_value="p_value", z_score="z_score", split_week: int = C.SPLIT_WEEK) -> Column:
    """P28; ``split_week`` is the last week of the baseline half."""
    rc = col(rate_change)
    direction = F.when(rc < 0, F.lit("dropped")).otherwise(F.lit("rose"))
    return F.concat(
        segment_label(key), F.lit("'s approval rate "), direction, F.lit(" from "),
        fixed(col(baseline) * F.lit(100.0), 1), F.lit("% to "),
        fixed(col(current) * F.lit(100.0), 1), F.lit(f"% starting Week {split_week + 1}, a "),
        fixed(F.abs(rc) * F.lit(100.0), 1), F.lit("pp shift affecting "),
        F.format_number(col(affected).cast("long"), 0),
        F.lit(f" transactions per {split_week}-week period. Estimated monthly revenue impact: $"),
        fixed(impact, 0, grouping=True),
        F.lit(". Statistical significance: p="), fixed(p_value, 4),
        F.lit(", z="), fixed(z_score, 2), F.lit("."))
