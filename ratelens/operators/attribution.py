"""A10 without double counting: each transaction's impact charged to one insight.

The reference's summary adds the impacts of insights whose segments overlap (a country, its issuers,
their brands), so a transaction counts several times. Here a greedy weighted cover takes, in turn, the insight
that still explains the most, and charges it the transactions of its segment that none before it has.

An insight's impact is linear in its current amount (amount / weeks * |rate change| * weeks a month),
so a part of its transactions carries that part of its impact. One pass over the current rows counts, per
combination of insights that contain a row, rows and money; the cover then works on these combinations,
at most 2**k of them for k insights, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import half_labels, money_units, sql_literal
from ..session import cut_lineage
from .segments import _definitions, _key_sql

MAX_INSIGHTS = 16
UNIT = 1e-4


def disjoint_impact(enriched: DataFrame, insights: DataFrame, weeks_per_period: float = C.WEEKS_PER_PERIOD,
                    weeks_per_month: float = C.WEEKS_PER_MONTH, split_week: int = C.SPLIT_WEEK,
                    n_weeks: int = C.N_WEEKS) -> DataFrame:
    """A row per insight: step (the order of the cover), segment_type, segment_key, charged_transactions,
    charged_impact_usd (disjoint) and full_impact_usd (as the reference counts it).

    ``insights`` is a ranked top-k with segment_type, segment_key and rate_change; its at most
    ``MAX_INSIGHTS`` rows are read first, as the conditions of the pass over ``enriched``.
    """
    found = insights.select("segment_type", "segment_key", F.abs("rate_change").alias("change")).limit(MAX_INSIGHTS + 1).collect()
    if len(found) > MAX_INSIGHTS:
        raise ValueError(f"at most {MAX_INSIGHTS} insights can share the impact out")
    rows = sorted(((r[0], r[1], r[2]) for r in found), key=lambda r: (r[0], str(r[1])))
    schema = ("step int, segment_type string, segment_key string, charged_transactions long, charged_impact_usd double, "
              "full_impact_usd double")
    spark = enriched.sparkSession
    if not rows:
        return spark.createDataFrame([], schema)
    defs = {t: (dims, declined) for t, dims, declined in _definitions(None, None)}
    inside = []
    for bit, (kind, key, _) in enumerate(rows):
        dims, declined = defs[kind]
        test = f"({_key_sql(dims)} <=> {sql_literal(key)})" + (" AND decline_reason IS NOT NULL" if declined else "")
        inside.append(f"IF({test}, {1 << bit}, 0)")
    _, late = half_labels(split_week, n_weeks)
    masks = (enriched.where(F.col("period_half") == late)
             .groupBy(F.expr(" + ".join(inside)).alias("mask"))
             .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(money_units("amount_usd")), F.lit(0)).alias("units")))
    # at most 2**len(rows) combinations
    held = [tuple(r) for r in cut_lineage(masks, "insight-masks").collect()]
    per_unit = UNIT / float(weeks_per_period) * float(weeks_per_month)
    left, out, covered = dict(enumerate(rows)), [], 0
    for step in range(1, len(rows) + 1):
        gains = []
        for bit, (kind, key, change) in left.items():
            mine = [(n, u) for mask, n, u in held if mask >> bit & 1 and not mask & covered]
            gains.append((-sum(u for _, u in mine) * change, bit, sum(n for n, _ in mine)))
        gain, bit, n = min(gains)
        kind, key, change = left.pop(bit)
        full = sum(u for mask, _, u in held if mask >> bit & 1) * change
        out.append((step, kind, key, n, -gain * per_unit, full * per_unit))
        covered |= 1 << bit
    return spark.createDataFrame(out, schema)
