"""Baseline-vs-current comparison of every segment.

Plan: the two halves are read from the segment layer (partition-pruned when
the layer is partitioned by period) and folded in ONE ``groupBy(segment_key)``:

* W2 de-duplication: per half, ``min(struct(priority, segment_type, measures))``
  keeps the most specific segment type of a key (ties by type name). A key has
  at most one row per segment type, so groups are bounded by the number of
  definitions.
* J1 left join: keys with a baseline row are kept; current-only keys are
  dropped; a null key never matches, so its current side is empty -- the same
  as a left equi-join, without a second shuffle.
* W3 global z-score: mean and population std of rate_change are a 1-row
  aggregate used as a scalar subquery (no cross join, no one-partition window).
* P19 p-value: native column expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import half_labels, lookup
from ..functions.stats import standardize, two_proportion_p_value, with_p_value
from ..session import cut_lineage

# Types that are artefacts of the cube for the period comparison (see README).
ARTEFACT_TYPES = ("time_weekly", "decline_reason", "country_decline_reason")


def compare_periods(segments: DataFrame, baseline: str | None = None, current: str | None = None,
                    exclude_types: tuple[str, ...] = (), split_week: int = C.SPLIT_WEEK,
                    n_weeks: int = C.N_WEEKS) -> DataFrame:
    """W2 + J1 + P14: one row per baseline segment_key with both halves' measures.

    The halves are named by ``split_week`` and ``n_weeks``; ``baseline`` and
    ``current`` name any other two periods of the layer.
    """
    b_label, c_label = half_labels(split_week, n_weeks)
    baseline = baseline or b_label
    current = current or c_label
    seg = segments.where(F.col("period").isin(baseline, current))
    if exclude_types:
        seg = seg.where(~F.col("segment_type").isin(list(exclude_types)))
    rec = F.struct(
        lookup(C.TYPE_PRIORITY, "segment_type", C.TYPE_PRIORITY_DEFAULT).alias("priority"),
        F.col("segment_type").alias("segment_type"),
        F.col("approval_rate").alias("rate"),
        F.col("approved_transactions").alias("approved"),
        F.col("total_transactions").alias("total"),
        F.col("total_amount_usd").alias("amount"))
    per_key = (seg.groupBy("segment_key")
               .agg(F.min(F.when(F.col("period") == baseline, rec)).alias("b"),
                    F.min(F.when(F.col("period") == current, rec)).alias("c")))
    cur = F.when(F.col("segment_key").isNotNull(), F.col("c"))
    return (per_key.where(F.col("b").isNotNull())
            .select("segment_key",
                    F.col("b.segment_type").alias("segment_type"),
                    F.col("b.rate").alias("baseline_rate"),
                    F.col("b.approved").alias("baseline_approved"),
                    F.col("b.total").alias("baseline_total"),
                    F.col("b.amount").alias("baseline_amount_usd"),
                    F.coalesce(cur.getField("rate"), F.lit(0.0)).alias("current_rate"),
                    F.coalesce(cur.getField("approved"), F.lit(0).cast("long")).alias("current_approved"),
                    F.coalesce(cur.getField("total"), F.lit(0).cast("long")).alias("current_total"),
                    F.coalesce(cur.getField("amount"), F.lit(0.0)).alias("current_amount_usd")))


def detect_anomalies(segments: DataFrame, exclude_types: tuple[str, ...] = (),
                     weeks_per_period: float = C.WEEKS_PER_PERIOD, weeks_per_month: float = C.WEEKS_PER_MONTH,
                     z_threshold: float = C.ANOMALY_Z, p_threshold: float = C.ANOMALY_P,
                     min_affected: int = C.ANOMALY_MIN_AFFECTED, keep_measures: bool = False,
                     split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS,
                     p_method: str = "polynomial") -> DataFrame:
    """ANOMALY rows for every baseline segment.

    ``p_method`` names the tail of the p-value: ``polynomial`` or ``exact`` (``functions.stats``).

    By default the cube's artefact rows (time_weekly keys that exist in one
    half only, declined-only types with rate 0) stay in, as in the reference:
    they enter the mean/std of the z-score. ``exclude_types=ARTEFACT_TYPES``
    drops them.

    The compared table (one row per segment key, bounded by the dimensions'
    cardinality) is read twice -- by the mean/std subquery and by the scoring
    -- so it is materialised once, as a parquet table in the shared checkpoint
    folder. A layer with nothing in one of the halves raises.
    """
    joined = cut_lineage(compare_periods(segments, exclude_types=exclude_types, split_week=split_week, n_weeks=n_weeks)
                         .withColumn("rate_change", F.col("current_rate") - F.col("baseline_rate")), "compared")
    if joined.where("current_total > 0").isEmpty():
        labels = " and ".join(half_labels(split_week, n_weeks))
        raise ValueError(f"the segment layer has nothing to compare in the periods {labels}")
    stats = joined.agg(F.struct(F.avg("rate_change").alias("mean"),
                                F.stddev_pop("rate_change").alias("std")).alias("s")).scalar()
    affected = F.col("current_total")
    avg_ticket = F.when(affected > 0, F.col("current_amount_usd") / affected.cast("double")).otherwise(F.lit(0.0))
    scored = joined.select(
        "*",
        standardize("rate_change", stats.getField("mean"), stats.getField("std")).alias("z_score"),
        two_proportion_p_value("baseline_approved", "baseline_total",
                               "current_approved", "current_total").alias("p_value"),
        affected.cast("long").alias("affected_transactions"),
        ((affected.cast("double") / F.lit(float(weeks_per_period))) * avg_ticket
         * F.abs(F.col("rate_change")) * F.lit(float(weeks_per_month))).alias("estimated_revenue_impact_usd"))
    if p_method != "polynomial":
        scored = with_p_value(scored, "baseline_approved", "baseline_total", "current_approved", "current_total",
                              method=p_method)
    flagged = scored.withColumn(
        "is_anomaly",
        ((F.abs(F.col("z_score")) > F.lit(z_threshold)) | (F.col("p_value") < F.lit(p_threshold)))
        & (F.col("affected_transactions") > F.lit(min_affected)))
    if keep_measures:
        return flagged
    return C.conform(flagged, C.ANOMALY)
