"""The whiskers and outliers of the amount box, and boxes of any weeks from mergeable sketches.

``amount_box_whiskers`` is exact: amounts are counted per distinct value once, the quantiles come from
those counts (``views.amount_box``) and so do the whiskers (the outermost amounts within 1.5 interquartile ranges
of the box) and the counts beyond them; the few box rows meet the counts, the raw rows are read once.

``amount_sketches`` is the layer for boxes without raw rows: a KLL sketch per (week, status), a few
kilobytes each whatever the rows. ``box_from_sketches`` merges those of the weeks asked for; n, min and max
are exact, quantiles have the rank error of the sketch's ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .views import amount_box, amount_counts

FENCE = 1.5
#: KLL's accuracy parameter: a rank error of about 0.4 % at 800.
SKETCH_K = 800
QUANTILES = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))


def amount_box_whiskers(enriched: DataFrame, fence: float = FENCE) -> DataFrame:
    """V5's box by half x status with lower_whisker, upper_whisker, n_below and n_above (outliers).

    A group without a known amount has null whiskers and no outliers.
    """
    group = ["period_half", "status"]
    counts = amount_counts(enriched)
    box = cut_lineage(amount_box(None, counts=counts), "amount-boxes")
    spread = (F.col("q3") - F.col("q1")) * F.lit(fence)
    fences = box.select(*(F.col(g).alias(f"_{g}") for g in group), (F.col("q1") - spread).alias("_low"),
                        (F.col("q3") + spread).alias("_high"))
    met = counts.where(F.col("a").isNotNull()).join(fences, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group])
    below, above = F.col("a") < F.col("_low"), F.col("a") > F.col("_high")
    ends = met.groupBy(*group).agg(
        F.min(F.when(~below, F.col("a"))).alias("lower_whisker"), F.max(F.when(~above, F.col("a"))).alias("upper_whisker"),
        F.sum(F.when(below, F.col("c")).otherwise(F.lit(0))).alias("n_below"),
        F.sum(F.when(above, F.col("c")).otherwise(F.lit(0))).alias("n_above"))
    ends = ends.select(*(F.col(g).alias(f"_{g}") for g in group), "lower_whisker", "upper_whisker", "n_below", "n_above")
    joined = box.join(ends, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], "left")
    return joined.select(*box.columns, "lower_whisker", "upper_whisker",
                         *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_below", "n_above")))


def amount_sketches(df: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """The layer: (week_number, status, n, min, max, sketch); unknown amounts (null, NaN) are left out."""
    known = df.where(F.col("amount_usd").isNotNull() & ~F.isnan("amount_usd"))
    return known.groupBy("week_number", "status").agg(
        F.count(F.lit(1)).alias("n"), F.min("amount_usd").alias("min"), F.max("amount_usd").alias("max"),
        F.kll_sketch_agg_double("amount_usd", k).alias("sketch"))


def box_from_sketches(layer: DataFrame, weeks: Column, by: tuple[str, ...] = ("status",)) -> DataFrame:
    """The box of the rows of ``weeks`` (a condition over week_number), from the layer alone."""
    merged = layer.where(weeks).groupBy(*by).agg(
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("_sketch"))
    return merged.select(*by, "n", "min", *(F.kll_sketch_get_quantile_double("_sketch", F.lit(q)).alias(name)
                                            for name, q in QUANTILES), "max")
