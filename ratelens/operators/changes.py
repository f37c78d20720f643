"""F10 / V1 / P3 with the inflection found instead of fixed: change-point by binomial likelihood.

For each series of weekly counts and each week but the first, the log likelihood of two rates (before,
from that week on) is set against that of one rate. The week with the largest ratio is the change;
running sums over the weeks give all splits of a series in one window. A series has a row a
week, so its group is bounded by the time axis.

The likelihood-ratio statistic is chi-square with one degree of freedom for a fixed week, so its tail is
the normal two-sided tail of its root; the p-value is that tail times the number of weeks tried, at most 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.stats import two_sided_p
from .views import headline_trend

#: Statistics are compared at this many decimals, so that equal splits fall to the earlier week.
DECIMALS = 9


def _log_likelihood(k: Column, n: Column) -> Column:
    """k ln(k/n) + (n-k) ln((n-k)/n), terms of empty counts left out."""
    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / n)).otherwise(F.lit(0.0))
    return part(k) + part(n - k)


def change_points(series: DataFrame, keys: list[str], week: str = "week_number",
                  approved: str = "approved_transactions", total: str = "total_transactions") -> DataFrame:
    """One row per series with at least two weeks: change_week, rate_before, rate_after, lr_statistic,
    p_value, n_weeks. Rows without a week or without transactions are left out."""
    rows = series.where(F.col(week).isNotNull() & (F.col(total) > 0)).select(
        *keys, F.col(week).alias("_week"), F.col(approved).cast("double").alias("_k"), F.col(total).cast("double").alias("_n"))
    every = Window.partitionBy(*keys)
    order = every.orderBy("_week")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = rows.select(
        *keys, F.lead("_week").over(order).alias("change_week"), F.sum("_k").over(upto).alias("_k1"),
        F.sum("_n").over(upto).alias("_n1"), F.sum("_k").over(every).alias("_kt"), F.sum("_n").over(every).alias("_nt"),
        F.count(F.lit(1)).over(every).alias("n_weeks")).where(F.col("change_week").isNotNull())
    k2, n2 = F.col("_kt") - F.col("_k1"), F.col("_nt") - F.col("_n1")
    ratio = _log_likelihood(F.col("_k1"), F.col("_n1")) + _log_likelihood(k2, n2) - _log_likelihood(F.col("_kt"), F.col("_nt"))
    scored = split.select(*keys, "n_weeks", F.struct(
        F.round(F.greatest(ratio * 2.0, F.lit(0.0)), DECIMALS).alias("lr"), (-F.col("change_week")).alias("minus"),
        (F.col("_k1") / F.col("_n1")).alias("before"), (k2 / n2).alias("after")).alias("_s"))
    best = scored.groupBy(*keys, "n_weeks").agg(F.max("_s").alias("_s"))
    found = best.withColumn("_root", F.sqrt("_s.lr"))
    return found.select(
        *keys, (-F.col("_s.minus")).alias("change_week"), F.col("_s.before").alias("rate_before"),
        F.col("_s.after").alias("rate_after"), F.col("_s.lr").alias("lr_statistic"),
        F.least(F.lit(1.0), two_sided_p("_root", "exact") * (F.col("n_weeks") - 1)).alias("p_value"), "n_weeks")


def segment_change_points(segments: DataFrame) -> DataFrame:
    """The change-point of every segment of the cube, from the layer's weekly periods."""
    weekly = segments.where(F.col("period").startswith("week_") & F.col("segment_key").isNotNull()
                            & (F.col("segment_type") != "time_weekly"))
    weekly = weekly.withColumn("week_number", F.substring_index("period", "_", -1).cast("int"))
    return change_points(weekly, ["segment_type", "segment_key"])


def inflection_week(trends: DataFrame) -> int | None:
    """The change week of the overall weekly trend (one row of a table of a row a week)."""
    found = change_points(trends.withColumn("_all", F.lit(0)), ["_all"]).first()
    return None if found is None else found["change_week"]


def headline_trend_found(trends: DataFrame, target: float = C.TARGET_THRESHOLD) -> DataFrame:
    """V1 with the inflection marker at the week that the data show; no marker on fewer than two weeks."""
    week = inflection_week(trends)
    return headline_trend(trends, target, inflection_week=-1 if week is None else week)
