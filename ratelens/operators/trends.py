"""C4 weekly trend, C11 pattern audit (A5, A6) and the overall KPI.

All are single group-bys with map-side partial aggregation: one shuffle of at
most (#groups x #tasks) rows, independent of how the rows spread over keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import (approved_flag, is_approved, money_units, money_units_to_double, pattern_flags,
                                 period_half, safe_rate)


def weekly_trends(df: DataFrame) -> DataFrame:
    """C4/A4: WEEKLY_TREND rows, ordered by week."""
    out = (df.groupBy("week_number")
           .agg(F.count(F.lit(1)).alias("total_transactions"),
                F.count_if(is_approved()).alias("approved_transactions"),
                F.sum(money_units("amount_usd")).alias("_amount"))
           .select("week_number", "total_transactions", "approved_transactions",
                   safe_rate("approved_transactions", "total_transactions").alias("approval_rate"),
                   money_units_to_double("_amount").alias("total_amount_usd")))
    return C.conform(out, C.WEEKLY_TREND).orderBy("week_number")


def weekly_trends_from_segments(segments: DataFrame) -> DataFrame:
    """C4 re-rolled from the cube's time_weekly/all rows (no second raw scan)."""
    out = (segments.where((F.col("segment_type") == "time_weekly") & (F.col("period") == "all"))
           .select(F.col("dimension_1").cast("int").alias("week_number"), "total_transactions",
                   "approved_transactions", "approval_rate", "total_amount_usd"))
    return C.conform(out, C.WEEKLY_TREND).orderBy("week_number")


def overall_kpi(df: DataFrame) -> DataFrame:
    """One row: total, approved, approval rate (0.0 when empty)."""
    return (df.agg(F.count(F.lit(1)).alias("total_transactions"),
                   F.count_if(is_approved()).alias("approved_transactions"))
            .withColumn("approval_rate", safe_rate("approved_transactions", "total_transactions")))


def pattern_audit(df: DataFrame, **pattern_params) -> DataFrame:
    """A5: per week, total/approved/rate overall and inside each planted pattern.

    One group-by with conditional counts replaces four filtered aggregations.
    """
    flags = pattern_flags(**pattern_params)
    ok = is_approved()
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("approved")]
    for name in ("is_hot_issuer", "is_high_value", "is_evening"):
        short = name[3:]
        aggs += [F.count_if(flags[name]).alias(f"{short}_total"),
                 F.count_if(flags[name] & ok).alias(f"{short}_approved")]
    out = df.groupBy("week_number").agg(*aggs)
    rates = {"approval_rate": F.try_divide(F.col("approved").cast("double"), F.col("total").cast("double"))}
    for short in ("hot_issuer", "high_value", "evening"):
        rates[f"{short}_rate"] = F.try_divide(F.col(f"{short}_approved").cast("double"),
                                              F.col(f"{short}_total").cast("double"))
    return out.withColumns(rates).orderBy("week_number")


def half_period_rate(df: DataFrame, split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> DataFrame:
    """Mean approval per half (weeks <= split vs > split; null week not counted)."""
    half = F.when(F.col("week_number").isNull(), F.lit(None)).otherwise(
        period_half("week_number", split_week, n_weeks))
    return (df.withColumn("period_half", half).where(F.col("period_half").isNotNull())
            .groupBy("period_half")
            .agg(F.count(F.lit(1)).alias("total"),
                 F.avg(approved_flag().cast("double")).alias("approval_rate")))
