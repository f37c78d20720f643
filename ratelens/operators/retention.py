"""A14 / A13 over any range of weeks: distinct customers from mergeable exact bitmaps.

``n_customers`` of two weeks cannot be added: a customer may be in both. The layer here keeps, per
(cohort week, week), the set of customers as bitmaps over dense customer numbers, 32,768 customers a
bitmap of 4 KB. Weeks are united by or-ing bitmaps, so the distinct customers of a half, of any
range, and those retained from one range to another come from the layer, not from raw rows.

Customers are numbered densely without a one-task window: they are dealt to ``BUCKETS`` hash buckets, numbered inside
each, and shifted by the sizes of the buckets before (a running sum over ``BUCKETS`` rows). Null customers cannot be told
apart and are left out, as the reference's join leaves them without a cohort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import rounded_ratio
from ..session import cut_lineage
from .cohorts import customer_weeks

BUCKETS = 4096


def number_customers(customers: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(customer_id, number): numbers 1 to n without gaps, one per distinct non-null customer."""
    known = customers.where("customer_id is not null").select("customer_id").distinct().withColumn(
        "_bucket", F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).cast("int"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = known.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("customer_id"))
    return known.withColumn("_inside", inside).join(offsets, "_bucket").select(
        "customer_id", (F.col("_offset") + F.col("_inside")).alias("number"))


def cohort_bitmaps(df: DataFrame | None = None, per_customer: DataFrame | None = None,
                   buckets: int = BUCKETS) -> DataFrame:
    """The layer: (cohort_week, week_number, part, customers), a bitmap per part of the numbers."""
    pc = per_customer if per_customer is not None else customer_weeks(df)
    seen = cut_lineage(pc.where("customer_id is not null").select("customer_id", "cohort_week", "week_number"), "customer-weeks")
    numbered = seen.join(number_customers(seen, buckets), "customer_id")
    return (numbered.groupBy("cohort_week", "week_number", F.bitmap_bucket_number("number").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers")))


def _where(bitmaps: Column, keep: Column) -> Column:
    """Distinct customers of one part over the weeks that ``keep`` selects."""
    return F.coalesce(F.bitmap_count(F.bitmap_or_agg(F.when(keep, bitmaps))), F.lit(0))


def distinct_customers(layer: DataFrame, first_week: int, last_week: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct customers of weeks ``first_week`` to ``last_week``, in all or ``by`` cohort_week."""
    weeks = F.col("week_number").between(first_week, last_week)
    parts = layer.where(weeks).groupBy(*by, "part").agg(F.bitmap_count(F.bitmap_or_agg("customers")).alias("_n"))
    return parts.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_customers"))


def cohort_retention(layer: DataFrame, early: Column, late: Column) -> DataFrame:
    """Per cohort week: its customers, those active in the ``early`` and in the ``late`` weeks (conditions over
    ``week_number``), those in both, and the share of the early ones that came back (4 dp)."""
    bits = F.col("customers")
    parts = layer.groupBy("cohort_week", "part").agg(
        F.bitmap_count(F.bitmap_or_agg(bits)).alias("_all"), _where(bits, early).alias("_early"),
        _where(bits, late).alias("_late"), _where(bits, early | late).alias("_either"))
    sums = parts.groupBy("cohort_week").agg(*(F.sum(c).cast("long").alias(c) for c in ("_all", "_early", "_late", "_either")))
    both = F.col("_early") + F.col("_late") - F.col("_either")
    return sums.select("cohort_week", F.col("_all").alias("n_customers"), F.col("_early").alias("n_early"),
                       F.col("_late").alias("n_late"), both.alias("n_retained"),
                       rounded_ratio(both, "_early").alias("retention_rate"))
