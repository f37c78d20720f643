"""Customer cohorts.

Plan: one ``groupBy(customer_id, week_number)`` over the raw rows computes the
per-customer-week counts and each week's earliest transaction (partial
aggregation map-side, so a customer holding a third of all rows still sends
only one row per week per task). A window over ``customer_id`` then runs on
that aggregated table, where a group is bounded by the number of weeks, and
picks the customer's first transaction (W1) and acquisition week (A15). No
join back to the raw rows is needed: first-time counts are derived
additively (returning = all - first-time).

Null semantics follow the reference: W1 ranks only non-null timestamps (a
customer whose timestamps are all null has no first-time row) and treats null
customers as one customer; A15 sorts null timestamps first; the J2 equi-join
does not match a null customer, so its cohort_week is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import approved_flag, is_approved, rounded_ratio
from ..session import cut_lineage


def customer_weeks(df: DataFrame) -> DataFrame:
    """Per (customer, week): counts (all and recurring), first non-null-time txn, first txn (nulls first), then
    the customer's first-time week / approval and cohort week via a bounded window."""
    ts, tid = F.col("timestamp"), F.col("transaction_id")
    rec = F.coalesce(F.col("is_recurring"), F.lit(False))
    cw = (df.groupBy("customer_id", "week_number")
          .agg(F.count(F.lit(1)).alias("total"),
               F.count_if(is_approved()).alias("approved"),
               F.count_if(rec).alias("recurring"),
               F.count_if(rec & is_approved()).alias("recurring_approved"),
               F.min(F.when(ts.isNotNull(), F.struct(ts.alias("ts"), tid.alias("id"),
                                                      approved_flag().alias("ok")))).alias("_first_nn"),
               F.min(F.struct(ts.alias("ts"), tid.alias("id"))).alias("_first_any")))
    w = Window.partitionBy("customer_id")
    first_time = F.min(F.when(F.col("_first_nn").isNotNull(),
                              F.struct(F.col("_first_nn.ts").alias("ts"), F.col("_first_nn.id").alias("id"),
                                       F.col("week_number").alias("week"),
                                       F.col("_first_nn.ok").alias("ok")))).over(w)
    cohort = F.min_by(F.col("week_number"), F.col("_first_any")).over(w)
    return (cw.withColumns({"_ft": first_time, "_cohort": cohort})
            .select("customer_id", "week_number", "total", "approved", "recurring", "recurring_approved",
                    F.col("_ft.week").alias("first_time_week"),
                    F.col("_ft.ok").alias("first_time_ok"),
                    F.col("_ft").isNotNull().alias("has_first_time"),
                    F.when(F.col("customer_id").isNotNull(), F.col("_cohort")).alias("cohort_week")))


def first_time_vs_returning(df: DataFrame | None = None, per_customer: DataFrame | None = None) -> DataFrame:
    """Per week, approval rate (4 dp, 0.0 if none) and count of first-time vs returning txns."""
    pc = per_customer if per_customer is not None else customer_weeks(df)
    is_first_week = F.col("has_first_time") & F.col("week_number").eqNullSafe(F.col("first_time_week"))
    agg = (pc.groupBy("week_number")
           .agg(F.sum("total").alias("_total"), F.sum("approved").alias("_approved"),
                F.count_if(is_first_week).alias("_ft_n"),
                F.sum(F.when(is_first_week, F.col("first_time_ok")).otherwise(F.lit(0))).alias("_ft_ok")))
    re_n = F.col("_total") - F.col("_ft_n")
    re_ok = F.col("_approved") - F.col("_ft_ok")
    return agg.select(
        F.col("week_number").alias("week"),
        rounded_ratio("_ft_ok", "_ft_n").alias("first_time_rate"),
        F.col("_ft_n").cast("long").alias("first_time_n"),
        rounded_ratio(re_ok, re_n).alias("returning_rate"),
        re_n.cast("long").alias("returning_n")).orderBy("week")


def recurring_vs_onetime(df: DataFrame | None = None, per_customer: DataFrame | None = None) -> DataFrame:
    """Per week, recurring vs one-time (null flag = one-time) approval."""
    if per_customer is not None:
        agg = per_customer.groupBy("week_number").agg(
            F.sum("recurring").alias("_rn"), F.sum("recurring_approved").alias("_ra"),
            F.sum(F.col("total") - F.col("recurring")).alias("_on"),
            F.sum(F.col("approved") - F.col("recurring_approved")).alias("_oa"))
    else:
        rec = F.coalesce(F.col("is_recurring"), F.lit(False))
        ok = is_approved()
        agg = (df.groupBy("week_number")
               .agg(F.count_if(rec).alias("_rn"), F.count_if(rec & ok).alias("_ra"),
                    F.count_if(~rec).alias("_on"), F.count_if(~rec & ok).alias("_oa")))
    return agg.select(
        F.col("week_number").alias("week"),
        rounded_ratio("_ra", "_rn").alias("recurring_rate"),
        F.col("_rn").cast("long").alias("recurring_n"),
        rounded_ratio("_oa", "_on").alias("onetime_rate"),
        F.col("_on").cast("long").alias("onetime_n")).orderBy("week")


def acquisition_cohorts(df: DataFrame | None = None, per_customer: DataFrame | None = None) -> DataFrame:
    """Per (cohort_week, transaction_week): rate, distinct customers, transactions.

    One (customer, week) row per distinct customer value (null included, like
    polars n_unique), so the distinct count is a plain count of those rows.
    """
    pc = per_customer if per_customer is not None else customer_weeks(df)
    agg = (pc.groupBy("cohort_week", "week_number")
           .agg(F.sum("approved").alias("_ok"), F.sum("total").alias("_n"),
                F.count(F.lit(1)).alias("n_customers")))
    return agg.select(
        "cohort_week", F.col("week_number").alias("transaction_week"),
        rounded_ratio("_ok", "_n").alias("approval_rate"),
        F.col("n_customers").cast("long").alias("n_customers"),
        F.col("_n").cast("long").alias("n_transactions")).orderBy("cohort_week", "transaction_week")


def cohort_matrix(cohorts: DataFrame) -> DataFrame:
    """cohort_week x transaction_week -> approval rate, with a column for each transaction
    week of ``cohorts`` (a written layer: its weeks are read first, as many numbers as weeks)."""
    weeks = sorted(r[0] for r in cohorts.select("transaction_week").distinct().collect() if r[0] is not None)
    wide = cohorts.groupBy("cohort_week").pivot("transaction_week", weeks).agg(F.first("approval_rate"))
    return wide.select("cohort_week", *[F.col(str(w)).alias(f"w{w}") for w in weeks]).orderBy("cohort_week")


def cohort_payload(df: DataFrame) -> DataFrame:
    """S14 payload: one row with the three views as arrays of records (each bounded by weeks^2).

    The raw rows are scanned once, into a layer of a row per customer and week that all views read.
    """
    pc = cut_lineage(customer_weeks(df), "customer-weeks")
    views = {
        "first_time_vs_returning": first_time_vs_returning(per_customer=pc),
        "recurring_vs_onetime": recurring_vs_onetime(per_customer=pc),
        "acquisition_cohorts": acquisition_cohorts(per_customer=pc),
    }
    cols = []
    for name, v in views.items():
        order = v.columns[:2] if name == "acquisition_cohorts" else v.columns[:1]
        arr = v.agg(F.sort_array(F.collect_list(F.struct(*order, *[c for c in v.columns if c not in order]))))
        cols.append(arr.scalar().alias(name))
    return df.sparkSession.range(1).select(*cols)


def tag_customer_type(df: DataFrame) -> DataFrame:
    """P13 on row level (for drill-downs): 'first_time' for each customer's earliest
    non-null-time transaction (ties by transaction_id), else 'returning'.

    Uses a group-by + equi-join (AQE splits a skewed customer) rather than a
    window over raw rows.
    """
    first = (df.where(F.col("timestamp").isNotNull())
             .groupBy("customer_id")
             .agg(F.min(F.struct("timestamp", "transaction_id")).alias("_f"))
             .select(F.col("customer_id").alias("_cid"), F.col("_f.transaction_id").alias("_fid")))
    joined = df.join(first, df.customer_id.eqNullSafe(first._cid) & (df.transaction_id == first._fid), "left")
    return joined.withColumn("customer_type", F.when(F.col("_fid").isNotNull(), F.lit("first_time"))
                             .otherwise(F.lit("returning"))).drop("_cid", "_fid")

