"""Stated goals without code in the reference: X2 risk score, X3 hourly/daily rates.

(X1, the streaming alert, lives in ``ratelens.streaming.alerts``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import half_labels, is_approved, period_half, safe_rate
from ..session import cut_lineage


def time_bucket_rates(df: DataFrame, units: str | tuple[str, ...] = ("hour", "day"),
                      dims: list[str] | None = None) -> DataFrame:
    """Approval rate per hour / day bucket (and optional dims), all units in one scan.

    The rows are grouped once, by the finest unit (a day at most, which every
    longer unit is made of); only these groups feed the units.
    """
    units = (units,) if isinstance(units, str) else tuple(units)
    dims = dims or []
    fmt = "yyyy-MM-dd HH:mm:ss"
    base = next((u for u in ("second", "minute", "hour") if u in units), "day")
    fine = (df.groupBy(F.date_trunc(base, F.col("timestamp")).alias("_at"), *dims)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_approved()).alias("ok")))
    per_unit = F.array(*[F.struct(F.lit(u).alias("granularity"),
                                  F.date_format(F.date_trunc(u, F.col("_at")), fmt).alias("bucket"))
                         for u in units])
    return (fine.select(F.explode(per_unit).alias("_u"), *dims, "n", "ok")
            .groupBy(F.col("_u.granularity").alias("granularity"), F.col("_u.bucket").alias("bucket"), *dims)
            .agg(F.sum("n").alias("total_transactions"), F.sum("ok").alias("approved_transactions"))
            .withColumn("approval_rate", safe_rate("approved_transactions", "total_transactions")))


def risk_score(df: DataFrame, dims: list[str] | None = None, alpha: float = 20.0,
               split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> DataFrame:
    """Risk of each current-half transaction from its segment's baseline history.

    Baseline approval per segment is smoothed towards the overall baseline rate
    (``(approved + alpha * p) / (n + alpha)``) so thin segments are not
    extreme; risk = 1 - smoothed rate. The baseline segment table is joined
    without a hint: it is broadcast only when its measured size is under the
    threshold, else shuffled (its size is bounded by dimension cardinality, not
    by rows).
    """
    dims = dims or ["country", "issuer_bank", "card_brand", "card_type"]
    early, late = half_labels(split_week, n_weeks)
    half = period_half("week_number", split_week, n_weeks)
    hist = (df.where(half == early).groupBy(*dims)
            .agg(F.count(F.lit(1)).alias("hist_n"), F.count_if(is_approved()).alias("hist_approved")))
    # the history table (bounded by dimension cardinality) is read twice: by the
    # prior and by the join; materialise it so the rows are scanned once for it
    hist = cut_lineage(hist, "risk-history")
    # the overall baseline rate comes from the (small) history table, not a re-scan
    prior = hist.agg(safe_rate(F.sum("hist_approved"), F.sum("hist_n"))).scalar()
    cur = df.where(half == late).select("transaction_id", *dims, "status")
    joined = cur.join(hist, [cur[d].eqNullSafe(hist[d]) for d in dims], "left").select(
        "transaction_id", *[cur[d] for d in dims], "status",
        F.coalesce("hist_n", F.lit(0).cast("long")).alias("hist_n"),
        F.coalesce("hist_approved", F.lit(0).cast("long")).alias("hist_approved"))
    smoothed = (F.col("hist_approved") + F.lit(alpha) * prior) / (F.col("hist_n") + F.lit(alpha))
    return joined.withColumns({"expected_approval": smoothed, "risk_score": F.lit(1.0) - smoothed})

