"""Enrich raw transactions with the derived bucket and period columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import amount_bucket, hour_bucket, period_half


def enrich(df: DataFrame, split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> DataFrame:
    """Adds amount_bucket, hour_bucket, period_half (narrow, no shuffle)."""
    return df.withColumns({
        "amount_bucket": amount_bucket("amount_usd"),
        "hour_bucket": hour_bucket("hour_of_day"),
        "period_half": period_half("week_number", split_week, n_weeks),
    })


def fx_normalise(df: DataFrame, fx: DataFrame | dict | None = None, key: str = "country",
                 scale: int = 4) -> DataFrame:
    """Amount (local) x fx_rate -> amount_usd_fx, rounded to ``scale``.

    ``fx`` is either a dict (a literal map, for the fixed country list) or a
    DataFrame (key, fx_rate). A DataFrame table is joined without a hint: Spark
    broadcasts it only if its measured size is under the broadcast threshold.
    """
    fx = C.COUNTRY_FX if fx is None else fx
    if isinstance(fx, dict):
        pairs = []
        for k, v in fx.items():
            pairs += [F.lit(k), F.lit(float(v))]
        rate = F.try_element_at(F.create_map(*pairs), F.col(key))
        out = df.withColumn("fx_rate", rate)
    else:
        out = df.join(fx.select(key, "fx_rate"), key, "left")
    return out.withColumn("amount_usd_fx", F.round(F.col("amount") * F.col("fx_rate"), scale))
