"""C6 rank_insights and C7 summary.

Nothing here leaves Spark: the fallback count, the min/max of the scores and
the category winners are scalar subqueries / a bounded broadcast, and the
final pick is a distributed top-k (``orderBy().limit(k)``), so the anomaly
table can be of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import half_labels, lookup, severity
from ..functions.stats import min_max_normalise
from ..functions.text import insight_description, insight_title
from ..session import cut_lineage

IMPACT = "estimated_revenue_impact_usd"


def candidates(anomalies: DataFrame, min_n: int = C.MIN_N) -> DataFrame:
    """F5 + O3 + U2: flagged rows, topped up to ``min_n`` with the largest-impact unflagged rows."""
    flagged = anomalies.where(F.col("is_anomaly"))
    n_flagged = flagged.agg(F.count(F.lit(1))).scalar()
    order = [F.col(IMPACT).desc(), F.col("segment_key").asc_nulls_last()]
    # top-k of the unflagged side: at most min_n rows ever reach the window
    top_rest = anomalies.where(~F.col("is_anomaly")).orderBy(*order).limit(min_n)
    fallback = (top_rest.withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
                .where(F.col("_rn") <= F.lit(min_n) - n_flagged).drop("_rn"))
    return flagged.unionByName(fallback)


def score(cands: DataFrame) -> DataFrame:
    """P22-P24 + W4: weighted score over min-max normalised sub-scores."""
    w = C.SCORE_WEIGHTS
    df = cands.withColumns({
        "_magnitude": F.abs(F.col("rate_change")),
        "_significance": F.lit(1.0) - F.col("p_value"),
    })
    bounds = df.agg(F.struct(
        F.min(IMPACT).alias("i_lo"), F.max(IMPACT).alias("i_hi"),
        F.min("_magnitude").alias("m_lo"), F.max("_magnitude").alias("m_hi"),
        F.min("_significance").alias("s_lo"), F.max("_significance").alias("s_hi"))).scalar()
    b = bounds.getField
    return df.withColumns({
        "specificity": lookup(C.SPECIFICITY, "segment_type", C.SPECIFICITY_DEFAULT),
        "category": lookup(C.CATEGORY, "segment_type", C.CATEGORY_DEFAULT),
        "impact_norm": min_max_normalise(IMPACT, b("i_lo"), b("i_hi")),
        "magnitude_norm": min_max_normalise("_magnitude", b("m_lo"), b("m_hi")),
        "significance_norm": min_max_normalise("_significance", b("s_lo"), b("s_hi")),
    }).withColumn(
        "score",
        F.lit(w["impact"]) * F.col("impact_norm") + F.lit(w["magnitude"]) * F.col("magnitude_norm")
        + F.lit(w["significance"]) * F.col("significance_norm") + F.lit(w["specificity"]) * F.col("specificity")
    ).drop("_magnitude", "_significance")


def diverse_top_k(scored: DataFrame, top_n: int = C.TOP_N) -> DataFrame:
    """W5 + W6: best row of every category first (by score), then the rest by score; rank 1..k.

    The category winners come from a group-by (partial aggregation, no group is
    ever gathered in one task); there is one per category of the fixed
    category map, so the winners table is bounded and broadcast.
    """
    key = F.col("segment_key")
    winners = (scored.groupBy("category")
               .agg(F.min(F.struct((-F.col("score")).alias("neg_score"), key.isNull().alias("null_key"),
                                   key.alias("k"))).alias("w"))
               .select(F.col("category").alias("_wc"), F.col("w.k").alias("_wk"), F.lit(True).alias("is_best")))
    marked = scored.join(F.broadcast(winners),
                         (scored.category == winners._wc) & key.eqNullSafe(winners._wk), "left") \
        .drop("_wc", "_wk").withColumn("is_best", F.coalesce(F.col("is_best"), F.lit(False)))
    order = [F.col("score").desc(), key.asc_nulls_last()]
    picked = marked.orderBy(F.col("is_best").desc(), *order).limit(top_n)
    return picked.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))


def insight_id(split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS):
    """P29 (re-aimed): deterministic id, so reruns overwrite the same insight."""
    return F.sha2(F.concat_ws("|", F.col("segment_type"), F.col("segment_key"),
                              *(F.lit(x) for x in half_labels(split_week, n_weeks))), 256)


def rank_insights(anomalies: DataFrame, top_n: int = C.TOP_N, min_n: int = C.MIN_N,
                  keep_score: bool = False, split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> DataFrame:
    """INSIGHT rows (at most ``top_n``).

    The candidate set (read by the score bounds and the scoring) and the
    scored set (read three times by the top-k) are small; each is written once
    to the shared checkpoint folder instead of re-running its plan per read.
    """
    scored = cut_lineage(score(cut_lineage(candidates(anomalies, min_n), "candidates")), "scored")
    return insight_rows(diverse_top_k(scored, top_n), keep_score, split_week, n_weeks)


def insight_rows(ranked: DataFrame, keep_score: bool = False, split_week: int = C.SPLIT_WEEK,
                 n_weeks: int = C.N_WEEKS) -> DataFrame:
    """Id, title, description and severity of ranked rows."""
    out = ranked.withColumns({
        "insight_id": insight_id(split_week, n_weeks),
        "title": insight_title(),
        "description": insight_description(split_week=split_week),
        "severity": severity(IMPACT),
    })
    if keep_score:
        return out
    return C.conform(out, C.INSIGHT)


def summary(anomalies: DataFrame, insights: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """One-row summary. Rates are unweighted means over segments, and the
    impact sum double counts overlapping segments -- both as in the reference;
    ``weighted_*`` fields give the transaction-weighted rates beside them when
    the anomalies carry the measures (``detect_anomalies(keep_measures=True)``).
    """
    weighted = weighted_rates() if "baseline_total" in anomalies.columns else []
    ins = insights.agg(F.struct(
        F.sum(IMPACT).alias("impact"),
        F.count_if(F.col("severity") == "critical").alias("critical"),
        F.count_if(F.col("severity") == "high").alias("high"),
        F.count_if(F.col("severity") == "medium").alias("medium"),
        F.count_if(F.col("severity") == "low").alias("low"))).scalar()
    base = anomalies.agg(
        F.avg("baseline_rate").alias("_b"), F.avg("current_rate").alias("_c"),
        F.count_if(F.col("is_anomaly")).alias("anomalies_detected"), *weighted)
    out = base.select(
        F.round("_b", 4).alias("overall_baseline_rate"),
        F.round("_c", 4).alias("overall_current_rate"),
        F.round(F.col("_c") - F.col("_b"), 4).alias("total_rate_change"),
        F.round(F.coalesce(ins.getField("impact"), F.lit(0.0)), 2).alias("total_monthly_revenue_impact_usd"),
        F.col("anomalies_detected").cast("long").alias("anomalies_detected"),
        ins.getField("critical").cast("long").alias("critical_insights"),
        ins.getField("high").cast("long").alias("high_insights"),
        ins.getField("medium").cast("long").alias("medium_insights"),
        ins.getField("low").cast("long").alias("low_insights"),
        *(F.round(c, 4).alias(c) for c in ("weighted_baseline_rate", "weighted_current_rate") if weighted))
    if with_timestamp:
        out = out.withColumn("analysis_timestamp",
                             F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    return out


def weighted_rates() -> list:
    """Transaction-weighted baseline/current rates over the compared segments (7.4.2)."""
    return [F.try_divide(F.sum(f"{h}_approved").cast("double"), F.sum(f"{h}_total").cast("double"))
            .alias(f"weighted_{h}_rate") for h in ("baseline", "current")]
