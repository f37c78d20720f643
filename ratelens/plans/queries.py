"""Named queries: (spark, sf_dir) -> DataFrame, one per operator of SURVEY §2.

Each query binds the driver's tables to the raw-transaction contract (binding
E = events, L = line items), runs the operator over the whole tables and
projects a stable, explicitly named and typed result. Doubles that come out
of order-dependent float work (means, std, exp) are rounded to 6 places in the
projection so an independent engine can compare values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import severity
from ..functions.stats import two_proportion_p_value, with_p_value
from ..functions.text import insight_description, insight_title
from ..operators import anomalies as A
from ..operators import asof, attribution, boxes, changes, incremental, retention
from ..operators import cohorts as K
from ..operators import extensions as X
from ..operators import insights as I
from ..operators import segments as S
from ..operators import trends as T
from ..operators import views as V
from ..operators.enrich import enrich, fx_normalise
from ..session import cut_lineage, layer_path
from ..sources import io
from ..sources.bindings import geography, transactions
from ..streaming import alerts, episodes

R6 = 6
# Pattern audit on the bindings: the reference's hot issuer (MX/BBVA) does not
# exist in the driver's tables, so the audit names a present country/issuer.
E_PATTERN = {"country": "AMERICA", "issuer": "NATION_1"}
L_PATTERN = {"country": "EUROPE", "issuer": "NATION_3"}
FALLBACK_MIN_N = 10
DRILL_DIMS = ["card_brand", "card_type", "amount_bucket", "hour_bucket"]
RISK_DIMS = ["country", "card_brand", "card_type"]
L_VARIANTS = ("enrich_buckets", "segments_all", "anomalies", "insights", "first_time_vs_returning",
              "acquisition_cohorts", "weekly_trend", "pattern_audit", "waterfall", "amount_box",
              "country_breakdown", "issuer_heatmap", "summary", "hourly_pattern", "recurring_vs_onetime",
              "change_points", "cohort_retention", "amount_box_whiskers", "segments_incremental")


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, R6)


def _raw(spark, sf_dir, b="E") -> DataFrame:
    return transactions(spark, sf_dir, b)


def _enriched(spark, sf_dir, b="E") -> DataFrame:
    return enrich(_raw(spark, sf_dir, b))


# Layer boundaries. The segment and anomaly layers are small (bounded by
# dimension cardinality) and are read several times downstream (scalar
# subqueries, joins), so a plan that consumes them materialises them once
# under the shared checkpoint folder -- the reference's file hand-off between
# stages. A query whose result *is* the layer does not.

def _segments(spark, sf_dir, b="E", materialize=True) -> DataFrame:
    seg = S.segment_cube(_enriched(spark, sf_dir, b))
    return cut_lineage(seg, "segments") if materialize else seg


def _anomalies(spark, sf_dir, b="E", **kw) -> DataFrame:
    # the cube is read once here; detect_anomalies materialises its (small)
    # compared table itself, so re-reads of the anomalies are cheap
    return A.detect_anomalies(_segments(spark, sf_dir, b, materialize=False), **kw)


def _candidates(spark, sf_dir, b="E", min_n=C.MIN_N) -> DataFrame:
    return cut_lineage(I.candidates(_anomalies(spark, sf_dir, b), min_n), "candidates")


def _scored(spark, sf_dir, b="E") -> DataFrame:
    return cut_lineage(I.score(_candidates(spark, sf_dir, b)), "scored")


def _insights(spark, sf_dir, b="E", keep_score=False) -> DataFrame:
    return I.rank_insights(_anomalies(spark, sf_dir, b), keep_score=keep_score)


def _round_anomalies(df: DataFrame) -> DataFrame:
    return df.select("segment_key", "segment_type", "baseline_rate", "current_rate", "rate_change",
                     r6("z_score").alias("z_score"), r6("p_value").alias("p_value"), "is_anomaly",
                     "affected_transactions",
                     r6("estimated_revenue_impact_usd").alias("estimated_revenue_impact_usd"))


def _round_insights(df: DataFrame) -> DataFrame:
    return df.select("rank", "insight_id", "title", "description", "segment_key", "baseline_rate",
                     "current_rate", "rate_change", "affected_transactions",
                     r6("estimated_revenue_impact_usd").alias("estimated_revenue_impact_usd"), "severity")


# --------------------------------------------------------------------------- queries

def q_enrich_buckets(spark, d, b="E"):
    e = _enriched(spark, d, b)
    return e.select("transaction_id", "week_number", "hour_of_day", "amount_usd",
                    "amount_bucket", "hour_bucket", "period_half")


def q_fx_normalised(spark, d):
    raw = _raw(spark, d, "E")
    fx = geography(spark, d).select(F.col("r_name").alias("country"), "fx_rate").distinct()
    # the event's value taken as local money: an amount that no rate has made
    out = fx_normalise(raw.withColumn("amount", F.col("amount_usd")), fx=fx, scale=8)
    return out.select("transaction_id", "country", "currency", "amount", "fx_rate", "amount_usd_fx")


def q_weekly_trend(spark, d, b="E"):
    return T.weekly_trends(_raw(spark, d, b))


def q_overall_kpi(spark, d, b="E"):
    return T.overall_kpi(_raw(spark, d, b))


def q_pattern_audit(spark, d, b="E"):
    return T.pattern_audit(_raw(spark, d, b), **(E_PATTERN if b == "E" else L_PATTERN))


def q_half_period_rate(spark, d, b="E"):
    return T.half_period_rate(_raw(spark, d, b))


def q_segments_all(spark, d, b="E"):
    return _segments(spark, d, b, materialize=False)


def q_segment_drill_4d(spark, d):
    # a null flag counts as one-time, as in C9
    one_time = ~F.coalesce(F.col("is_recurring"), F.lit(False))
    return S.segment_by(_enriched(spark, d, "E"), DRILL_DIMS, where=one_time, name="drill_4d")


def q_segment_drill(spark, d, b="E"):
    return S.segment_by(_enriched(spark, d, b), ["country", "hour_bucket"], name="drill")


def q_declined_reason_segments(spark, d, b="E"):
    return S.segment_cube(_enriched(spark, d, b), definitions={})


def q_segment_dedup(spark, d, b="E"):
    seg = _segments(spark, d, b)
    halves = S.half_labels()
    out = None
    for h in halves:
        cmp_ = A.compare_periods(seg, baseline=h, current=h)
        part = cmp_.select("segment_key", "segment_type", F.lit(h).alias("period"),
                           F.col("baseline_total").alias("total_transactions"),
                           F.col("baseline_rate").alias("approval_rate"))
        out = part if out is None else out.unionByName(part)
    return out


def q_period_join(spark, d, b="E"):
    j = A.compare_periods(_segments(spark, d, b))
    affected = F.col("current_total")
    avg_ticket = F.when(affected > 0, F.col("current_amount_usd") / affected.cast("double")).otherwise(F.lit(0.0))
    rc = F.col("current_rate") - F.col("baseline_rate")
    return j.select("segment_key", "segment_type", "baseline_rate", "baseline_approved", "baseline_total",
                    "current_rate", "current_approved", "current_total", rc.alias("rate_change"),
                    r6(avg_ticket).alias("avg_ticket_usd"),
                    r6((affected.cast("double") / F.lit(float(C.WEEKS_PER_PERIOD))) * avg_ticket * F.abs(rc)
                       * F.lit(C.WEEKS_PER_MONTH)).alias("estimated_revenue_impact_usd"))


def q_zscore(spark, d, b="E"):
    a = _anomalies(spark, d, b)
    return a.select("segment_key", "rate_change", r6("z_score").alias("z_score"))


def q_ztest_pvalue(spark, d, b="E"):
    j = A.compare_periods(_segments(spark, d, b))
    p = two_proportion_p_value("baseline_approved", "baseline_total", "current_approved", "current_total")
    return j.select("segment_key", "baseline_approved", "baseline_total", "current_approved", "current_total",
                    r6(p).alias("p_value"))


def q_anomalies(spark, d, b="E"):
    return _round_anomalies(_anomalies(spark, d, b))


def q_anomalies_split2(spark, d, b="E"):
    seg = S.segment_cube(_raw(spark, d, b), split_week=2, n_weeks=6)
    return _round_anomalies(A.detect_anomalies(seg, split_week=2, n_weeks=6))


def q_anomalies_excl(spark, d, b="E"):
    return _round_anomalies(_anomalies(spark, d, b, exclude_types=A.ARTEFACT_TYPES))


def q_anomaly_fallback(spark, d, b="E"):
    c = I.candidates(_anomalies(spark, d, b), min_n=FALLBACK_MIN_N)
    return _round_anomalies(c)


def q_insight_scores(spark, d, b="E"):
    s = I.score(_candidates(spark, d, b))
    return s.select("segment_key", "segment_type", "category", "specificity",
                    r6("impact_norm").alias("impact_norm"), r6("magnitude_norm").alias("magnitude_norm"),
                    r6("significance_norm").alias("significance_norm"), r6("score").alias("score"))


def q_diverse_topk(spark, d, b="E"):
    k = I.diverse_top_k(_scored(spark, d, b))
    return k.select("rank", "segment_key", "segment_type", "category", "is_best", r6("score").alias("score"))


def q_insights(spark, d, b="E"):
    return _round_insights(_insights(spark, d, b))


def q_insight_text(spark, d, b="E"):
    # the text builders on every candidate row (not only the top-k)
    c = _candidates(spark, d, b)
    return c.select("segment_key", insight_title().alias("title"), insight_description().alias("description"),
                    severity("estimated_revenue_impact_usd").alias("severity"))


def q_severity_counts(spark, d, b="E"):
    ins = _insights(spark, d, b)
    return ins.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def q_summary(spark, d, b="E"):
    a = _anomalies(spark, d, b, keep_measures=True)
    return I.summary(a, I.rank_insights(a), with_timestamp=False)


# Layer round trips: each query writes a layer under the shared folder, reads it back through its
# source and returns what was read.

def q_layer_raw(spark, d, b="E"):
    """The raw layer, validated on both sides."""
    path = layer_path(spark, "raw")
    io.write_layer(C.validate(_raw(spark, d, b), C.RAW_TRANSACTION, strict=True), path)
    return T.weekly_trends(io.read_raw(spark, path))


def q_layer_segments(spark, d, b="E"):
    """The segment layer, partitioned by period."""
    path = layer_path(spark, "segments")
    io.write_layer(_segments(spark, d, b, materialize=False), path, partition_by=["period"])
    return io.read_layer(spark, path, C.SEGMENT)


def q_layer_anomalies(spark, d, b="E"):
    """S4."""
    path = layer_path(spark, "anomalies")
    io.write_layer(_anomalies(spark, d, b), path)
    return _round_anomalies(io.read_layer(spark, path, C.ANOMALY))


def q_layer_view(spark, d, b="E"):
    """A view's parquet."""
    path = layer_path(spark, "view")
    io.write_layer(q_headline_trend(spark, d, b), path)
    return spark.read.parquet(path)


def q_insights_json(spark, d, b="E"):
    """S6, S12."""
    path = layer_path(spark, "insights-json")
    io.write_json(_insights(spark, d, b).orderBy("rank"), path, single_file=True)
    return _round_insights(io.read_insights_json(spark, path))


def q_summary_json(spark, d, b="E"):
    """The summary object; its time stamp must parse as UTC."""
    path = layer_path(spark, "summary-json")
    a = _anomalies(spark, d, b)
    made = I.summary(a, I.rank_insights(a))
    io.write_json(made, path, single_file=True)
    back = spark.read.schema(made.schema).json(path)
    stamp = F.col("analysis_timestamp")
    return back.select(*[c for c in back.columns if c != "analysis_timestamp"],
                       (F.try_to_timestamp(stamp).isNotNull() & stamp.endswith("+00:00")).alias("utc_stamp"))


def q_cohort_payload(spark, d, b="E"):
    """The nested payload, its acquisition rows exploded again."""
    path = layer_path(spark, "cohort-json")
    made = K.cohort_payload(_raw(spark, d, b))
    io.write_json(made, path, single_file=True)
    rows = spark.read.schema(made.schema).json(path).select(F.explode("acquisition_cohorts").alias("r"))
    return rows.select("r.*")


def q_layer_raw_rows(spark, d, b="E"):
    """Every row and column of the raw layer."""
    path = layer_path(spark, "raw")
    io.write_layer(C.validate(_raw(spark, d, b), C.RAW_TRANSACTION, strict=True), path)
    back = io.read_raw(spark, path)
    return back.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def q_cohort_payload_all(spark, d, b="E"):
    """The nested payload's three arrays, exploded again into rows of one shape."""
    path = layer_path(spark, "cohort-json")
    made = K.cohort_payload(_raw(spark, d, b))
    io.write_json(made, path, single_file=True)
    back = spark.read.schema(made.schema).json(path)
    weekly = {"first_time_vs_returning": ("first_time", "returning"), "recurring_vs_onetime": ("recurring", "onetime")}
    out = back.select(F.explode("acquisition_cohorts").alias("r")).select(
        F.lit("acquisition_cohorts").alias("view"), F.col("r.cohort_week").alias("cohort_week"),
        F.col("r.transaction_week").alias("week"), F.lit("all").alias("kind"), F.col("r.approval_rate").alias("rate"),
        F.col("r.n_transactions").alias("n"), F.col("r.n_customers").alias("n_customers"))
    for view, kinds in weekly.items():
        rows = back.select(F.explode(view).alias("r"))
        for kind in kinds:
            out = out.union(rows.select(
                F.lit(view), F.lit(None), F.col("r.week"), F.lit(kind), F.col(f"r.{kind}_rate"), F.col(f"r.{kind}_n"), F.lit(None)))
    return out


def q_sample_csv_all(spark, d, b="E"):
    """All columns of the sample, typed again."""
    path = layer_path(spark, "sample-csv")
    io.write_sample_csv(_raw(spark, d, b), path)
    back = io.read_sample_csv(spark, path)
    return back.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def q_sample_csv(spark, d, b="E"):
    """The first 100 rows by time; a sample is the feature."""
    path = layer_path(spark, "sample-csv")
    io.write_sample_csv(_raw(spark, d, b), path)
    back = spark.read.option("header", True).csv(path)
    return back.select("transaction_id", "week_number", "status", "decline_reason")


def q_first_time_vs_returning(spark, d, b="E"):
    return K.first_time_vs_returning(_raw(spark, d, b))


def q_customer_type_tags(spark, d, b="E"):
    t = K.tag_customer_type(_raw(spark, d, b))
    return t.select("transaction_id", "customer_id", "week_number", "customer_type")


def q_weekly_trend_from_cube(spark, d, b="E"):
    return T.weekly_trends_from_segments(_segments(spark, d, b, materialize=False))


def q_recurring_vs_onetime(spark, d, b="E"):
    return K.recurring_vs_onetime(_raw(spark, d, b))


def q_acquisition_cohorts(spark, d, b="E"):
    return K.acquisition_cohorts(_raw(spark, d, b))


def q_cohort_matrix(spark, d, b="E"):
    return K.cohort_matrix(cut_lineage(K.acquisition_cohorts(_raw(spark, d, b)), "cohorts"))


def q_headline_trend(spark, d, b="E"):
    return V.headline_trend(T.weekly_trends(_raw(spark, d, b)))


def q_country_breakdown(spark, d, b="E"):
    return V.country_breakdown(_segments(spark, d, b)).select(
        "country", "early_rate", "late_rate", r6("drop_pp").alias("drop_pp"), "late_band", "is_worst")


def q_issuer_heatmap(spark, d, b="E"):
    return V.issuer_heatmap(_segments(spark, d, b))


def q_waterfall(spark, d, b="E"):
    w = V.waterfall(_enriched(spark, d, b), **(E_PATTERN if b == "E" else L_PATTERN))
    return w.select("step", "factor", "measure", r6("contribution_pp").alias("contribution_pp"))


def q_amount_box(spark, d, b="E"):
    box = V.amount_box(_enriched(spark, d, b))
    return box.select("period_half", "status", "n", "min", r6("q1").alias("q1"), r6("median").alias("median"),
                      r6("q3").alias("q3"), "max", r6("mean").alias("mean"))


def q_hourly_pattern(spark, d, b="E"):
    return V.hourly_pattern(_enriched(spark, d, b))


def q_kpi_row(spark, d, b="E"):
    k = V.kpi_row(T.weekly_trends(_raw(spark, d, b)), _insights(spark, d, b))
    return k.select("current_rate", "baseline_rate", "decline_pp", r6("total_impact_usd").alias("total_impact_usd"),
                    "current_text", "baseline_text", "decline_text", "impact_text")


def q_insight_cards(spark, d, b="E"):
    return V.insight_cards(_insights(spark, d, b))


def q_hourly_daily_rates(spark, d, b="E"):
    return X.time_bucket_rates(_raw(spark, d, b), ("hour", "day"))


def q_risk_score(spark, d, b="E"):
    r = X.risk_score(_raw(spark, d, b), dims=RISK_DIMS)
    return r.select("transaction_id", *RISK_DIMS, "hist_n", "hist_approved",
                    r6("expected_approval").alias("expected_approval"), r6("risk_score").alias("risk_score"))


def q_alert_windows(spark, d, b="E"):
    return alerts.alert_windows_batch(_raw(spark, d, b))


def q_ztest_pvalue_exact(spark, d, b="E"):
    """P19 by the exact tail."""
    j = A.compare_periods(_segments(spark, d, b))
    p = with_p_value(j, "baseline_approved", "baseline_total", "current_approved", "current_total")
    return p.select("segment_key", "baseline_approved", "baseline_total", "current_approved", "current_total",
                    F.round("p_value", 12).alias("p_value"), r6(F.log10("p_value")).alias("log10_p"))


def q_anomalies_exact_p(spark, d, b="E"):
    return _round_anomalies(_anomalies(spark, d, b, p_method="exact"))


def _stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def q_alert_episodes(spark, d, b="E"):
    """One row per episode below the threshold."""
    found = episodes.episodes(episodes.judged_windows(_raw(spark, d, b)))
    return found.select("country", _stamp("fell_at"), _stamp("recovered_at"), "n_windows", "lowest_rate")


def q_alert_stream(spark, d, b="E"):
    """X1 as a stream: the raw layer is streamed to its end and the sink is read back."""
    source, sink, state = (layer_path(spark, f"alert-{x}") for x in ("source", "sink", "state"))
    io.write_layer(C.validate(_raw(spark, d, b), C.RAW_TRANSACTION, strict=True), source)
    running = episodes.start_episodes(spark, source, sink, state)
    running.awaitTermination()
    return spark.read.parquet(sink).select("country", "event", _stamp("window_end"), "total_transactions",
                                           "approved_transactions", "approval_rate")


def q_segments_incremental(spark, d, b="E"):
    """All weeks but the last are loaded, then the last one alone is added."""
    raw = _raw(spark, d, b)
    base, seg = layer_path(spark, "cube-base"), layer_path(spark, "cube-segments")
    weeks = [r[0] for r in raw.select("week_number").distinct().collect()]
    last = max(w for w in weeks if w is not None)
    incremental.load_weeks(raw, [w for w in weeks if w != last], base, seg)
    return incremental.load_weeks(raw, [last], base, seg)


def q_cohort_retention(spark, d, b="E"):
    """Distinct and retained customers of the halves from the bitmap layer."""
    layer = cut_lineage(retention.cohort_bitmaps(_raw(spark, d, b)), "cohort-bitmaps")
    early = F.coalesce(F.col("week_number") <= C.SPLIT_WEEK, F.lit(False))
    return retention.cohort_retention(layer, early, ~early)


def q_change_points(spark, d, b="E"):
    """The week at which each segment's rate changes most."""
    found = changes.segment_change_points(_segments(spark, d, b, materialize=False))
    return found.select("segment_type", "segment_key", "change_week", r6("rate_before").alias("rate_before"),
                        r6("rate_after").alias("rate_after"), r6("lr_statistic").alias("lr_statistic"),
                        r6("p_value").alias("p_value"), "n_weeks")


def q_headline_trend_found(spark, d, b="E"):
    """V1 with the inflection week found in the data."""
    return changes.headline_trend_found(cut_lineage(T.weekly_trends(_raw(spark, d, b)), "trend"))


def q_disjoint_impact(spark, d, b="E"):
    """A10: the impact of the ranked insights, each transaction charged once."""
    picked = cut_lineage(I.diverse_top_k(_scored(spark, d, b)), "picked")
    out = attribution.disjoint_impact(_enriched(spark, d, b), picked)
    return out.select("step", "segment_type", "segment_key", "charged_transactions",
                      r6("charged_impact_usd").alias("charged_impact_usd"), r6("full_impact_usd").alias("full_impact_usd"))


def q_risk_score_asof(spark, d, b="E"):
    """Risk from the history before each transaction's day."""
    r = asof.risk_score_asof(_raw(spark, d, b))
    return r.select("transaction_id", "country", "issuer_bank", "hist_n", "hist_approved",
                    r6("expected_approval").alias("expected_approval"), r6("risk_score").alias("risk_score"))


def q_amount_box_whiskers(spark, d, b="E"):
    box = boxes.amount_box_whiskers(_enriched(spark, d, b))
    return box.select("period_half", "status", "n", "min", r6("q1").alias("q1"), r6("median").alias("median"),
                      r6("q3").alias("q3"), "max", "lower_whisker", "upper_whisker", "n_below", "n_above")


def q_hourly_rates_dense(spark, d, b="E"):
    """X3 per country and hour, hours without traffic included."""
    return asof.dense_hourly_rates(_raw(spark, d, b), ["country"])


def _binding(fn, b):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir, b)
    run.__name__ = f"{fn.__name__}_{b}"
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg = {
        "enrich_buckets": q_enrich_buckets,
        "fx_normalised": q_fx_normalised,
        "weekly_trend": q_weekly_trend,
        "overall_kpi": q_overall_kpi,
        "pattern_audit": q_pattern_audit,
        "half_period_rate": q_half_period_rate,
        "segments_all": q_segments_all,
        "segment_drill_4d": q_segment_drill_4d,
        "segment_drill": q_segment_drill,
        "anomalies_split2": q_anomalies_split2,
        "layer_raw": q_layer_raw,
        "layer_segments": q_layer_segments,
        "layer_anomalies": q_layer_anomalies,
        "layer_view": q_layer_view,
        "insights_json": q_insights_json,
        "summary_json": q_summary_json,
        "cohort_payload": q_cohort_payload,
        "sample_csv": q_sample_csv,
        "layer_raw_rows": q_layer_raw_rows,
        "cohort_payload_all": q_cohort_payload_all,
        "sample_csv_all": q_sample_csv_all,
        "declined_reason_segments": q_declined_reason_segments,
        "segment_dedup": q_segment_dedup,
        "period_join": q_period_join,
        "zscore": q_zscore,
        "ztest_pvalue": q_ztest_pvalue,
        "anomalies": q_anomalies,
        "anomalies_excl_artefacts": q_anomalies_excl,
        "anomaly_fallback": q_anomaly_fallback,
        "insight_scores": q_insight_scores,
        "diverse_topk": q_diverse_topk,
        "insights": q_insights,
        "insight_text": q_insight_text,
        "severity_counts": q_severity_counts,
        "summary": q_summary,
        "first_time_vs_returning": q_first_time_vs_returning,
        "recurring_vs_onetime": q_recurring_vs_onetime,
        "customer_type_tags": q_customer_type_tags,
        "weekly_trend_from_cube": q_weekly_trend_from_cube,
        "acquisition_cohorts": q_acquisition_cohorts,
        "cohort_matrix": q_cohort_matrix,
        "headline_trend": q_headline_trend,
        "country_breakdown": q_country_breakdown,
        "issuer_heatmap": q_issuer_heatmap,
        "waterfall": q_waterfall,
        "amount_box": q_amount_box,
        "hourly_pattern": q_hourly_pattern,
        "kpi_row": q_kpi_row,
        "insight_cards": q_insight_cards,
        "hourly_daily_rates": q_hourly_daily_rates,
        "risk_score": q_risk_score,
        "alert_windows": q_alert_windows,
        "ztest_pvalue_exact": q_ztest_pvalue_exact,
        "anomalies_exact_p": q_anomalies_exact_p,
        "alert_episodes": q_alert_episodes,
        "alert_stream": q_alert_stream,
        "segments_incremental": q_segments_incremental,
        "cohort_retention": q_cohort_retention,
        "change_points": q_change_points,
        "headline_trend_found": q_headline_trend_found,
        "disjoint_impact": q_disjoint_impact,
        "risk_score_asof": q_risk_score_asof,
        "amount_box_whiskers": q_amount_box_whiskers,
        "hourly_rates_dense": q_hourly_rates_dense,
    }
    out = {}
    for name, fn in reg.items():
        out[name] = fn if name in ("fx_normalised", "segment_drill_4d") else _binding(fn, "E")
    # binding L variants
    for name in L_VARIANTS:
        out[f"{name}_L"] = _binding(reg[name], "L")
    return out
