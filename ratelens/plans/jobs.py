"""End-to-end jobs, spark-submit style: ingest, segments, analyze, cohorts, views.

Stages hand over through parquet layers under one output root (the
reference's layered file contract), so each job reads only the small layer it
needs and a failed job is re-run from the last written layer:

    <root>/raw/transactions            layer 1 (raw contract)
    <root>/raw/sample_csv              first 100 rows, header (S8)
    <root>/processed/segments          partitioned by period (S7)
    <root>/processed/weekly_trends
    <root>/analytics/anomalies
    <root>/analytics/insights          parquet + insights_json (S12)
    <root>/analytics/summary_json      one object (S13)
    <root>/analytics/cohort_json       three record arrays (S14)
    <root>/views/<name>                V1-V6, C12, C13

Usage: spark-submit ... ratelens/plans/jobs.py <ingest|segments|analyze|cohorts|views|all> <root>
       [sf_dir [binding [split_week n_weeks]]]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from .. import contracts as C
from ..operators import anomalies as A
from ..operators import cohorts as K
from ..operators import insights as I
from ..operators import segments as S
from ..operators import trends as T
from ..operators import views as V
from ..operators.enrich import enrich
from ..session import drop_layers
from ..sources import io
from ..sources.bindings import transactions


def paths(root: str) -> dict[str, str]:
    r = root.rstrip("/")
    return {
        "raw": f"{r}/raw/transactions",
        "sample": f"{r}/raw/sample_csv",
        "segments": f"{r}/processed/segments",
        "trends": f"{r}/processed/weekly_trends",
        "anomalies": f"{r}/analytics/anomalies",
        "insights": f"{r}/analytics/insights",
        "insights_json": f"{r}/analytics/insights_json",
        "summary": f"{r}/analytics/summary_json",
        "cohorts": f"{r}/analytics/cohort_json",
        "views": f"{r}/views",
    }


def ingest(spark: SparkSession, sf_dir: str, root: str, binding: str = "E") -> DataFrame:
    """Bind the driver tables to the raw contract and write layer 1 (+ CSV sample)."""
    p = paths(root)
    raw = C.validate(transactions(spark, sf_dir, binding), C.RAW_TRANSACTION, strict=True)
    io.write_layer(raw, p["raw"])
    io.write_sample_csv(spark.read.parquet(p["raw"]), p["sample"])
    return io.read_raw(spark, p["raw"])


def segments(spark: SparkSession, root: str, split_week: int = C.SPLIT_WEEK,
             n_weeks: int = C.N_WEEKS) -> dict[str, DataFrame]:
    """Entry 1: raw -> enrich -> KPI, segment cube, weekly trend -> layers."""
    p = paths(root)
    raw = io.read_raw(spark, p["raw"])
    cube = S.segment_cube(enrich(raw, split_week, n_weeks), split_week=split_week, n_weeks=n_weeks)
    # the cube is written once; the weekly trend is re-rolled from it (no 2nd raw scan)
    io.write_layer(cube, p["segments"], partition_by=["period"])
    seg = io.read_layer(spark, p["segments"], C.SEGMENT)
    io.write_layer(T.weekly_trends_from_segments(seg), p["trends"])
    return {"segments": seg, "trends": io.read_layer(spark, p["trends"], C.WEEKLY_TREND),
            "kpi": T.overall_kpi(raw)}


def analyze(spark: SparkSession, root: str, top_n: int = C.TOP_N, min_n: int = C.MIN_N,
            split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> dict[str, DataFrame]:
    """Entry 2: segments -> anomalies -> insights + summary (parquet and JSON)."""
    p = paths(root)
    seg = io.read_layer(spark, p["segments"], C.SEGMENT)   # F4 filters prune the period partitions
    measured = A.detect_anomalies(seg, split_week=split_week, n_weeks=n_weeks, keep_measures=True)
    io.write_layer(C.conform(measured, C.ANOMALY), p["anomalies"])
    anomalies = io.read_layer(spark, p["anomalies"], C.ANOMALY)
    insights = I.rank_insights(anomalies, top_n=top_n, min_n=min_n, split_week=split_week, n_weeks=n_weeks)
    io.write_layer(insights, p["insights"])
    insights = io.read_layer(spark, p["insights"], C.INSIGHT)
    io.write_json(insights.orderBy("rank"), p["insights_json"], single_file=True)
    io.write_json(I.summary(measured, insights), p["summary"], single_file=True)
    drop_layers(spark)
    return {"anomalies": anomalies, "insights": insights}


def cohorts(spark: SparkSession, root: str) -> DataFrame:
    """Entry 3: raw -> three cohort views -> one nested JSON object."""
    p = paths(root)
    payload = K.cohort_payload(io.read_raw(spark, p["raw"]))
    io.write_json(payload, p["cohorts"], single_file=True)
    return spark.read.json(p["cohorts"])


def views(spark: SparkSession, root: str, split_week: int = C.SPLIT_WEEK,
          n_weeks: int = C.N_WEEKS) -> dict[str, DataFrame]:
    """Entry 4: the data sets behind the dashboard views, one parquet table each."""
    p = paths(root)
    raw = io.read_raw(spark, p["raw"])
    enriched = enrich(raw, split_week, n_weeks)
    seg = io.read_layer(spark, p["segments"], C.SEGMENT)
    trends = io.read_layer(spark, p["trends"], C.WEEKLY_TREND)
    insights = io.read_layer(spark, p["insights"], C.INSIGHT)
    out = {
        "headline_trend": V.headline_trend(trends),
        "country_breakdown": V.country_breakdown(seg, split_week=split_week, n_weeks=n_weeks),
        "issuer_heatmap": V.issuer_heatmap(seg),
        "waterfall": V.waterfall(enriched, split_week, n_weeks),
        "amount_box": V.amount_box(enriched),
        "hourly_pattern": V.hourly_pattern(enriched),
        "kpi_row": V.kpi_row(trends, insights),
        "insight_cards": V.insight_cards(insights),
    }
    for name, df in out.items():
        io.write_layer(df, f"{p['views']}/{name}")
    drop_layers(spark)
    return {name: spark.read.parquet(f"{p['views']}/{name}") for name in out}


def run_all(spark: SparkSession, sf_dir: str, root: str, binding: str = "E",
            split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> None:
    ingest(spark, sf_dir, root, binding)
    segments(spark, root, split_week, n_weeks)
    analyze(spark, root, split_week=split_week, n_weeks=n_weeks)
    cohorts(spark, root)
    views(spark, root, split_week, n_weeks)


def main(argv: list[str]) -> None:
    cmd, root = argv[0], argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    binding = argv[3] if len(argv) > 3 else "E"
    weeks = [int(x) for x in argv[4:6]]  # split_week n_weeks
    # master, memory and partitions come from spark-submit
    spark = SparkSession.builder.appName("ratelens-jobs").getOrCreate()
    steps = {
        "ingest": lambda: ingest(spark, sf_dir, root, binding),
        "segments": lambda: segments(spark, root, *weeks),
        "analyze": lambda: analyze(spark, root, C.TOP_N, C.MIN_N, *weeks),
        "cohorts": lambda: cohorts(spark, root),
        "views": lambda: views(spark, root, *weeks),
        "all": lambda: run_all(spark, sf_dir, root, binding, *weeks),
    }
    steps[cmd]()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

