import os

from ratelens import contracts as C
from ratelens.plans import jobs
from ratelens.sources import io

from .conftest import SF_SMALL
from .fixtures import same_schema


def test_run_all_layers_round_trip(spark, tmp_root, capsys):
    jobs.run_all(spark, SF_SMALL, tmp_root, "E")
    p = jobs.paths(tmp_root)
    seg = io.read_layer(spark, p["segments"], C.SEGMENT)
    assert same_schema(seg.schema, C.SEGMENT) and seg.count() == 1292
    assert sorted(os.listdir(p["segments"]))[0].startswith("_") or any(
        d.startswith("period=") for d in os.listdir(p["segments"]))
    # F4 filters prune the period partitions
    seg.where("period = 'weeks_1_3'").explain()
    assert "PartitionFilters: [isnotnull(period" in capsys.readouterr().out
    ins = io.read_layer(spark, p["insights"], C.INSIGHT)
    js = io.read_insights_json(spark, p["insights_json"])
    assert sorted(ins.collect()) == sorted(js.collect())
    summary = spark.read.json(p["summary"]).collect()[0]
    assert summary.anomalies_detected == io.read_layer(spark, p["anomalies"], C.ANOMALY) \
        .where("is_anomaly").count()
    cohort = spark.read.json(p["cohorts"]).collect()[0]
    assert len(cohort.first_time_vs_returning) == 6 and cohort.acquisition_cohorts
    sample = spark.read.option("header", True).csv(p["sample"])
    assert sample.count() == 100 and "transaction_id" in sample.columns
    for name in ("headline_trend", "country_breakdown", "issuer_heatmap", "waterfall", "amount_box",
                 "hourly_pattern", "kpi_row", "insight_cards"):
        assert spark.read.parquet(f"{p['views']}/{name}").count() > 0
