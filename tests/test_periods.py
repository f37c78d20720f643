"""Other numbers of weeks than 3 + 3, skewed customers, late rows, guards on names."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ratelens.operators.anomalies import detect_anomalies
from ratelens.operators.cohorts import acquisition_cohorts, cohort_matrix, customer_weeks
from ratelens.operators.enrich import enrich
from ratelens.operators.extensions import risk_score, time_bucket_rates
from ratelens.operators.insights import rank_insights, summary
from ratelens.operators.segments import segment_cube
from ratelens.operators.views import country_breakdown, issuer_heatmap, waterfall
from ratelens.plans import jobs
from ratelens.session import cut_lineage
from ratelens.sources import io
from ratelens.streaming import alerts

from .fixtures import START, row, to_df


@pytest.fixture(scope="module")
def eight_weeks(spark):
    rows = [row(i, week=i % 8 + 1, country="MX" if i % 3 else "BR", status="approved" if i % 8 < 4 or i % 5 else "declined",
                customer=f"c_{i % 11}", amount=10.0 + i % 50) for i in range(800)]
    return to_df(spark, rows)


@pytest.fixture(scope="module")
def cube(eight_weeks):
    return cut_lineage(segment_cube(eight_weeks, split_week=4, n_weeks=8), "eight")


def test_no_week_is_left_out(cube, eight_weeks):
    heat = issuer_heatmap(cube)
    assert [c for c in heat.columns if c.startswith("week_")] == [f"week_{w}" for w in range(1, 9)]
    last = [r.week_8 for r in heat.collect()]
    assert last == sorted(last)
    late = cut_lineage(acquisition_cohorts(eight_weeks.where("week_number >= 3")), "late")
    assert cohort_matrix(late).columns == ["cohort_week"] + [f"w{w}" for w in range(3, 9)]


def test_period_arguments_reach_every_operator(spark, cube, eight_weeks):
    an = detect_anomalies(cube, split_week=4, n_weeks=8, keep_measures=True)
    assert an.count() > 0
    with pytest.raises(ValueError, match="weeks_1_3 and weeks_4_6"):
        detect_anomalies(cube)
    ins = rank_insights(an, split_week=4, n_weeks=8)
    assert all("starting Week 5" in r.description and "per 4-week period" in r.description for r in ins.collect())
    got = summary(an, ins).first()
    rows = an.collect()
    assert got.weighted_current_rate == round(sum(r.current_approved for r in rows) / sum(r.current_total for r in rows), 4)
    early = {r.country: r.early_rate for r in country_breakdown(cube, split_week=4, n_weeks=8).collect()}
    assert early == {"MX": 1.0, "BR": 1.0}
    steps = waterfall(enrich(eight_weeks, 4, 8), 4, 8).collect()
    assert steps[0].contribution_pp == 100.0
    assert risk_score(eight_weeks, ["country"], split_week=4, n_weeks=8).count() == 400


def test_jobs_take_the_periods(spark, eight_weeks, tmp_root):
    io.write_layer(eight_weeks, jobs.paths(tmp_root)["raw"])
    jobs.segments(spark, tmp_root, 4, 8)
    assert jobs.analyze(spark, tmp_root, split_week=4, n_weeks=8)["anomalies"].count() > 0
    assert jobs.views(spark, tmp_root, 4, 8)["issuer_heatmap"].count() > 0


def test_a_type_defined_twice_raises(eight_weeks):
    with pytest.raises(ValueError, match="twice"):
        segment_cube(eight_weeks, definitions={"x": ["country"]}, declined_only={"x": ["decline_reason"]})


def test_one_customer_with_a_third_of_all_rows(spark):
    from ratelens.operators.cohorts import tag_customer_type
    rows = [row(i, week=i % 6 + 1, customer="hot" if i % 3 == 0 else f"c_{i}") for i in range(6000)]
    df = to_df(spark, rows)
    plain = sorted(tag_customer_type(df).select("transaction_id", "customer_type").collect())
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # many input partitions, so that a hot shuffle partition has pieces to split at
        tagged = tag_customer_type(df.repartition(16, "transaction_id"))
        assert sorted(tagged.select("transaction_id", "customer_type").collect()) == plain
        weeks = customer_weeks(df.repartition(16, "transaction_id"))
        assert weeks.where("customer_id = 'hot'").count() == len({r["week_number"] for r in rows if r["customer_id"] == "hot"})
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_raw_rows_are_grouped_before_they_are_expanded(eight_weeks):
    def below_first_aggregate(df):
        lines = df._jdf.queryExecution().sparkPlan().toString().split("\n")
        last = max(i for i, x in enumerate(lines) if "Aggregate" in x)
        return "\n".join(lines[last + 1:])

    for df in (waterfall(enrich(eight_weeks)), time_bucket_rates(eight_weeks), alerts.alert_windows_batch(eight_weeks)):
        text = below_first_aggregate(df)
        assert "Generate" not in text and "Expand" not in text


def test_batch_alerts_equal_direct_windows(spark, eight_weeks):
    rows = alerts.with_event_time(eight_weeks)
    for window, slide in (("6 hours", "1 hour"), ("2 hours", "2 hours"), ("90 minutes", "1 hour")):
        direct = alerts._alerts(alerts._counts(rows, window, slide, ["country"]), 0.9, 1, ["country"])
        assert sorted(alerts.alert_windows_batch(eight_weeks, window, slide, 0.9, 1).collect()) == sorted(direct.collect())


def test_late_rows_are_dropped_by_the_stream(spark, tmp_root):
    def batch(hours, n):
        return to_df(spark, [row(n * 100 + i, ts=START + dt.timedelta(hours=h), status="declined") for i, h in enumerate(hours)])

    src, sink = os.path.join(tmp_root, "src"), os.path.join(tmp_root, "sink")
    args = dict(window="1 hour", slide="1 hour", threshold=0.9, min_n=1)
    for n, hours in enumerate(([0, 0, 1], [10, 10], [0, 0, 0, 9], [30])):  # the third file's first rows are too late
        batch(hours, n).coalesce(1).write.mode("append").parquet(src)
        q = alerts.start_alerts(spark, src, sink, os.path.join(tmp_root, "ckpt"), available_now=True, **args)
        q.awaitTermination(120)
        assert q.exception() is None
    got = {r.window_start[11:13]: r.total_transactions for r in spark.read.parquet(sink).collect()}
    assert got["00"] == 2 and got["01"] == 1 and got["09"] == 1 and got["10"] == 2
    assert spark.read.parquet(sink).agg(F.count("*")).first()[0] == len(got)
