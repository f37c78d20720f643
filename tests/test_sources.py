import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratelens import contracts as C
from ratelens import session
from ratelens.operators.cohorts import cohort_payload, recurring_vs_onetime
from ratelens.sources import io

from .fixtures import row, to_df

GOOD = ('{"rank":1,"insight_id":"a","title":"t","description":"d","segment_key":"k","baseline_rate":0.8,"current_rate":0.4,'
        '"rate_change":-0.4,"affected_transactions":9,"estimated_revenue_impact_usd":1.5,"severity":"high"}')


def put(tmp_root, *lines):
    path = os.path.join(tmp_root, "insights.json")
    with open(path, "w") as f:
        f.write("\n".join(lines))
    return path


def test_good_insights_are_read(spark, tmp_root):
    got = io.read_insights_json(spark, put(tmp_root, GOOD)).collect()
    assert len(got) == 1 and got[0].rank == 1 and got[0].estimated_revenue_impact_usd == 1.5


@pytest.mark.parametrize("bad", [GOOD[:60], GOOD.replace('"rank":1', '"rank":"one"'), GOOD.replace('"rank":1,', ""), "{}"])
def test_a_broken_insight_fails_the_read(spark, tmp_root, bad):
    path = put(tmp_root, GOOD, bad)
    with pytest.raises((PySparkException, Py4JJavaError)):
        io.read_insights_json(spark, path).collect()


def test_a_broken_file_gives_way_to_the_parquet(spark, tmp_root):
    layer = os.path.join(tmp_root, "insights")
    io.write_layer(C.conform(io.read_insights_json(spark, put(tmp_root, GOOD)).withColumn("title", F.lit("stored")), C.INSIGHT), layer)
    assert io.read_insights(spark, put(tmp_root, GOOD), layer).first().title == "t"
    assert io.read_insights(spark, put(tmp_root, GOOD, GOOD[:70]), layer).first().title == "stored"
    assert io.read_insights(spark, os.path.join(tmp_root, "none.json"), layer).first().title == "stored"


def test_sample_keeps_microseconds(spark, tmp_root):
    rows = [row(i) for i in range(5)]
    for i, r in enumerate(rows):
        r["timestamp"] = r["timestamp"].replace(microsecond=123457 + i)
    path = os.path.join(tmp_root, "sample")
    io.write_sample_csv(to_df(spark, rows), path, n=4)
    assert sorted(map(tuple, io.read_sample_csv(spark, path).collect())) == sorted(map(tuple, to_df(spark, rows[:4]).collect()))


def test_layer_with_another_column_set_is_refused(spark, tmp_root):
    """S9, S10, U4 through the layer: a missing, a mistyped and an extra column."""
    path = os.path.join(tmp_root, "raw")
    for change, error in ((lambda d: d.drop("status"), "Missing required column: status"),
                          (lambda d: d.withColumn("week_number", F.col("week_number").cast("string")), "week_number")):
        io.write_layer(change(to_df(spark, [row(1)])), path)
        with pytest.raises((ValueError, C.SchemaError), match=error):
            io.read_raw(spark, path)
    io.write_layer(to_df(spark, [row(1)]).withColumn("more", F.lit(1)), path)
    with pytest.raises(ValueError, match=r"Column set differs from contract: \['more'\]"):
        C.validate(io.read_raw(spark, path), C.RAW_TRANSACTION, strict=True)


def test_payload_reads_the_raw_rows_once(spark, tmp_root):
    path = os.path.join(tmp_root, "raw")
    rows = [row(i, 1 + i % 6, status=("approved", "declined")[i % 3 == 0], recurring=(True, False, None)[i % 3]) for i in range(90)]
    io.write_layer(to_df(spark, rows), path)
    raw = spark.read.parquet(path)
    payload = cohort_payload(raw)
    assert path not in payload._jdf.queryExecution().executedPlan().toString().replace("file:", "")
    got = payload.first()
    want = sorted(tuple(r) for r in recurring_vs_onetime(raw).collect())
    assert sorted(tuple(r) for r in got.recurring_vs_onetime) == want and len(got.first_time_vs_returning) == 6


def test_registry_deletes_a_runs_layers_and_no_others(spark):
    first = session.cut_lineage(spark.range(3), "before")
    mark = session.layers_mark(spark)
    kept, gone = session.layer_path(spark, "kept"), session.layer_path(spark, "gone")
    for p in (kept, gone):
        spark.range(2).write.parquet(p)
    assert session.drop_layers(spark, since=mark, keep=kept) == 1
    assert first.count() == 3 and spark.read.parquet(kept).count() == 2 and not os.path.exists(gone.replace("file:", ""))
