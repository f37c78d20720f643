import os

from pyspark.sql import functions as F

from ratelens.sources import io
from ratelens.sources.bindings import transactions
from ratelens.streaming import alerts

from .conftest import SF_MID


def test_stream_equals_batch_on_closed_windows(spark, tmp_root):
    raw = transactions(spark, SF_MID, "E")
    src = os.path.join(tmp_root, "src")
    # a few files so the stream sees several micro-batches
    io.write_layer(raw.repartition(4, "transaction_id"), src)
    sink, ckpt = os.path.join(tmp_root, "sink"), os.path.join(tmp_root, "ckpt")
    q = alerts.start_alerts(spark, src, sink, ckpt, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(sink)
    # windows the watermark has closed: end <= max(event time) - delay
    max_ts = raw.agg(F.max("timestamp")).collect()[0][0]
    limit = spark.range(1).select((F.lit(max_ts) - F.expr(f"INTERVAL {alerts.WATERMARK}")).alias("t")) \
        .collect()[0][0]
    batch = alerts.alert_windows_batch(raw).where(F.col("window_end") <= F.lit(limit.strftime("%Y-%m-%d %H:%M:%S")))
    cols = batch.columns
    assert sorted(got.select(cols).collect()) == sorted(batch.collect())
    assert batch.count() > 0
