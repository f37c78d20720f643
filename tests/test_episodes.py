import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ratelens.sources import io
from ratelens.sources.bindings import transactions
from ratelens.streaming import alerts, episodes

from .conftest import SF_MID
from .fixtures import START, row, to_df


def hours(spec, country="MX", first=0):
    """Ten transactions an hour; ``spec`` gives the approved ones of each (None: no traffic)."""
    out = []
    for h, ok in enumerate(spec):
        for j in range(10 if ok is not None else 0):
            i = first + h * 10 + j
            out.append(row(i, 1, country, status="approved" if j < ok else "declined", ts=START + dt.timedelta(hours=h, minutes=j)))
    return out


def test_one_alert_when_it_falls_and_one_when_it_recovers(spark):
    spec = [9, 9, 2, 3, 1, 9, 9, None, None, 8, 1, 1]
    df = to_df(spark, hours(spec) + hours([9] * 12, "BR", 1000))
    judged = episodes.judged_windows(df, window="1 hour", slide="1 hour", min_n=5)
    turns = [(r.country, r.event, r.window_end.hour) for r in episodes.transitions(judged).orderBy("window_end").collect()]
    # the hours without traffic say nothing; the second episode is still open
    assert turns == [("MX", "fell", 3), ("MX", "recovered", 6), ("MX", "fell", 11)]
    got = [(r.fell_at.hour, r.recovered_at.hour if r.recovered_at else None, r.n_windows, r.lowest_rate)
           for r in episodes.episodes(judged).orderBy("fell_at").collect()]
    assert got == [(3, 6, 3, 0.1), (11, None, 2, 0.1)]


def test_thin_windows_leave_the_state(spark):
    rows = hours([2, 9, 2])
    df = to_df(spark, [r for r in rows if not (r["timestamp"].hour == 1 and r["timestamp"].minute > 2)])
    judged = episodes.judged_windows(df, window="1 hour", slide="1 hour", min_n=5)
    assert [r.n_windows for r in episodes.episodes(judged).collect()] == [2]


def closed(df, limit):
    return sorted(map(tuple, df.where(F.col("window_end") <= F.lit(limit)).collect()))


def test_stream_equals_batch_on_closed_windows(spark, tmp_root):
    raw = transactions(spark, SF_MID, "E")
    src = os.path.join(tmp_root, "src")
    io.write_layer(raw.repartition(4, "transaction_id"), src)
    before = spark.conf.get(episodes.STORE[0])
    q = episodes.start_episodes(spark, src, os.path.join(tmp_root, "sink"), os.path.join(tmp_root, "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None and spark.conf.get(episodes.STORE[0]) == before
    want = episodes.transitions(episodes.judged_windows(raw))
    limit = raw.agg(F.max("timestamp")).first()[0] - dt.timedelta(hours=2)
    got = spark.read.parquet(os.path.join(tmp_root, "sink")).select(want.columns)
    assert sorted(map(tuple, got.collect())) == closed(want, limit) and got.count() > 0


def test_state_lasts_over_triggers_and_restarts(spark, tmp_root):
    """Files arrive one by one, the query is stopped between them: no fall is reported twice."""
    spec = [9, 9, 2, 3, 1, 2, 9, 9, 1, 1, 9, 9, 9, 9, 9, 9, 9]
    rows = hours(spec)
    src, sink, ckpt = (os.path.join(tmp_root, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    for part in (rows[:40], rows[40:90], rows[90:]):
        to_df(spark, part).coalesce(1).write.mode("append").parquet(src)
        q = episodes.start_episodes(spark, src, sink, ckpt, window="1 hour", slide="1 hour", watermark="1 hour")
        q.awaitTermination(300)
        assert q.exception() is None
    got = [(r.event, r.window_end.hour) for r in spark.read.parquet(sink).orderBy("window_end").collect()]
    assert got == [("fell", 3), ("recovered", 7), ("fell", 9), ("recovered", 11)]


def test_uneven_slides_are_refused(spark, tmp_root):
    stream = alerts.read_transactions_stream(spark, tmp_root)
    with pytest.raises(ValueError, match="whole number"):
        episodes.episode_stream(stream, window="6 hours", slide="4 hours")
    with pytest.raises(ValueError, match="month"):
        episodes.episode_stream(stream, window="1 month", slide="1 hour")
