"""X1 as a run of states: a segment falls below the threshold once and recovers once.

``alert_windows_batch`` reports every window below the threshold, so one bad day repeats. Here each
segment has a state that its windows, in time order, turn: the first window below the threshold is
``fell``, the first one after it that is not is ``recovered``; windows of fewer than ``min_n`` transactions say nothing and
leave the state as it is.

* Batch: gaps and islands over the windows. Rows are counted once per pane of one slide; only panes and
  windows are ordered, so a segment's group is bounded by the time axis, never by its rows.
* Stream: three chained stateful operators in append mode -- panes, windows of panes (by
  ``window_time``, so the watermark carries on), and a state of one flag per segment that turns
  the closed windows into transitions. A segment that holds a third of all rows is counted by partial aggregation before
  its panes reach one task. The state of a pane or window goes when the watermark passes it.

A stream over finite input equals the batch form over all windows that its watermark has closed (end at or
before the greatest event time less the delay).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from . import alerts as X

FELL, RECOVERED = "fell", "recovered"
#: The last operator keeps its state in Spark's RocksDB store, the only one it runs on.
STORE = ("spark.sql.streaming.stateStore.providerClass",
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
KNOWN = ["window_end", "total_transactions", "approved_transactions", "approval_rate"]


def _rate() -> Column:
    return F.col("approved_transactions").cast("double") / F.col("total_transactions").cast("double")


def judged_windows(df: DataFrame, window: str = X.WINDOW, slide: str = X.SLIDE, min_n: int = X.MIN_N,
                   dims=X.DIMS) -> DataFrame:
    """(dims, window_end, total_transactions, approved_transactions, approval_rate) of a bounded
    table's sliding windows with at least ``min_n`` transactions."""
    rows = X.with_event_time(df.where(F.col("timestamp").isNotNull()))
    counted = X._windows_of_panes(rows, window, slide, list(dims)).where(F.col("total_transactions") >= F.lit(min_n))
    return counted.select(*dims, F.col("w.end").alias("window_end"), "total_transactions", "approved_transactions",
                          _rate().alias("approval_rate"))


def transitions(windows: DataFrame, threshold: float = X.THRESHOLD, dims=X.DIMS) -> DataFrame:
    """The windows at which a segment's state turns, with ``event``: ``fell`` or ``recovered``."""
    order = Window.partitionBy(*dims).orderBy("window_end")
    below = F.col("approval_rate") < F.lit(threshold)
    turned = windows.withColumn("_below", below).withColumn("_before", F.lag("_below", 1, False).over(order))
    return turned.where(F.col("_below") != F.col("_before")).select(
        *dims, F.when(F.col("_below"), F.lit(FELL)).otherwise(F.lit(RECOVERED)).alias("event"), *KNOWN)


def episodes(windows: DataFrame, threshold: float = X.THRESHOLD, dims=X.DIMS) -> DataFrame:
    """One row per episode below the threshold: fell_at, recovered_at (null while it lasts), n_windows,
    lowest_rate."""
    order = Window.partitionBy(*dims).orderBy("window_end")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.col("approval_rate") < F.lit(threshold)
    marked = windows.withColumn("_below", below).withColumns({
        "_starts": F.col("_below") & ~F.lag("_below", 1, False).over(order),
        "_next": F.lead("window_end").over(order)})
    islands = marked.withColumn("_island", F.count_if(F.col("_starts")).over(upto)).where("_below")
    return islands.groupBy(*dims, "_island").agg(
        F.min("window_end").alias("fell_at"), F.max_by("_next", "window_end").alias("recovered_at"),
        F.count(F.lit(1)).alias("n_windows"), F.min("approval_rate").alias("lowest_rate")).drop("_island")


class _Turns(StatefulProcessor):
    """Keeps one flag per segment (is it below the threshold) and reports the windows that turn it."""

    def __init__(self, threshold: float, names: list[str]):
        self.threshold, self.names = threshold, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.low = handle.getValueState("low", T.StructType([T.StructField("low", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = self.low.get()[0] if self.low.exists() else False
        found = []
        # windows that close in one trigger come in any order
        for row in pd.concat(list(rows)).sort_values("window_end")[KNOWN].itertuples(index=False):
            if (row.approval_rate < self.threshold) != low:
                low = not low
                found.append((*key, FELL if low else RECOVERED, *row))
        self.low.update((low,))
        yield pd.DataFrame(found, columns=self.names)

    def close(self) -> None:
        pass


def episode_stream(stream: DataFrame, window: str = X.WINDOW, slide: str = X.SLIDE, threshold: float = X.THRESHOLD,
                   min_n: int = X.MIN_N, dims=X.DIMS, watermark: str = X.WATERMARK) -> DataFrame:
    """Transitions over a stream of raw transactions (append mode)."""
    if X._seconds(window) % X._seconds(slide):
        raise ValueError(f"the window ({window}) must be a whole number of slides ({slide})")
    dims = list(dims)
    rows = X.with_event_time(stream.where(F.col("timestamp").isNotNull())).withWatermark("event_time", watermark)
    panes = X._counts(rows, slide, None, dims)
    counted = panes.groupBy(F.window(F.window_time("w"), window, slide).alias("w"), *dims).agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("approved_transactions").alias("approved_transactions"))
    closed = counted.where(F.col("total_transactions") >= F.lit(min_n)).select(
        *dims, F.col("w.end").alias("window_end"), "total_transactions", "approved_transactions",
        _rate().alias("approval_rate"))
    fields = {f.name: f for f in closed.schema.fields}
    out = T.StructType([*(fields[d] for d in dims), T.StructField("event", T.StringType()), *(fields[c] for c in KNOWN)])

    return closed.groupBy(*dims).transformWithStateInPandas(
        _Turns(threshold, out.names), out, "Append", "None")


def start_episodes(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                   available_now: bool = True, max_files_per_trigger: int | None = None, **params) -> StreamingQuery:
    """Run the stream from a parquet folder into a parquet sink (exactly-once via checkpoint)."""
    out = episode_stream(X.read_transactions_stream(spark, source_path, max_files_per_trigger), **params)
    w = (out.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint_path).option("path", sink_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    # a query takes over the session's settings when it starts
    before = spark.conf.get(STORE[0])
    spark.conf.set(*STORE)
    try:
        return w.start()
    finally:
        spark.conf.set(STORE[0], before)
