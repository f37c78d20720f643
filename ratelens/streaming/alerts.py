"""Alert when a segment's approval rate falls below a threshold, per sliding window.

The same alert runs in batch (``alert_windows_batch``) and as a
Structured Streaming query (``alert_stream``): event-time sliding windows with
a watermark, append output, so late rows beyond the watermark are dropped and
state for closed windows is released. A stream emits a window once the
watermark passes its end, so over a finite input it returns the batch result
for every window that ends at or before ``max(event time) - delay``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contracts as C
from ..functions.columns import is_approved

WINDOW = "6 hours"
SLIDE = "1 hour"
THRESHOLD = 0.6
MIN_N = 5
DIMS = ("country",)
WATERMARK = "2 hours"
_TS_FMT = "yyyy-MM-dd HH:mm:ss"


def with_event_time(df: DataFrame) -> DataFrame:
    """Watermarks need TIMESTAMP; the contract's wall-clock TIMESTAMP_NTZ is read in the
    session time zone (UTC in our jobs), so window bounds print as the wall clock."""
    return df.withColumn("event_time", F.col("timestamp").cast("timestamp"))


def _counts(df: DataFrame, window: str, slide: str | None, dims) -> DataFrame:
    return (df.groupBy(F.window("event_time", window, slide).alias("w"), *dims)
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.count_if(is_approved()).alias("approved_transactions")))


def _seconds(duration: str) -> int:
    known = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    n, _, unit = duration.strip().partition(" ")
    if not n.isdigit() or unit.strip().rstrip("s") not in known:
        raise ValueError(f"a duration is a whole number of {', '.join(known)}s, got {duration!r}")
    return int(n) * known[unit.strip().rstrip("s")]


def _windows_of_panes(df: DataFrame, window: str, slide: str, dims) -> DataFrame:
    """The counts of sliding windows from those of panes of one slide: the rows are counted
    once, and only the panes are expanded."""
    width, step = _seconds(window), _seconds(slide)
    if width % step:
        return _counts(df, window, slide, dims)
    panes = _counts(df, slide, None, dims)
    start = F.timestamp_seconds(F.unix_timestamp("w.start") - F.col("k") * step)
    return (panes.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(width // step - 1))))
            .groupBy(start.alias("start"), *dims)
            .agg(F.sum("total_transactions").alias("total_transactions"),
                 F.sum("approved_transactions").alias("approved_transactions"))
            .withColumn("w", F.struct("start", F.timestamp_seconds(F.unix_timestamp("start") + width).alias("end"))))


def _alerts(agg: DataFrame, threshold: float, min_n: int, dims) -> DataFrame:
    rate = F.col("approved_transactions").cast("double") / F.col("total_transactions").cast("double")
    return (agg.withColumn("approval_rate", rate)
            .where((F.col("approval_rate") < F.lit(threshold)) & (F.col("total_transactions") >= F.lit(min_n)))
            .select(F.date_format("w.start", _TS_FMT).alias("window_start"),
                    F.date_format("w.end", _TS_FMT).alias("window_end"),
                    *dims, "total_transactions", "approved_transactions", "approval_rate"))


def alert_windows_batch(df: DataFrame, window: str = WINDOW, slide: str = SLIDE, threshold: float = THRESHOLD,
                        min_n: int = MIN_N, dims=DIMS) -> DataFrame:
    """Batch equivalent over a bounded table of raw transactions."""
    rows = with_event_time(df.where(F.col("timestamp").isNotNull()))
    return _alerts(_windows_of_panes(rows, window, slide, list(dims)), threshold, min_n, list(dims))


def alert_stream(stream: DataFrame, window: str = WINDOW, slide: str = SLIDE, threshold: float = THRESHOLD,
                 min_n: int = MIN_N, dims=DIMS, watermark: str = WATERMARK) -> DataFrame:
    """Streaming alerts over a stream of raw transactions (append mode)."""
    rows = with_event_time(stream).withWatermark("event_time", watermark)
    return _alerts(_counts(rows, window, slide, list(dims)), threshold, min_n, list(dims))


def read_transactions_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of raw-transaction parquet files (schema fixed by the contract)."""
    r = spark.readStream.schema(C.RAW_TRANSACTION)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def start_alerts(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str,
                 available_now: bool = True, **params) -> StreamingQuery:
    """Run the alert stream from a parquet folder into a parquet sink (exactly-once via checkpoint)."""
    out = alert_stream(read_transactions_stream(spark, source_path), **params)
    w = (out.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint_path).option("path", sink_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
