"""Layer sources and sinks.

Layers are parquet datasets (one directory each); JSON sinks are JSON-lines so
they are written in parallel and read back without ``multiLine``. A missing
input is an error -- there are no silent fallbacks to generated data.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C


#: Time stamps of the CSV sample, to the microsecond (Spark's default writes milliseconds).
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_raw(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """Raw transactions; validated against the contract."""
    df = spark.read.parquet(path)
    return C.validate(df, C.RAW_TRANSACTION) if validate else df


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet layer, conformed back to contract order.

    Partition columns come back last from a partitioned write; conform fixes that.
    """
    return C.conform(C.validate(spark.read.parquet(path), schema), schema)


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Parquet sink. Segments are partitioned by period so F4 filters prune."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_sample_csv(df: DataFrame, path: str, n: int = 100,
                     order_by: list[str] | None = None) -> None:
    """First ``n`` rows (a top-n by ``order_by``) as one CSV file with a header."""
    ordered = df.orderBy(*(order_by or ["timestamp", "transaction_id"]))
    out = ordered.limit(n).coalesce(1).write.mode("overwrite").option("header", True)
    out.option("timestampNTZFormat", CSV_TIME).option("timestampFormat", CSV_TIME).csv(path)


def read_sample_csv(spark: SparkSession, path: str) -> DataFrame:
    """The sample, typed by the raw contract; a broken row fails the read."""
    rows = spark.read.schema(C.RAW_TRANSACTION).option("header", True).option("mode", "FAILFAST")
    return rows.option("timestampNTZFormat", CSV_TIME).option("timestampFormat", CSV_TIME).csv(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON-lines sink. ``single_file`` only for one-row / top-k outputs."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


def read_insights_json(spark: SparkSession, path: str, multiline: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Insights JSON with the contract schema (no inference).

    A broken or cut-off record, or a value of another type, fails the read (``FAILFAST``); ``mode`` may name
    Spark's ``DROPMALFORMED`` or ``PERMISSIVE``. A record without a rank, a segment's title or a severity is
    no insight and fails too, whatever the mode.
    """
    rows = spark.read.schema(C.INSIGHT).option("multiLine", multiline).option("mode", mode).json(path)
    if mode == "PERMISSIVE":
        return rows
    needed = ("rank", "insight_id", "title", "severity")
    empty = F.raise_error(F.lit(f"an insight in {path} lacks one of {', '.join(needed)}"))
    missing = F.lit(False)
    for c in needed:
        missing = missing | F.col(c).isNull()
    return rows.withColumn("rank", F.when(missing, empty.cast("int")).otherwise(F.col("rank")))


def read_insights(spark: SparkSession, json_path: str, parquet_path: str) -> DataFrame:
    """The insights of the JSON file, or of the parquet layer where the file is broken.

    The file (a top-k) is read to its end before it is trusted.
    """
    try:
        rows = read_insights_json(spark, json_path)
        rows.write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError):
        return read_layer(spark, parquet_path, C.INSIGHT)
    return rows
