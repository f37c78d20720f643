"""Helpers the operators of this subpackage share: tables, layers, Arrow row maps, components."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ratelens.session import cut_lineage, drop_layer, settings

#: A side of a join is broadcast only when its measured bytes stay below this.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch of texts: Spark's 10,000 are tens of MB of text on both sides of a task.
BATCH_ROWS = 1024
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def layer(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back (cuts lineage).

    While it is written, rows go to Python in batches of at most ``BATCH_ROWS``.
    """
    spark = df.sparkSession
    before = spark.conf.get(_BATCH, None)
    small = before is not None and 0 < int(before) <= BATCH_ROWS
    with settings(spark, {} if small else {_BATCH: str(BATCH_ROWS)}):
        return cut_lineage(df, name)


def row_width(df: DataFrame) -> Column:
    """Bytes of a row: the real length of its texts, bytes and arrays, 8 for every other column."""
    total = F.lit(32).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            total = total + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 8
        elif isinstance(f.dataType, T.ArrayType):
            total = total + F.greatest(F.coalesce(F.size(F.col(f.name)), F.lit(0)), F.lit(0)) * 8 + 8
        else:
            total = total + 8
    return total


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (a written layer, so it is cheap to measure) marked for broadcast if its bytes allow it.

    Beyond ``BROADCAST_BYTES`` the plain frame is returned and the join shuffles.
    """
    size = df.agg(F.sum(row_width(df))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until ``df`` has no column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 = 0; a null doc_id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trainable(doc_id: Column) -> Column:
    """Rows a model may learn from: an id whose crc32 is not 0 mod 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


#: Rows of an Arrow batch that are Python objects at one time.
SLICE = 512


def row_tuples(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch, turned into Python objects a slice at a time."""
    for at in range(0, batch.num_rows, SLICE):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns), strict=True)


def give_back() -> None:
    """Hand back the memory that Arrow and the C library keep for reuse: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_rows(df: DataFrame, make: Callable[[], Callable[[Iterator[tuple]], Iterable[tuple]]],
             schema: T.StructType) -> DataFrame:
    """Arrow-batched row map: ``make()`` runs once per task and returns a function from the row
    tuples of a batch to output tuples. ``SLICE`` rows, in or out, are Python objects at a time."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            made = iter(fn(row_tuples(batch)))
            while rows := list(islice(made, SLICE)):
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)
            del batch, made
        del fn
        give_back()

    return df.mapInArrow(run, schema)


def utf32(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def crc_bytes(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root), root the smallest node reached.

    Alternates large-star and small-star steps (each a group-by with partial aggregation of the
    minimum, then one join), every round written to the shared folder in place of the last. A round is linear in
    the edges; the rounds grow with the logarithm of the longest path. Nothing goes to the driver but
    two numbers a round. A graph that is not done after ``max_rounds`` raises.
    """
    und = edges.where("a is not null and b is not null and a <> b")
    cur = layer(und.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(),
                f"{name}-edges")
    before = None
    for _ in range(max_rounds):
        # large star: each node's larger neighbours point to the least node of its neighbourhood
        both = cur.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            cur.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: each node and its smaller neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, cur = cur, layer(small, name)
        drop_layer(last)
        state = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components are not done after {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
