"""Benchmark decontamination by size-partitioned MinHash containment search. DataFrame functions only.

Words are runs of letters and digits, lower-cased; a shingle is ``WORDS`` consecutive words. An item of fewer
words is one shingle of them all; where the benchmark has such items, documents also have a shingle at
every place for each of these lengths, so a short item is found inside a long document. A document contains an item when it holds at least
``CONTAINMENT`` of the item's distinct shingles.

Items are partitioned by size (powers of two of their shingle count). An item's sketch is the
bottom-k of its shingle hashes, k chosen by its partition so that k exceeds the number of shingles a
containing document may lack: every such document then holds at least one sketched hash, whatever
its own length, so the search over sketches loses no pair. Documents too small for an item are
passed over by size. Each found pair is verified once by the exact number of shared shingles.

Defined results: null texts and texts without a word hold nothing and items without a word are held
by nothing; rows with a null doc_id or item_id take no part; rows equal in doc_id and text count
once, rows of one doc_id with different texts are judged apart and reported with the best
containment; repeated items of one id with different texts are joined into one set; an empty table
gives an empty result; very long texts are searched whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import layer, small_side

WORDS = 5
CONTAINMENT = 0.8


def _with_shingles(rows: DataFrame, text: str, words: int, short: Sequence[int] | None = None) -> DataFrame:
    """``rows`` with ``sh``: the distinct shingle hashes of a text column, which goes.

    A text of fewer than ``words`` words is one shingle; with ``short``, any text has instead the
    shingles of these smaller lengths besides.

    Callers explode ``sh`` with the outer form and compare what follows from it under coalesce:
    a filter, also one that Spark infers, would be pushed below and compute the shingles again.
    """
    keep = [c for c in rows.columns if c != text]
    hashed = rows.select(*keep, F.transform(
        F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w)).alias("wh"))
    size = F.size("wh")
    many = F.transform(F.sequence(F.lit(0), size - words),
                       lambda i: F.xxhash64(*(F.get("wh", i + k) for k in range(words))))
    none = F.array().cast("array<bigint>")
    if short is None:
        return hashed.select(*keep, F.array_distinct(
            F.when(size >= words, many).when(size > 0, F.array(F.xxhash64("wh"))).otherwise(none)).alias("sh"))

    def runs(k: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), size - (k - 1)), lambda i: F.xxhash64(F.slice("wh", i, k)))
        return F.when(size >= k, every).otherwise(none)

    return hashed.select(*keep, F.array_distinct(F.concat(
        F.when(size >= words, many).otherwise(none), *(runs(k) for k in short))).alias("sh"))


def short_lengths(items: DataFrame, text: str, words: int) -> list[int]:
    """The word counts below ``words`` that items have: fewer than ``words`` numbers, whatever the table."""
    size = F.size(F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), ""))
    counts = items.select(size.alias("n")).where(F.col("n").between(1, words - 1)).distinct()
    return sorted(r["n"] for r in counts.collect())


def _allowed_missing(n: Column, containment: float) -> Column:
    """Shingles of n that a containing document may lack."""
    return n - _needed(n, containment)


def _needed(n: Column, containment: float) -> Column:
    # thousandths keep the threshold exact
    return F.ceil(n * round(containment * 1000) / F.lit(1000)).cast("int")


def sketches(items: DataFrame, containment: float) -> DataFrame:
    """Of items (item_id, sh): rows (hash, item_id, need): the bottom-k of each by its size class."""
    sized = items.select("item_id", F.size("sh").alias("n"), F.sort_array("sh").alias("sh"))
    upper = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("int") - 1
    k = F.least(F.col("n"), _allowed_missing(upper, containment) + 1)
    return sized.select("item_id", _needed(F.col("n"), containment).alias("need"),
                        F.explode(F.slice("sh", 1, k)).alias("hash"))


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS,
                 containment: float = CONTAINMENT) -> DataFrame:
    """Pairs of ``docs(doc_id, text)`` and ``benchmark(item_id, text)`` with the containment:
    doc_id, dkey (hash of the text), item_id, n_item, n_shared, containment."""
    known = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    short = short_lengths(known, "text", words)
    items = _with_shingles(known, "text", words)
    items = layer(items.select("item_id", F.explode_outer("sh").alias("s")).where("s is not null").groupBy("item_id")
                  .agg(F.collect_set("s").alias("sh")), "bench-items")
    sketch = layer(sketches(items, containment), "bench-sketch")
    keyed = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("dkey"), "text")
    # the size first, so that the exploded rows don't carry the array
    postings = (_with_shingles(keyed, "text", words, short).select("doc_id", "dkey", F.size("sh").alias("size"), "sh")
                .select("doc_id", "dkey", "size", F.explode_outer("sh").alias("hash")))
    pairs = (postings.join(small_side(sketch), "hash").where("coalesce(size, 0) >= need")
             .groupBy("doc_id", "dkey", "item_id").agg(F.count("*").alias("hits")))
    found = layer(pairs.groupBy("doc_id", "dkey").agg(F.collect_list("item_id").alias("items")), "bench-found")
    again = keyed.join(small_side(found), ["doc_id", "dkey"])
    full = _with_shingles(again, "text", words, short).select("doc_id", "dkey", F.col("sh").alias("held"),
                                                       F.explode_outer("items").alias("item_id"))
    shared = F.coalesce(F.size(F.array_intersect("held", "sh")), F.lit(0))
    checked = (full.join(small_side(items), "item_id")
               .select("doc_id", "dkey", "item_id", F.size("sh").alias("n"), shared.alias("m"))
               .where(F.col("m") >= _needed(F.col("n"), containment)))
    return (checked.groupBy("doc_id", "dkey", "item_id")  # repeated rows of a document
            .agg(F.max("n").cast("long").alias("n_item"), F.max("m").cast("long").alias("n_shared"))
            .withColumn("containment", F.round(F.col("n_shared") / F.col("n_item"), 6)))


def keep_clean(docs: DataFrame, benchmark: DataFrame, words: int = WORDS,
               containment: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` (all columns) that contain no benchmark item."""
    bad = layer(contaminated(docs, benchmark, words, containment)
                .select(F.col("doc_id").alias("__id"), F.col("dkey").alias("__key")).distinct(), "bench-bad")
    return docs.join(small_side(bad), (docs["doc_id"] == bad["__id"])
                     & (F.xxhash64(docs["text"]) == bad["__key"]), "left_anti")
