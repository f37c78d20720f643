"""Hard-negative mining by slot-decomposed selection.

Components become integers floor(256 * x); a row's score is its integer inner product with the
anchor. An anchor's positives are its best rows of the same label. A positive of score p admits
the rows of other labels whose score lies in the window [low % of p, high % of p], and the best
``k`` of each window are wanted. The windows of an anchor overlap.

The positives' upper limits, in descending order, cut the scores into disjoint slots: slot j holds
the scores above limit j + 1 and up to limit j. A combiner keeps the best ``k`` of a slot, since no window can
want more of it: one pass scores every row once an anchor and puts it into one slot, whatever the
number of windows it lies in. The windows end at limits, so their candidates are suffixes of the
slots: a descending merge (slot j, then what is merged of slots j + 1 on, cut at ``k``) answers
all of them, and each window drops what is below its lower end, which is a tail of its list.

Rows are packed into blocks of at most ``BLOCK_BYTES``, written to the shared folder. The anchors are the
stated query set; their blocks meet the candidates' blocks (a cross join of packed blocks, no pairs of
rows). A task keeps one block of anchors with its running selections and streams the
candidates' blocks past; no label is gathered, so a label that holds a third of all rows is spread like any other.

Scores are exact: by doubles while no sum of a block pair can reach 2**53, by Python integers beyond.

Defined results: a row with a null vec_id, label or vector, or a null or non-finite component takes no part;
an empty vector scores 0 and a missing component counts as 0; scores beyond a long are held at its
bounds before they are compared; ties go to the smaller vec_id; an anchor's own vec_id is neither
its positive nor its negative; repeated rows are candidates of their own, repeated equal anchor rows
are one anchor; an anchor without positives, or a positive whose window is empty (a negative score has
none), gives no row; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import layer

SCALE = 256
BLOCK_BYTES = 1 << 20
#: Rows of a block of anchors: their scores with a candidate block are one array.
ANCHOR_ROWS = 256
_LONG = 2**63 - 1

BLOCK = T.StructType([T.StructField("dims", T.LongType()), T.StructField("top", T.DoubleType()),
                      *(T.StructField(n, T.BinaryType()) for n in ("ids", "keys", "labels", "matrix"))])
HITS = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor_id", "akey", "slot", "vec_id", "score")])


def _rows_of(vector) -> np.ndarray | None:
    """floor(256 * x) of each component as doubles; None if the vector takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return np.floor(SCALE * np.asarray(vector, dtype=np.float64))


def _pack(most_rows: int):
    """Rows (vec_id, akey, label, vector) to blocks of equally long vectors."""
    def block(dims: int, rows: list) -> tuple:
        matrix = np.array([r[3] for r in rows], dtype=np.float64).reshape(len(rows), dims)
        longs = (np.array([r[i] for r in rows], dtype=np.int64).tobytes() for i in range(3))
        return (dims, float(np.abs(matrix).max(initial=0.0)), *longs, matrix.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list] = {}

        def emit(blocks):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*blocks, strict=True),
                                                (pa.int64(), pa.float64(), *[pa.binary()] * 4), strict=True)],
                names=BLOCK.names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vector = _rows_of(row[3])
                if vector is None or row[0] is None or row[2] is None:
                    continue
                rows = open_.setdefault(len(vector), [])
                rows.append((*row[:3], vector))
                if len(rows) >= min(most_rows, max(1, BLOCK_BYTES // (8 * max(1, len(vector))))):
                    yield emit([block(len(vector), open_.pop(len(vector)))])
            # odd lengths must not pile up over a task
            while len(open_) > 16:
                dims = next(iter(open_))
                yield emit([block(dims, open_.pop(dims))])
        for dims, rows in open_.items():
            yield emit([block(dims, rows)])

    return run


def blocks(vectors: DataFrame, most_rows: int, name: str) -> DataFrame:
    """A written layer of blocks of ``vectors(vec_id, akey, label, vector)``."""
    return layer(vectors.mapInArrow(_pack(most_rows), BLOCK), name)


def _scores(a: np.ndarray, b: np.ndarray, a_top: float, b_top: float) -> np.ndarray:
    """Exact inner products of the rows of two blocks as longs."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if a_top * b_top * max(1, dims) < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    return np.array([[max(-_LONG, min(_LONG, sum(x * y for x, y in zip(map(int, row), other, strict=True))))
                      for other in whole] for row in a], dtype=np.int64).reshape(len(a), len(b))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


class _Combiner:
    """The best ``k`` (score, vec_id) of each slot of one anchor."""

    def __init__(self, k: int):
        self.k, self.kept = k, {}

    def add(self, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if (old := self.kept.get(slot)) is not None:
            scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
        at = best(scores, ids, self.k)
        self.kept[slot] = scores[at], ids[at]


def _select(k: int, same: bool):
    """Pairs of an anchor block and a candidate block to the best rows of each anchor's slots.

    ``same``: rows of the anchor's label, all in slot 0. Otherwise rows of other labels, in the slots
    that the anchor's ``limits`` (descending) cut, from each slot's ``floors`` up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: bytes | None = None
        anchors = keys = labels = matrix = None
        top, limits, floors, kept = 0.0, [], [], []

        def drain() -> pa.RecordBatch | None:
            rows = [(int(a), int(key), slot, int(i), int(s)) for a, key, c in zip(anchors, keys, kept, strict=True)
                    for slot, (scores, ids) in c.kept.items() for s, i in zip(scores, ids, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                              names=HITS.names) if rows else None

        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                mine = {n: c[i].as_py() for n, c in cols.items() if n.startswith("a_")}
                mark = mine["a_ids"] + mine["a_keys"]
                if mark != held:  # the next block of anchors: hand over the last one's selections
                    if held is not None and (done := drain()) is not None:
                        yield done
                    held, top = mark, mine["a_top"]
                    anchors, keys, labels = (np.frombuffer(mine[n], dtype=np.int64) for n in ("a_ids", "a_keys", "a_labels"))
                    matrix = np.frombuffer(mine["a_matrix"], dtype=np.float64).reshape(len(anchors), mine["a_dims"])
                    kept = [_Combiner(k) for _ in anchors]
                    if not same:
                        limits = [np.array(x, dtype=np.int64) for x in mine["a_limits"]]
                        floors = [np.array(x, dtype=np.int64) for x in mine["a_floors"]]
                ids, groups = (np.frombuffer(cols[n][i].as_py(), dtype=np.int64) for n in ("ids", "labels"))
                other = np.frombuffer(cols["matrix"][i].as_py(), dtype=np.float64).reshape(len(ids), cols["dims"][i].as_py())
                scores = _scores(matrix, other, top, cols["top"][i].as_py())
                for n, anchor in enumerate(anchors):
                    row = scores[n]
                    if same:
                        at = np.flatnonzero((groups == labels[n]) & (ids != anchor))
                        if len(at):
                            kept[n].add(0, row[at], ids[at])
                        continue
                    if not len(limits[n]):
                        continue
                    at = np.flatnonzero((groups != labels[n]) & (ids != anchor) & (row <= limits[n][0])
                                        & (row >= floors[n].min()))
                    # limits are descending: the last one that is not below the score ends its slot
                    slot = len(limits[n]) - 1 - np.searchsorted(limits[n][::-1], row[at], side="left")
                    for j in np.unique(slot):
                        here = at[(slot == j) & (row[at] >= floors[n][j])]
                        if len(here):
                            kept[n].add(int(j), row[here], ids[here])
        if held is not None and (done := drain()) is not None:
            yield done

    return run


def _prefixed(df: DataFrame) -> DataFrame:
    return df.toDF(*(f"a_{c}" for c in df.columns))


def _ends(score: Column, percent: int) -> Column:
    """``percent`` % of a score, exact."""
    return score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(10,0)") / F.lit(100).cast("decimal(3,0)")


def positives_of(candidates: DataFrame, anchors: DataFrame, n: int) -> DataFrame:
    """(anchor_id, akey, positive_rank, positive_id, positive_score): the best rows of the same label."""
    hits = _prefixed(anchors).crossJoin(candidates).mapInArrow(_select(n, True), HITS)
    order = Window.partitionBy("anchor_id", "akey").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("positive_rank", F.row_number().over(order)).where(F.col("positive_rank") <= n).select(
        "anchor_id", "akey", "positive_rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))


def windows_of(positives: DataFrame, low: int, high: int) -> DataFrame:
    """``positives`` with each window's ends ``lo`` and ``hi`` and the slot that its upper end closes."""
    score = F.col("positive_score")
    ends = positives.withColumn("lo", F.ceil(_ends(score, low)).cast("long")).withColumn(
        "hi", F.floor(_ends(score, high)).cast("long")).where("lo <= hi")
    return ends.withColumn("slot", F.dense_rank().over(
        Window.partitionBy("anchor_id", "akey").orderBy(F.desc("hi"))).cast("long") - 1)


def _with_slots(rows: DataFrame, windows: DataFrame, name: str) -> DataFrame:
    """Blocks of anchors with their slots: descending limits, and the least score that a window which
    covers the slot admits."""
    slots = windows.groupBy("anchor_id", "akey", "slot").agg(F.max("hi").alias("hi"), F.min("lo").alias("lo"))
    above = Window.partitionBy("anchor_id", "akey").orderBy("slot")
    slots = slots.withColumn("floor", F.min("lo").over(above))
    per = slots.groupBy("anchor_id", "akey").agg(F.array_sort(F.collect_list(F.struct("slot", "hi", "floor"))).alias("s"))
    full = rows.join(per.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "akey"]).select(
        "vec_id", "akey", "label", "vector", F.col("s.hi").alias("limits"), F.col("s.floor").alias("floors"))

    def pack(batches):
        pack_rows = _pack(ANCHOR_ROWS)
        for batch in batches:
            cut = {}
            for v, key, hi, lo in zip(*(batch.column(n).to_pylist() for n in ("vec_id", "akey", "limits", "floors")), strict=True):
                cut[v, key] = hi, lo
            for packed in pack_rows([batch.select(["vec_id", "akey", "label", "vector"])]):
                for i in range(packed.num_rows):
                    at = zip(*(np.frombuffer(packed.column(n)[i].as_py(), dtype=np.int64).tolist() for n in ("ids", "keys")), strict=True)
                    mine = [cut[x] for x in at]
                    lists = pa.list_(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*packed.slice(i, 1).columns, pa.array([[m[0] for m in mine]], lists), pa.array([[m[1] for m in mine]], lists)],
                        names=[*BLOCK.names, "limits", "floors"])

    lists = T.ArrayType(T.ArrayType(T.LongType()))
    schema = T.StructType([*BLOCK.fields, T.StructField("limits", lists), T.StructField("floors", lists)])
    return layer(full.mapInArrow(pack, schema), name)


def merge_slots(hits: DataFrame, k: int) -> DataFrame:
    """(anchor_id, akey, merged): for each slot of an anchor, in order, the best ``k`` of it and all
    lower slots as (score, vec_id), by merging from the lowest slot up."""
    order = Window.partitionBy("anchor_id", "akey", "slot").orderBy(F.desc("score"), "vec_id")
    kept = hits.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    # at most k rows of each slot, so a list is bounded by k times the positives
    per = kept.groupBy("anchor_id", "akey").agg(
        F.array_sort(F.collect_list(F.struct("slot", "r", "score", "vec_id"))).alias("all"), F.max("slot").alias("last"))
    empty = F.array().cast("array<array<struct<slot:bigint,r:int,score:bigint,vec_id:bigint>>>")

    def step(acc: Column, j: Column) -> Column:
        own = F.filter("all", lambda e: e["slot"] == j)
        below = F.when(F.size(acc) > 0, F.get(acc, 0)).otherwise(F.array().cast("array<struct<slot:bigint,r:int,score:bigint,vec_id:bigint>>"))
        return F.concat(F.array(F.slice(F.concat(own, below), 1, k)), acc)

    down = F.sequence(F.col("last"), F.lit(0).cast("long"), F.lit(-1).cast("long"))
    return per.select("anchor_id", "akey", F.aggregate(down, empty, step).alias("merged"))


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, k: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``vectors`` and ``anchors`` are (vec_id, vector, label). Rows anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score, positive_rank."""
    names = ["vec_id", "vector", "label"]
    key = F.xxhash64("label", "vector").alias("akey")
    every = vectors.toDF(*names).select("vec_id", F.lit(0).cast("long").alias("akey"), F.col("label").cast("long").alias("label"), "vector")
    asked = anchors.toDF(*names).distinct().select("vec_id", key, F.col("label").cast("long").alias("label"), "vector")
    asked = layer(asked.where("vec_id is not null and label is not null and vector is not null"), "negatives-anchors")
    # full blocks of anchors from few rows
    dealt = max(1, -(-asked.count() // ANCHOR_ROWS))
    cand = blocks(every, 1 << 30, "negatives-candidates")
    found = layer(windows_of(positives_of(cand, blocks(asked.repartition(dealt), ANCHOR_ROWS, "negatives-asked"), positives),
                             low, high), "negatives-windows")
    slotted = _with_slots(asked, found, "negatives-slots")
    hits = _prefixed(slotted).crossJoin(cand).mapInArrow(_select(k, False), HITS)
    merged = merge_slots(hits, k)
    answers = found.join(merged, ["anchor_id", "akey"]).select(
        "anchor_id", "positive_id", "positive_score", "positive_rank", "lo",
        F.posexplode(F.get("merged", F.col("slot").cast("int"))).alias("at", "e"))
    return answers.where("e.score >= lo").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("negative_id"),
        "positive_score", F.col("e.score").alias("negative_score"), F.col("positive_rank").cast("int").alias("positive_rank"))
