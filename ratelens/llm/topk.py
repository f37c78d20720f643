"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are integer sparse rows: component x becomes floor(256 * x), zeros are left out. Rows are
packed into blocks of one Arrow batch. Each pair of a query block and a candidate block is scored by
scattering, term by term, the query's weights times the term's postings into a dense score array;
the block's k best are selected by partition and the lists of all blocks are merged by a window.

The query rows are the stated set (ids divisible by ``every``); they meet all candidates in blocks,
so a task holds two blocks at a time, whatever the size of either side.

Defined results: a vector that is null, or holds a null or non-finite component, takes no part; an
empty vector scores 0 with everything; a missing dimension counts as 0; ties go to the smaller
vec_id; a query's own id is no candidate of its own; repeated candidate rows are separate candidates,
repeated equal query rows are one query; rows with a null vec_id take no part; scores beyond a long are held at its bounds; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 256
_LONG = 2**63 - 1

BLOCK = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())),
                      T.StructField("ptr", T.ArrayType(T.LongType())),
                      T.StructField("dims", T.ArrayType(T.IntegerType())),
                      T.StructField("weights", T.ArrayType(T.DoubleType()))])
HITS = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("q", T.LongType()),
                     T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def quantise(vector) -> list[float] | None:
    """floor(256 * x) of each component; None if the vector takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [float(math.floor(SCALE * x)) for x in vector]


def _pack(batches):
    """Each Arrow batch as one block of sparse rows (term ids and weights, row by row)."""
    import pyarrow as pa

    for batch in batches:
        ids, ptr, dims, weights = [], [0], [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            row = quantise(vector)
            if row is None or vec_id is None:
                continue
            ids.append(vec_id)
            for d, x in enumerate(row):
                if x:
                    dims.append(d)
                    weights.append(x)
            ptr.append(len(dims))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([ptr], pa.list_(pa.int64())),
                 pa.array([dims], pa.list_(pa.int32())), pa.array([weights], pa.list_(pa.float64()))],
                names=[f.name for f in BLOCK])


def blocks(vectors: DataFrame) -> DataFrame:
    return vectors.mapInArrow(_pack, BLOCK)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id: partition, then sort what is left."""
    at = np.arange(len(scores))
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def score_block(ids, postings, q_id: int, q_dims, q_weights, k: int, exact: bool):
    """The k best of a candidate block for one query: (vec_id, score) pairs."""
    acc = np.zeros(len(ids), dtype=np.int64 if exact else object)
    for d, w in zip(q_dims, q_weights, strict=True):
        if (post := postings.get(d)) is not None:
            rows, values = post
            scaled = values * (w if exact else int(w))
            if len(rows) == len(acc):  # a term of every row: the scatter is a plain sum
                acc += scaled
            else:
                acc[rows] += scaled
    if not exact:
        acc = np.array([max(-_LONG - 1, min(_LONG, x)) for x in acc], dtype=np.int64)
    other = np.flatnonzero(ids != q_id)
    # -score must not overflow in the sort: only the least long itself would
    for p in best(np.maximum(acc[other], -_LONG), ids[other], k):
        yield int(ids[other[p]]), int(acc[other[p]])


def _search(k: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                ids, ptr, dims, weights, q_ids, q_ptr, q_dims, q_weights = (
                    c[i].values.to_numpy(zero_copy_only=False) for c in batch.columns)
                # below this no partial sum can leave a long
                bound = (np.abs(weights).max(initial=0.0) * np.abs(q_weights).max(initial=0.0)
                         * max(1, int(dims.max(initial=0)) + 1))
                exact = bool(bound < 2.0**62)
                if exact:
                    weights, q_weights = weights.astype(np.int64), q_weights.astype(np.int64)
                else:
                    weights = np.array([int(x) for x in weights], dtype=object)
                row = np.repeat(np.arange(len(ids)), np.diff(ptr))
                order = np.argsort(dims, kind="stable")
                terms, first = np.unique(dims[order], return_index=True)
                postings = {int(t): (row[o], weights[o])
                            for t, o in zip(terms, np.split(order, first[1:]), strict=True)}
                for q, q_id in enumerate(q_ids.tolist()):
                    a, b = q_ptr[q], q_ptr[q + 1]
                    key = hash((q_id, tuple(q_dims[a:b].tolist()), tuple(q_weights[a:b].tolist())))
                    out += [(q_id, key, v, s) for v, s in
                            score_block(ids, postings, q_id, q_dims[a:b].tolist(), q_weights[a:b].tolist(), k, exact)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                 names=[f.name for f in HITS])
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``queries`` and ``vectors`` are (vec_id, vector); rows query_id, rank, vec_id, score."""
    names = ["vec_id", "vector"]
    cand = blocks(vectors.toDF(*names))
    # few rows are left of each input partition: deal them into full blocks
    n = queries.count()
    asked = blocks(queries.toDF(*names).distinct().repartition(max(1, -(-n // 1024)))).toDF(
        "q_ids", "q_ptr", "q_dims", "q_weights")
    hits = cand.crossJoin(asked).mapInArrow(_search(k), HITS)
    w = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
