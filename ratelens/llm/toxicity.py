"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its character 3- to 5-grams (lower case, white space folded to one blank),
each hashed to one of ``BUCKETS``. A bucket's value is its log-count ratio between toxic and other
training texts; a logistic regression over these values gives the score (the NB-SVM construction
of Wang and Manning, 2012, with a logistic loss).

The log-count ratios count every labelled training row, and every bucket seen in ``MIN_TEXTS`` of their texts has a
weight. Only the regression over them is fitted on a bounded sample of the labelled documents: at most
``MAX_PER_CLASS`` texts of each class, those of least xxhash64(doc_id); the weights of the rows restore the
proportion of all labelled training rows. A text's buckets travel packed, in 2 bytes each and ``BUCKETS`` / 8 bytes at
most, so what the driver receives is bounded by 2 * MAX_PER_CLASS * BUCKETS / 8 = 262 MB however long the texts are. It
takes them a partition at a time and holds them once.
The strength of the penalty is chosen from ``L2`` by log loss on a fold of the training rows (crc32 of the id mod 5
is 1), with ratios and a fit (on at most ``FOLD_PER_CLASS`` texts of each class) that leave this fold out.
Scoring reads every whole text.

Defined results: a null text is the empty text; a text without an n-gram gets the score of the
intercept; without a training row of both classes every score is the share of toxic labels (0
without labels); repeated rows and null ids keep one output row each; an empty table gives an empty
table; null labels teach nothing; a doc_id with differing labels counts as toxic if one of its
labels is; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, held_out, layer, map_rows, row_tuples, small_side, trainable, utf32

BITS = 18
BUCKETS = 1 << BITS
SIZES = (3, 4, 5)
MAX_PER_CLASS = 4000
#: Texts of a class that the choice of the penalty fits on, and measures on, at most.
FOLD_PER_CLASS = 500
#: Buckets that have a weight are seen in this many training texts at least.
MIN_TEXTS = 4
ALPHA, ROUNDS = 1.0, 60
#: Penalties to choose from; ``L2_DEFAULT`` where the fold or the rest lacks a class.
L2, L2_DEFAULT = (3e-3, 1e-2, 3e-2), 1e-2
#: Buckets of texts that the fit unpacks at one time (few enough for a processor's cache).
UNPACKED = 1 << 17


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text's n-grams."""
    folded = " ".join((text or "").lower().split())
    if not folded:
        return np.empty(0, np.uint32)
    c = utf32(f" {folded} ").astype(np.uint64)
    h = c * np.uint64(0x9E3779B97F4A7C15)
    out = []
    for n in range(2, max(SIZES) + 1):
        if len(c) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c[n - 1:] * np.uint64(0x94D049BB133111EB)
        if n in SIZES:
            mixed = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            out.append((mixed >> np.uint64(64 - BITS)).astype(np.uint32))
    if not out:
        return np.empty(0, np.uint32)
    v = np.sort(np.concatenate(out))
    return v[np.concatenate(([True], v[1:] != v[:-1]))]


@dataclass(frozen=True)
class Model:
    """``weights`` is dense over ``BUCKETS`` (a fixed size, so it is safe to ship to every task)."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        z = self.intercept + float(self.weights[features(text)].sum(dtype=np.float64))
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


#: What a bucket's bits above the lower 16 can stand for.
_UPPER = np.arange(0, BUCKETS, 1 << 16, dtype=np.uint32)


def packed(found: np.ndarray) -> bytes:
    """Sorted buckets by their upper bits: how many have each, then the lower 16 bits of all; where that is
    shorter, a bitmap."""
    if 2 * (len(_UPPER) + len(found)) < BUCKETS // 8:
        n = np.bincount(found >> 16, minlength=len(_UPPER))
        return np.concatenate((n, found & 0xFFFF)).astype("<u2").tobytes()
    bits = np.zeros(BUCKETS, np.uint8)
    bits[found] = 1
    return np.packbits(bits).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < BUCKETS // 8:
        v = np.frombuffer(data, dtype="<u2")
        return v[len(_UPPER):] + np.repeat(_UPPER, v[:len(_UPPER)])
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8))).astype("<u4")


def _blocks(texts: list[bytes]):
    """(rows, buckets in a row, buckets of each row) of consecutive texts, about ``UNPACKED`` buckets at a time."""
    part, first, size = [], 0, 0
    for i, data in enumerate(texts):
        part.append(unpacked(data))
        size += len(part[-1])
        if size >= UNPACKED or i == len(texts) - 1:
            yield slice(first, i + 1), np.concatenate(part).astype(np.intp), np.array([len(x) for x in part])
            part, first, size = [], i + 1, 0


def _margins(cols: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sum of each row's weights."""
    ends = np.cumsum(lengths)
    run = np.concatenate(([0.0], np.cumsum(weights[cols])))
    return run[ends] - run[ends - lengths]


def _fit(texts: list[bytes], ratio: np.ndarray, toxic: np.ndarray, weight: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Weights (dense over the buckets) and intercept of a logistic regression over packed ``texts``."""
    share = weight / weight.sum()
    w, b = np.zeros(len(ratio)), 0.0
    m = [np.zeros(len(ratio)), 0.0]
    s = [np.zeros(len(ratio)), 0.0]
    for t in range(1, ROUNDS + 1):  # Adam on the whole sample: deterministic, no step size to tune
        gw, gb, scaled = np.zeros(len(ratio)), 0.0, w * ratio
        for rows, cols, lengths in _blocks(texts):
            z = b + _margins(cols, lengths, scaled)
            g = (1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))) - toxic[rows]) * share[rows]
            gw += np.bincount(cols, weights=np.repeat(g, lengths), minlength=len(ratio))
            gb += g.sum()
        for i, grad in ((0, gw * ratio + l2 * w), (1, gb)):
            m[i] = 0.9 * m[i] + 0.1 * grad
            s[i] = 0.999 * s[i] + 0.001 * grad * grad
        step = [0.05 * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-9) for i in (0, 1)]
        w, b = w - step[0], b - step[1]
    return w * ratio, float(b)


def _ratio(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Log-count ratios from the texts of each class that hold a bucket; 0 for buckets seen too rarely."""
    r = np.log((p + ALPHA) / (p.sum() + ALPHA * BUCKETS)) - np.log((q + ALPHA) / (q.sum() + ALPHA * BUCKETS))
    return np.where(p + q >= MIN_TEXTS, r, 0.0)


def _class_weights(toxic: np.ndarray, rows: np.ndarray, total: list[float]) -> np.ndarray:
    """Each text counts as its ``rows``, scaled so that its class has ``total`` rows."""
    held = [max(1.0, rows[toxic == c].sum()) for c in (0, 1)]
    return rows * np.where(toxic == 1, total[1] / held[1], total[0] / held[0])


def _first(mask: np.ndarray, toxic: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` texts of each class under ``mask``."""
    return np.sort(np.concatenate([np.flatnonzero(mask & (toxic == c))[:n] for c in (0, 1)]))


def choose_l2(texts: list[bytes], toxic: np.ndarray, weight: np.ndarray, fold: np.ndarray, ratio: np.ndarray,
              n: int = FOLD_PER_CLASS) -> float:
    """The penalty of least log loss on the fold, for fits on the rest; ``ratio`` leaves the fold out too."""
    fit, look = _first(~fold, toxic, n), _first(fold, toxic, n)
    if min(len(set(toxic[fit])), len(set(toxic[look]))) < 2:
        return L2_DEFAULT
    losses = []
    for l2 in L2:
        w, b = _fit([texts[i] for i in fit], ratio, toxic[fit], weight[fit], l2)
        z = b + np.concatenate([_margins(c, k, w) for _, c, k in _blocks([texts[i] for i in look])])
        loss = np.logaddexp(0.0, np.where(toxic[look] == 1, -z, z))
        losses.append(float((loss * weight[look]).sum() / weight[look].sum()))
    return L2[int(np.argmin(losses))]


_CLASSES = ("other", "toxic", "other_fold", "toxic_fold")
COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in _CLASSES)])
SAMPLE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("dkey", T.LongType()),
                       T.StructField("toxic", T.IntegerType()), T.StructField("fold", T.BooleanType()),
                       T.StructField("n", T.LongType()), T.StructField("f", T.BinaryType())])


def _count(batches):
    """Texts of each class, in and out of the fold, that hold a bucket, folded over a task: a fixed size,
    whatever it reads."""
    import pyarrow as pa

    seen = np.zeros((4, BUCKETS), dtype=np.int64)
    for batch in batches:
        for toxic, fold, text in row_tuples(batch):
            seen[toxic + 2 * fold, features(text)] += 1
    hit = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), *(pa.array(c[hit]) for c in seen)],
                                     names=[f.name for f in COUNTS])
    give_back()


def _pack_task():
    def rows(batch):
        for *keep, text in batch:
            yield (*keep, packed(features(text)))
    return rows


def _constant(total: dict[int, int]) -> Model:
    share = total.get(1, 0) / max(1, sum(total.values()))
    z = 700.0 if share == 1 else -700.0 if share == 0 else math.log(share / (1 - share))
    return Model(np.zeros(BUCKETS, np.float32), z)


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Model:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; see the module for the bounds."""
    rows = layer(labels.where(trainable(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id")
                 .agg(F.max("toxic").cast("int").alias("toxic")), "toxicity-labels")
    total = {x["toxic"]: x["n"] for x in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return _constant(total)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    texts = docs.select("doc_id", "text")
    every = texts.join(small_side(rows), "doc_id").select("toxic", fold.alias("fold"), "text")
    sums = (F.sum(c).alias(c) for c in _CLASSES)
    # at most a row a bucket
    counts = layer(every.mapInArrow(_count, COUNTS).groupBy("bucket").agg(*sums), "toxicity-counts").toArrow()
    if not counts.num_rows:
        return _constant(total)
    seen = np.zeros((4, BUCKETS))
    seen[:, counts["bucket"].to_numpy()] = [counts[c].to_numpy() for c in _CLASSES]

    # a labelled text once, however many rows repeat it, and only texts that are there
    key = F.xxhash64("text").alias("dkey")
    found = layer(texts.select("doc_id", key).join(small_side(rows), "doc_id").groupBy("doc_id", "dkey")
                  .agg(F.max("toxic").alias("toxic"), F.count("*").alias("n")), "toxicity-found")
    every_row = {x["toxic"]: x["n"] for x in found.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    part = [found.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id", "dkey").limit(max_per_class)
            for c in (0, 1)]
    # the sample has at most 2 * max_per_class rows of four numbers: a proven bound for a broadcast
    sample = F.broadcast(layer(part[0].union(part[1]), "toxicity-sample"))
    rows_of = texts.withColumn("dkey", key).join(sample, ["doc_id", "dkey"]).select(
        "doc_id", "dkey", "toxic", fold.alias("fold"), "n", "text")
    got = layer(map_rows(rows_of, _pack_task, SAMPLE).dropDuplicates(["doc_id", "dkey"])
                .select(F.xxhash64("doc_id").alias("h"), "doc_id", "dkey", "toxic", "fold", "n", "f"), "toxicity-packed")
    # a partition at a time, never the whole sample in the JVM; sorted, so the fit doesn't depend on row order
    got = sorted(map(tuple, got.toLocalIterator()))
    toxic, out, n, buckets = (list(c) for c in list(zip(*got))[3:]) if got else ([], [], [], [])
    del got
    toxic, out, n = np.array(toxic, float), np.array(out, bool), np.array(n, float)
    weight = _class_weights(toxic, n, [every_row.get(c, 0) for c in (0, 1)])
    l2 = choose_l2(buckets, toxic, weight, out, _ratio(seen[1], seen[0]))
    weights, b = _fit(buckets, _ratio(seen[1] + seen[3], seen[0] + seen[2]), toxic, weight, l2)
    del buckets, seen, counts
    give_back()
    return Model(weights.astype(np.float32), b)


OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                    T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _score_rows(model: Model):
    def rows(batch):
        for *keep, text in batch:
            s = model.score(text)
            yield (*keep, s, int(s >= 0.5))
    return rows


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")).alias("h"), "text"),
                    lambda: _score_rows(sent.value), OUT)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text scores below 0.5."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            keep = [sent.value.score(x) < 0.5 for (x,) in row_tuples(b.select(["text"]))]
            yield b.filter(pa.array(keep, type=pa.bool_()))
            del b, keep
        give_back()

    return docs.mapInArrow(run, docs.schema)
