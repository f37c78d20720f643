"""Language identification by rank-order n-gram profiles and out-of-place distance.

A profile is the ``PROFILE`` most frequent n-grams (1 to 3 letters, word ends marked by a blank)
in falling order of count; a document is given the language whose profile its own differs least
from, summing over the document's n-grams how far apart the two ranks are.

Defined results: a null text or a text without a letter is ``und`` with score 0, and so is every
text when nothing could be learned; ties go to the language first in alphabetical order, ties of
counts to the smaller n-gram code; repeated rows and null ids keep one output row each; an empty
table gives an empty table; a null ``lang`` teaches nothing; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_rows, trainable, utf32

#: N-grams in a profile.
PROFILE = 300
UNKNOWN = "und"
_BITS = 21  # of a code point


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)


def normalise(text: str) -> np.ndarray:
    """Lower-cased code points; every run of other characters, and each end, is one blank."""
    codes = utf32(text.lower()).astype(np.uint64)
    table = _letters()
    is_letter = table[np.minimum(codes, 0xFFFF).astype(np.int64)]
    far = np.flatnonzero(codes > 0xFFFF)
    if len(far):
        is_letter[far] = [chr(int(c)).isalpha() for c in codes[far]]
    codes = np.where(is_letter, codes, np.uint64(32))
    codes = np.concatenate(([np.uint64(32)], codes, [np.uint64(32)]))
    blank = codes == 32
    return codes[~(blank & np.concatenate(([False], blank[:-1])))]


def grams(text: str | None) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams of a text but the lone blank; empty if it has no letter."""
    if not text:
        return np.empty(0, np.uint64)
    c = normalise(text)
    if len(c) < 2:
        return np.empty(0, np.uint64)
    two = c[:-1] | (c[1:] << np.uint64(_BITS))
    three = two[:-1] | (c[2:] << np.uint64(2 * _BITS))
    return np.concatenate((c[c != 32], two, three))


def top(codes: np.ndarray, n: int = PROFILE) -> np.ndarray:
    kinds, counts = np.unique(codes, return_counts=True)
    return kinds[np.lexsort((kinds, -counts))[:n]]


COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()),
                       T.StructField("n", T.LongType())])


#: N-gram codes a task holds of a language before it folds them to counts.
HELD = 1 << 20


def _count_task():
    def folded(kinds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        different, place = np.unique(kinds, return_inverse=True)
        return different, np.bincount(place, weights=counts).astype(np.int64)

    def rows(batch):
        by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for text, lang in batch:
            parts = by_lang.setdefault(lang, [])
            parts.append(np.unique(grams(text), return_counts=True))
            if sum(len(k) for k, _ in parts[-64:]) > HELD or len(parts) >= 64:
                by_lang[lang] = [folded(*map(np.concatenate, zip(*parts, strict=True)))]
        for lang, parts in by_lang.items():
            kinds, counts = folded(*map(np.concatenate, zip(*parts, strict=True)))
            for k, n in zip(kinds.tolist(), counts.tolist(), strict=True):
                yield lang, k, n
    return rows


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles of the languages of ``docs(doc_id, text, lang)``, counted over all its training
    rows. What reaches the driver is ``size`` numbers a language."""
    rows = docs.where(trainable(F.col("doc_id")) & F.col("lang").isNotNull()).select("text", "lang")
    counts = map_rows(rows, _count_task, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    out: dict[str, list[int]] = {}
    for lang, gram, _ in sorted(ranked.where(F.col("r") <= size).select("lang", "gram", "r").collect(),
                                key=lambda x: (x[0], x[2])):
        out.setdefault(lang, []).append(gram)
    return out


def predict(text: str | None, langs: list[str], keys: list[np.ndarray], ranks: list[np.ndarray],
            size: int = PROFILE) -> tuple[str, float]:
    own = top(grams(text), size)
    if not len(own) or not langs:
        return UNKNOWN, 0.0
    place = np.arange(len(own))
    far = []
    for key, rank in zip(keys, ranks, strict=True):
        at = np.minimum(np.searchsorted(key, own), len(key) - 1)
        far.append(int(np.where(key[at] == own, np.abs(rank[at] - place), size).sum()))
    best = int(np.argmin(far))
    return langs[best], 1.0 - min(1.0, far[best] / (size * len(own)))


OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with the nearest language of ``profiles``."""
    langs = sorted(profiles)
    order = [np.array(profiles[x], dtype=np.uint64) for x in langs]
    ranks = [np.argsort(x, kind="stable") for x in order]
    keys = [x[r] for x, r in zip(order, ranks, strict=True)]

    def task():
        def rows(batch):
            for doc_id, held, text in batch:
                yield (doc_id, held, *predict(text, langs, keys, ranks, size))
        return rows

    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")).alias("h"), "text"), task, OUT)
