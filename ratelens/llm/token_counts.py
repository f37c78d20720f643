"""Token counts by field and section: whole documents are encoded once, token byte spans are
interval-joined to section spans.

A document is its fields in order, joined by a line break; a section is one line of a field,
with its line break, or (``unit="sentence"``) one sentence: a run up to ``.``, ``!`` or ``?`` and the white space
after it, or up to a line break. Byte-level tokens often begin with a blank, so most sentences end inside a token. A token that crosses a boundary belongs to the section holding most of its
bytes, ties to the earlier section; so every token is counted exactly once and the counts of a
document's sections add up to its tokens.

Defined results: a null field is the empty field; an empty field has one section without bytes
of its own; each input row is counted on its own, so repeated rows and null ids are kept; very long
texts are one encoding; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_rows


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteEncoder:
    """Ids of a byte-level tokenizer and the byte each token ends at."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        return np.cumsum(self.widths[np.asarray(self.encoding.encode_ordinary(text), dtype=np.int64)])


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


#: The ends of sections: a line break, or the end mark of a sentence with the white space after it.
UNITS = {"line": re.compile(rb"\n"), "sentence": re.compile(rb"\n|[.!?]+[ \t\r\f\v]++(?!\n)")}


def section_ends(fields: Sequence[str | None], unit: str = "line") -> tuple[bytes, list[tuple[int, int]], np.ndarray]:
    """The joined document, (field, section in it) of each section, and the byte each ends at."""
    parts = [(f or "").encode() for f in fields]
    whole = b"\n".join(parts)
    ends, names, at = [], [], 0
    for i, part in enumerate(parts):
        inner = [at + m.end() for m in UNITS[unit].finditer(part)]
        at += len(part) + 1
        # the break that joins two fields belongs to the first
        ends += [*inner, min(at, len(whole))]
        names += [(i, k) for k in range(len(inner) + 1)]
    return whole, names, np.array(ends, dtype=np.int64)


def attribute(ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary. Sections end at ``bounds``."""
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    first = np.searchsorted(bounds, starts, side="right")
    last = np.searchsorted(bounds, ends - 1, side="right")
    home = first.copy()
    # over one boundary: the later section only if it holds more
    two = np.flatnonzero(last == first + 1)
    home[two] += ends[two] - bounds[first[two]] > bounds[first[two]] - starts[two]
    for t in np.flatnonzero(last > first + 1):
        most = -1
        for s in range(int(first[t]), int(last[t]) + 1):
            low = starts[t] if s == first[t] else bounds[s - 1]
            held = min(ends[t], bounds[s]) - low
            if held > most:
                home[t], most = s, held
    return home, first != last


OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("field", T.StringType()),
                    T.StructField("section", T.LongType()), T.StructField("n_bytes", T.LongType()),
                    T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType()),
                    T.StructField("doc_tokens", T.LongType())])


def token_counts(docs: DataFrame, fields: Sequence[str] = ("text",),
                 ranks: Callable[[], str] = default_ranks, unit: str = "line") -> DataFrame:
    """A row per section of each row of ``docs``: its bytes, tokens, and tokens that cross its
    boundaries but were allocated to it. ``ranks`` is called on the executors."""
    names = list(fields)

    def task():
        enc = encoder(ranks())

        def rows(batch):
            for doc_id, *values in batch:
                whole, sections, bounds = section_ends(values, unit)
                ends = enc.ends(whole.decode())
                home, crossing = attribute(ends, bounds)
                count = np.bincount(home, minlength=len(sections)).tolist()
                crossed = np.bincount(home[crossing], minlength=len(sections)).tolist()
                sizes = np.diff(bounds, prepend=0).tolist()
                for i, (f, k) in enumerate(sections):
                    yield doc_id, names[f], k, sizes[i], count[i], crossed[i], len(ends)
        return rows

    return map_rows(docs.select("doc_id", *names), task, OUT)
