"""Packing: first-fit decreasing with a tournament tree, in randomised groups of documents.

Documents are tokenised whole, ended by id ``END`` and cut into pieces of at most ``SEQ_LEN`` ids.
Pieces are dealt to groups of about ``GROUP`` pieces by a hash; every group packs its own pieces
into sequences of ``SEQ_LEN``: in falling order of length, each piece goes to the first sequence with
room, found by walking down a tree whose nodes hold the greatest room below them. Groups are
independent, so they run on any number of machines; each wastes less than one sequence more than a
single run would.

Defined results: a null text is the empty text, one piece with the end id alone; very long texts
give many pieces, dealt to different groups; repeated rows and repeated or null ids are separate
documents; ties of length go by doc_id, start, then task order; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import crc_bytes, give_back, layer

SEQ_LEN = 2048
#: Id that ends a document.
END = 1
#: Pieces in a group, about.
GROUP = 4096
#: Entries of one generation of a worker's cache of parts (some 200 bytes each; two generations are kept).
CACHE = 100_000
#: Text whose words are numbered together.
SLICE_BYTES = 2 << 20
_END = np.array([END], dtype="<u4").tobytes()


class Kept:
    """A bounded cache of two generations: when the young one is full it becomes the old one, and what is
    asked for again moves up, so common words outlive a flood of rare ones."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key: str) -> bytes | None:
        if (found := self.young.get(key)) is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value


#: Stands between words that are split into parts together.
MARK = "\x00"


def _gather(units: list[bytes], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the units that ``code`` names, in a row, and where each begins and the last ends."""
    length = np.fromiter((len(x) >> 2 for x in units), dtype=np.int64, count=len(units))
    first = np.concatenate(([0], np.cumsum(length)))
    each = length[code]
    ends = np.concatenate(([0], np.cumsum(each)))
    ids = np.frombuffer(b"".join(units), dtype="<u4")
    return ids[np.repeat(first[code] - ends[:-1], each) + np.arange(ends[-1])], ends


class WordEncoder:
    """Ids of whole texts under a tokenizer that splits at white space and then by a pattern.

    Equal to ``Tokenizer.encode(text, add_special_tokens=False)``: white space never lies within a token, so the
    ids of a text are those of its words in a row, and a part's ids can be kept. A text that spells out one of
    the tokenizer's added tokens is encoded whole, since that token may begin inside a word.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # \x1c to \x1f split words here but are ordinary characters to the tokenizer
        self.literals = [MARK, "\x1c", "\x1d", "\x1e", "\x1f", *(t.content for t in self.whole.get_added_tokens_decoder().values())]
        # fixed values of the tokenizer file: its split pattern
        self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.parts = Kept(CACHE)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(visible)]
        self.byte_char = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def odd(self, text: str) -> bool:
        return any(x in text for x in self.literals)

    def part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            shown = part.encode().decode("latin-1").translate(self.byte_char)
            ids = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
            if len(part) < 64:
                self.parts.put(part, ids)
        return ids

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of different words: joined by a mark, folded and split into parts in one go;
        each different part is then encoded once."""
        if not len(words):
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), f" {MARK} ")[0].as_py()
        if not joined.isascii():
            joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")
        named = pa.array([*self.find(joined.lower()), MARK], pa.string()).dictionary_encode()
        code = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        parts = named.dictionary.to_pylist()
        mark = parts.index(MARK)
        ids, ends = _gather([b"" if p == MARK else self.part(p) for p in parts], code)
        return ids, np.concatenate(([0], ends[1:][code == mark]))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of all texts in a row, text i's being ids[bounds[i]:bounds[i + 1]]."""
        plain = np.array([not self.odd(t.as_py()) for t in texts], dtype=bool)
        lists = pc.utf8_split_whitespace(pc.if_else(pa.array(plain), texts, ""))
        named = lists.flatten().dictionary_encode()
        ids, bounds = self._words(named.dictionary)
        units = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        offsets = lists.offsets.to_numpy()
        offsets, code = offsets - offsets[0], named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if not plain.all():
            # a text with odd characters is a unit of its own, encoded whole
            own = [np.array(self.whole.encode(t.as_py(), add_special_tokens=False).ids, dtype="<u4").tobytes()
                   for t, ok in zip(texts, plain, strict=True) if not ok]
            code = np.insert(code, offsets[:-1][~plain], np.arange(len(units), len(units) + len(own)))
            offsets = offsets + np.concatenate(([0], np.cumsum(~plain)))
            units += own
        ids, ends = _gather(units, code)
        return ids, ends[offsets]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of one text."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                       T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                       T.StructField("doc_tokens", T.LongType()), T.StructField("at", T.LongType()),
                       T.StructField("ids", T.BinaryType())])


def tokenize_documents(docs: DataFrame, tokenizer: Callable[[], str] = default_tokenizer,
                       seq_len: int = SEQ_LEN, with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``; ``ids`` (packed 32-bit) is filled only if asked for.

    ``tokenizer`` is called on the executors and gives the path of the tokenizer file there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder(tokenizer())  # of this task: a worker keeps no tokenizer and no cache
        at = 0
        for batch in batches:
            for part in _slices(batch):
                ids, bounds = enc.encode_all(pc.fill_null(part.column(1), ""))
                rows = []
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    own = ids[bounds[i]:bounds[i + 1]].tobytes() + _END
                    total = len(own) // 4
                    for start in range(0, total, seq_len):
                        piece = own[4 * start:4 * (start + seq_len)]
                        at += 1
                        rows.append((doc_id, start, len(piece) // 4, crc_bytes(piece), total, at, piece if with_ids else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
                del part, ids, bounds, rows
            del batch
        del enc
        give_back()

    arrow = to_arrow_schema(PIECES)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, about ``SLICE_BYTES`` of text at a time (a longer text alone)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        yield batch.slice(first, last - first)
        first = last


class Tournament:
    """Bins in order; a node holds the greatest room of the bins below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.room = [room] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; (bin, room before)."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        before = room[node]
        room[node] = before - size
        found = node - self.leaves
        node //= 2
        while node:
            room[node] = max(room[2 * node], room[2 * node + 1])
            node //= 2
        return found, before


def first_fit_decreasing(lengths: list[int], seq_len: int = SEQ_LEN) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length, the lengths being in falling order."""
    tree = Tournament(max(1, len(lengths)), seq_len)
    placed = [tree.place(n) for n in lengths]
    return [b for b, _ in placed], [seq_len - before for _, before in placed]


def pack(pieces: DataFrame, groups: int, seq_len: int = SEQ_LEN) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; group g numbers its sequences from g * 2**32."""
    key = F.pmod(F.xxhash64("doc_id", "start", "at", "ids_crc32"), F.lit(groups)).alias("group_no")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def pack_group(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start", "at"], ascending=[False, True, True, True],
                                kind="stable")
        bins, offsets = first_fit_decreasing(part["length"].tolist(), seq_len)
        return part.drop(columns="group_no").assign(
            sequence_id=np.array(bins, dtype=np.int64) + (int(key[0]) << 32),
            offset=np.array(offsets, dtype=np.int64))[[f.name for f in schema]]

    return pieces.select("*", key).groupBy("group_no").applyInPandas(pack_group, schema)


def pack_documents(docs: DataFrame, tokenizer: Callable[[], str] = default_tokenizer,
                   seq_len: int = SEQ_LEN, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """Pack all of ``docs(doc_id, text)``. The number of groups follows from the rows and bytes."""
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-(n + size // (3 * seq_len)) // group))
    # written once: a task of the packing that is lost does not bring the encoding back
    pieces = layer(tokenize_documents(docs, tokenizer, seq_len, with_ids), "pack-pieces")
    return pack(pieces, groups, seq_len)
