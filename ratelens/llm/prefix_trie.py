"""Conversation prefix trie by truncation peeling.

Each distinct sequence of first d turns (role, text) is a node of depth d; the root is the textless
sequence of depth 0. Peeling starts at the greatest depth and goes up. A level's open rows are the
nodes that survive from below, their last turn stripped, and the conversations that end at that
depth. Regrouping the open rows by prefix merges them and discovers the level's nodes, with their
aggregates: members, smallest member, children, leaves and saved tokens add up on the way, so each
node is met once and no row is ever sent to all of its prefixes.

A prefix is named by 128 bits: every turn hashes its place, role and text, a prefix adds its turns'
hashes, so the names of all prefixes of a conversation are one running sum, taken in blocks of
``BLOCK`` turns (a conversation of any length is spread over tasks). Texts are dropped once hashed
and counted.

A wide level (over ``WIDE`` conversations reach it) is regrouped by a Spark group-by, with partial
sums before the shuffle, so a prefix that a third of all conversations share is one row a task.
Below the deepest wide level at most ``WIDE`` conversations are left, and ``BAND`` levels at a
time are peeled in one round, by subtree, inside tasks: at most ``WIDE`` * ``BAND`` turns. Both forms
give the same rows. Each round is written to the shared folder before the next reads it, so a lost
executor costs its tasks of one round.

``ends_sha256`` hashes a node's ended members in order. Members are ranged over tasks, each joins its
runs to pieces of text, and the pieces are then hashed in order as a stream (a hash is sequential,
but it holds one batch of pieces at a time).

Defined results: rows with a null conv_id take no part; a null role or text is empty; turns go by
number, null first, equal numbers by a hash of role and text; repeated rows are turns of their own (they are
folded and counted before the order is taken); a conversation may be turnless after a rebuild and
is then a member of the root alone; an empty table gives an empty table; texts of any length are
hashed and counted whole; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.session import checkpoint_root

from .common import layer

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation in one block of running sums.
BLOCK = 1024
#: A level that more conversations reach is a round of its own; below, so many levels make a round.
WIDE, BAND = 256, 256
#: Ended members joined to one piece of text.
PIECE = 1024
#: The least long stands for a missing turn number's block.
NO_BLOCK = -(1 << 62)
ROOT = "0" * 32

LEVEL = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("up", T.StringType()),
    T.StructField("depth", T.LongType()), T.StructField("conv_id", T.LongType()),
    T.StructField("n_convs", T.LongType()), T.StructField("n_children", T.LongType()),
    T.StructField("n_leaves", T.LongType()), T.StructField("saved_tokens", T.LongType())])
OPEN = ["key", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def ordered_turns(messages: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, words): a row a turn, its place in the conversation from 1, two hashes of
    (role, text) and the words of its text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = messages.where("conv_id is not null").select(
        "conv_id", "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(text, F.lit("/"), role).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    folded = rows.groupBy("conv_id", "turn", "a", "b").agg(F.count("*").alias("copies"), F.max("words").alias("words"))
    folded = folded.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(NO_BLOCK)))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "a", "b")
    before = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    folded = folded.withColumn("before", F.coalesce(before, F.lit(0)))
    sizes = folded.groupBy("conv_id", "block").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    at = F.col("offset") + F.col("before")
    return folded.join(offsets, ["conv_id", "block"]).select(
        "conv_id", F.explode(F.sequence(at + 1, at + F.col("copies"))).alias("pos"), "a", "b", "words")


def rebuild(turns: DataFrame, base: Column, heads: Column, max_heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns (at most ``max_heads``) are those of conversation ``base``.

    Both are columns over ``conv_id``. Returns the turns (conv_id, depth, a, b, words, length) and the
    conversations (conv_id, length), turnless ones too.
    """
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = own.select("conv_id", "own", base.alias("base"), heads.cast("long").alias("h"))
    has = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(has, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_own", F.lit(0)))).select(
        "conv_id", "base", "h", "taken",
        (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    convs = layer(convs, "trie-conversations")
    first = turns.where(F.col("pos") <= max_heads).withColumnRenamed("conv_id", "base")
    head = convs.where("taken > 0").join(first, "base").where("pos <= taken").select(
        "conv_id", F.col("pos").alias("depth"), "a", "b", "words", "length")
    tail = turns.join(convs, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "a", "b", "words", "length")
    return head.union(tail), convs.select("conv_id", "length")


def prefix_names(turns: DataFrame) -> DataFrame:
    """``turns`` with ``key`` and ``up``: the names of the prefix that ends at the turn and of the one
    before it."""
    place = (F.col("depth"), F.col("a"), F.col("b"))
    one, two = F.xxhash64(*place), F.xxhash64(*place, F.lit("/"))
    # parts of 32 bits: their sums over 2**31 turns still fit a long
    parts = {"s0": one.bitwiseAND(0xFFFFFFFF), "s1": F.shiftrightunsigned(one, 32),
             "s2": two.bitwiseAND(0xFFFFFFFF), "s3": F.shiftrightunsigned(two, 32)}
    rows = turns.withColumns(parts).withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    totals = rows.where(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(*(F.sum(s).alias(f"t_{s}") for s in parts))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv_id", "block", *(F.coalesce(F.sum(f"t_{s}").over(earlier), F.lit(0)).alias(f"o_{s}") for s in parts))
    summed = rows.select(*rows.columns, *(F.sum(s).over(inside).alias(f"r_{s}") for s in parts)).join(
        totals, ["conv_id", "block"], "left")

    def name(depth: Column, less: bool) -> Column:
        total = [F.col(f"r_{s}") + F.coalesce(f"o_{s}", F.lit(0)) - (F.col(s) if less else F.lit(0)) for s in parts]
        return F.md5(F.concat_ws(",", depth.cast("string"), *(t.cast("string") for t in total)))

    return summed.select(
        "conv_id", "depth", "words", "length", name(F.col("depth"), False).alias("key"),
        F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(name(F.col("depth") - 1, True)).alias("up"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (key, conv_id) rows in order, joined to pieces (key, first, ids)."""
    key, ids, out = None, [], []

    def cut():
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
            ids.clear()

    def drain():
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*out, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], names=["key", "first", "ids"])
        out.clear()
        return batch

    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key or len(ids) == PIECE:
                cut()
                key = k
            ids.append(c)
        if out:
            yield drain()
    cut()
    if out:
        yield drain()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (key, first, ids) in order, hashed as one text a key."""
    key, sha, out = None, None, []
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k == key:
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((key, sha.hexdigest()))
            key, sha = k, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["key", "sha"])
            out = []
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (key, sha.hexdigest())], names=["key", "sha"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, sha): SHA-256 of each node's ended members, ascending and comma-joined."""
    ranged = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ranged.mapInArrow(_pieces, "key string, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, sha string")


def _peel_wide(opened: DataFrame, steps: DataFrame, depth: int) -> DataFrame:
    """The nodes of one level: open rows regrouped, and their last turn looked up at a member."""
    nodes = opened.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    nodes = nodes.withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")))
    if depth:
        last = steps.where(F.col("depth") == depth).select("conv_id", "up", "words")
        nodes = nodes.join(last, "conv_id").withColumn(
            "saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    else:
        nodes = nodes.withColumn("up", F.lit(None).cast("string"))
    return nodes.withColumn("depth", F.lit(depth).cast("long")).select(*LEVEL.names)


def _peel_subtree(top: int):
    """Peels one subtree, from its greatest depth up to the level below ``top``, inside a task.

    Rows: open ones (kind 0: depth and aggregates) and turns (kind 1: key, up, depth, words).
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        turn = {k: (up, w) for k, up, w in frame.loc[frame.kind == 1, ["key", "up", "words"]].itertuples(index=False)}
        levels: dict[int, dict] = {}

        def add(depth, key, conv, *sums):
            mine = levels.setdefault(depth, {}).setdefault(key, [conv, 0, 0, 0, 0])
            mine[0] = min(mine[0], conv)
            for i, x in enumerate(sums, 1):
                mine[i] += x

        for row in frame.loc[frame.kind == 0, ["depth", *OPEN]].itertuples(index=False):
            add(*row)
        out = []
        for depth in range(max(levels, default=top), top, -1):
            for key, (conv, n, children, leaves, saved) in levels.pop(depth, {}).items():
                up, words = turn[key]
                leaves, saved = leaves if children else 1, saved + (n - 1) * words
                out.append((key, up, depth, conv, n, children, leaves, saved))
                if depth - 1 > top:
                    add(depth - 1, up, conv, n, 1, leaves, saved)
        return pd.DataFrame(out, columns=LEVEL.names)

    return run


def _peel_band(opened: DataFrame, steps: DataFrame, top: int) -> DataFrame:
    """The nodes of all levels of ``steps`` (those of one band, above it depth ``top``)."""
    # the subtree of a conversation's rows: its prefix at the band's uppermost level
    roots = steps.where(F.col("depth") == top + 1).select("conv_id", F.col("key").alias("root"))
    turns = steps.select("key", "up", "depth", "words", "conv_id").join(roots, "conv_id")
    turns = turns.groupBy("root", "key", "up", "depth").agg(F.max("words").alias("words"))
    blank = [F.lit(None).cast("long").alias(c) for c in OPEN[1:]]
    rows = opened.join(roots, "conv_id").select(
        F.lit(0).alias("kind"), "root", "depth", F.lit(None).cast("string").alias("up"), F.lit(None).cast("long").alias("words"), *OPEN)
    turns = turns.select(F.lit(1).alias("kind"), "root", "depth", "up", "words", "key", *blank)
    return rows.union(turns).groupBy("root").applyInPandas(_peel_subtree(top), LEVEL)


def peel(steps: DataFrame, ends: DataFrame, spark: SparkSession) -> DataFrame:
    """All nodes (``LEVEL``) of the conversations with prefix names ``steps`` and ends (key, depth, conv_id)."""
    folder = f"{checkpoint_root(spark)}/layers/trie-{uuid.uuid4().hex}"
    # the deepest level that more than WIDE conversations reach: the length of the (WIDE + 1)th longest
    longest = [r[0] for r in ends.select("depth").orderBy(F.desc("depth")).limit(WIDE + 1).collect()]
    if not longest:
        return spark.createDataFrame([], LEVEL)
    wide, deepest = (longest[-1] if len(longest) > WIDE else 0), longest[0]

    def band(depth: Column) -> Column:
        return F.when(depth <= wide, depth).otherwise(wide + 1 + F.floor((depth - wide - 1) / BAND))

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    # a task's rows are of neighbouring depths, so a round reads the few files of its band
    ranged = steps.repartitionByRange("depth", "conv_id").withColumn("band", band(F.col("depth")))
    ranged.write.partitionBy("band").parquet(f"{folder}/steps")
    ended = write(ends.groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).select(
        "key", "conv_id", "n_convs", *(F.lit(0).cast("long").alias(c) for c in OPEN[3:]), "depth"), "ends")
    tops = [*range(wide), *range(wide, deepest, BAND)] if deepest else []
    alive: DataFrame | None = None
    written = []
    for n, top in reversed(list(enumerate(tops, 1))):
        # rounds 1 to ``wide`` are one level, deeper ones a band of levels
        low = top + 1 if n <= wide else min(deepest, top + BAND)
        mine = spark.read.schema(steps.schema).parquet(f"{folder}/steps/band={n}")
        opened = ended.where(F.col("depth").between(top + 1, low))
        if alive is not None:
            opened = opened.union(alive)
        nodes = _peel_wide(opened, mine, low) if n <= wide else _peel_band(opened, mine, top)
        nodes = write(nodes, f"level-{n}")
        written.append(f"{folder}/level-{n}")
        alive = _strip(nodes.where(F.col("depth") == top + 1))
    opened = ended.where("depth = 0")
    root = _peel_wide(opened.union(alive) if alive is not None else opened, steps, 0)
    write(root, "level-0")
    return spark.read.schema(LEVEL).parquet(*written, f"{folder}/level-0")


def _strip(nodes: DataFrame) -> DataFrame:
    """Nodes without their last turn: open rows of the level above."""
    return nodes.select(F.col("up").alias("key"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
                        "n_leaves", "saved_tokens", (F.col("depth") - 1).alias("depth"))


def conversation_trie(messages: DataFrame, base: Column | None = None, heads: Column | None = None,
                      max_heads: int = 0) -> DataFrame:
    """The trie of ``messages(conv_id, turn, role, text)``, a row a node: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, key.

    ``base`` and ``heads`` (columns over ``conv_id``) rebuild the conversations first, see ``rebuild``.
    """
    spark = messages.sparkSession
    turns = layer(ordered_turns(messages), "trie-turns")
    own = F.col("conv_id") if base is None else base
    rebuilt, convs = rebuild(turns, own, F.lit(0) if heads is None else heads, max_heads)
    steps = layer(prefix_names(rebuilt), "trie-steps")
    ends = steps.where("depth = length").select("key", "depth", "conv_id").union(
        convs.where("length = 0").select(F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), "conv_id"))
    ends = layer(ends, "trie-ends")
    nodes = peel(steps.drop("length"), ends, spark)
    parents = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(parents, "up", "left").join(end_digests(ends), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(none)).alias("ends_sha256"), "key")
