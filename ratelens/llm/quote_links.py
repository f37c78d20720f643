"""Chat formatting by quotation linking. DataFrame functions only.

A line that begins with ``>`` marks (each may be set off by a blank) is quoted; the number of marks
is its level. Consecutive lines of one level form a passage. A message's body is what is left
without quoted lines and without attribution lines ("On ... wrote:").

Passages and bodies are normalised (lower case, white space folded) and hashed. A passage is linked
to the original message whose body, or a line of whose body, has the same hash; if the whole passage
meets none, its lines are tried in order. Originals come before the quoting message in the order
(conv_id, turn), so links never form a circle; an original in the same conversation is preferred,
then the earliest one. A message replies to the original of its least nested, first linked passage.
The root of its chain of replies names the conversation it is put in; a conversation lists
its messages in the order (conv_id, turn), which puts every reply after what it replies to.

Originals are folded to one row a hash before the join, so a text that a third of all messages
share is one row; positions are counted by blocks of turns, so a conversation of any length is
spread over tasks.

Defined results: a null text is the empty message; rows with a null conv_id or turn neither quote nor
are quoted and come out alone, with a null conversation and position 0; repeated rows are messages of
their own, in an order fixed by their content; lines without a letter or digit link with
nothing; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import layer

MARKS = r"^((?:\s?>)+)"
ATTRIBUTION = r"^On .* wrote:\s*$"
#: Turns in a block of positions; rounds of pointer doubling (chains of up to 2**40 replies).
BLOCK, MAX_ROUNDS = 1024, 40


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), r"[^>]", ""))


def normalise(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _hash(text: Column) -> Column:
    """Hash of a normalised passage; null if it has no letter or digit."""
    folded = normalise(text)
    return F.when(folded.rlike(r"[\p{L}\p{N}]"), F.xxhash64(folded))


def _body(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(MARKS) & ~x.rlike(ATTRIBUTION)), "\n")


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, mkey, run, level, text): the quoted passages of messages with an id."""
    lines = (messages.where(F.col("text").rlike(r"(?m)" + MARKS))
             .select("conv_id", "turn", "mkey", F.posexplode(F.split("text", "\n")).alias("no", "line"))
             .withColumn("level", level(F.col("line"))))
    message = Window.partitionBy("conv_id", "turn", "mkey").orderBy("no")
    runs = lines.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(message)).cast("int")).withColumn(
        "run", F.sum("new").over(message))
    runs = runs.where("level > 0").withColumn("line", F.regexp_replace("line", MARKS + r"\s?", ""))
    # repeated rows of a message have each line twice: keep one of each number
    return (runs.groupBy("conv_id", "turn", "mkey", "run", "level")
            .agg(F.array_sort(F.collect_set(F.struct("no", "line"))).alias("lines"))
            .select("conv_id", "turn", "mkey", "run", "level", F.col("lines.line").alias("lines")))


def _parents(messages: DataFrame, quoted: DataFrame) -> DataFrame:
    """(conv_id, turn, mkey, p_conv, p_turn, n_linked) of messages with a linked passage."""
    asked = quoted.select("conv_id", "turn", "mkey", "run", "level", F.posexplode(F.concat(
        F.array(_hash(F.array_join("lines", "\n"))), F.transform("lines", _hash))).alias("part", "h")).where("h is not null")
    body = _body(F.col("text"))
    offered = messages.select("conv_id", "turn", F.explode(F.array_distinct(F.concat(
        F.array(_hash(body)), F.transform(F.split(body, "\n"), _hash)))).alias("h"))
    offered = offered.join(asked.select("h").distinct(), "h", "left_semi")
    inside = offered.groupBy("h", "conv_id").agg(F.min("turn").alias("turn"))
    first = offered.groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("o"))
    near = asked.join(inside.withColumnRenamed("turn", "o_turn"), ["h", "conv_id"]).where("o_turn < turn").select(
        "conv_id", "turn", "mkey", "run", "level", "part", F.lit(0).alias("far"), F.col("conv_id").alias("o_conv"), "o_turn")
    far = asked.join(first, "h").where("o.conv_id < conv_id").select(
        "conv_id", "turn", "mkey", "run", "level", "part", F.lit(1).alias("far"),
        F.col("o.conv_id").alias("o_conv"), F.col("o.turn").alias("o_turn"))
    rank = F.struct("level", "run", "part", "far", "o_conv", "o_turn")
    return (near.union(far).groupBy("conv_id", "turn", "mkey")
            .agg(F.min(rank).alias("best"), F.count_distinct("run").alias("n_linked"))
            .select("conv_id", "turn", "mkey", F.col("best.o_conv").alias("p_conv"),
                    F.col("best.o_turn").alias("p_turn"), "n_linked"))


def _roots(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, r_conv): the conversation of the root of each reply, by pointer doubling."""
    step = layer(parents.groupBy("conv_id", "turn").agg(F.min(F.struct("p_conv", "p_turn")).alias("up")), "quote-up")
    for _ in range(MAX_ROUNDS):
        above = step.select(F.struct(F.col("conv_id").alias("p_conv"), F.col("turn").alias("p_turn")).alias("up"),
                            F.col("up").alias("next"))
        jumped = step.join(above, "up", "left").select(
            "conv_id", "turn", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved"))
        jumped = layer(jumped, "quote-up")
        step = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            break
    return step.select("conv_id", "turn", F.col("up.p_conv").alias("r_conv"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """A row for each of ``messages(conv_id, turn, role, text)``: conversation, position, conv_id,
    turn, role, content, parent_conv, parent_turn, n_quotes, n_linked, max_level."""
    rows = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "mkey", F.xxhash64("role", "text"))
    known = rows.where("conv_id is not null and turn is not null")
    quoted = layer(passages(known), "quote-passages")
    parents = layer(_parents(known, quoted), "quote-parents")
    counts = quoted.groupBy("conv_id", "turn", "mkey").agg(
        F.count("*").alias("n_quotes"), F.max("level").alias("max_level"))
    at = ["conv_id", "turn", "mkey"]
    full = (rows.join(counts, at, "left").join(parents, at, "left").join(_roots(parents), ["conv_id", "turn"], "left")
            .withColumn("conversation", F.when(F.col("turn").isNotNull(), F.coalesce("r_conv", "conv_id")))
            .withColumn("block", F.floor(F.col("turn") / BLOCK)))
    block = ["conversation", "conv_id", "block"]
    sizes = full.where("conversation is not null").groupBy(*block).agg(F.count("*").alias("c"))
    before = Window.partitionBy("conversation").orderBy("conv_id", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    inside = F.row_number().over(Window.partitionBy(*block).orderBy("turn", "mkey"))
    named = full.where("conversation is not null").withColumn("inside", inside).join(offsets, block).withColumn(
        "position", (F.col("before") + F.col("inside")).cast("long")).drop("inside", "before")
    alone = full.where("conversation is null").withColumn("position", F.lit(0).cast("long"))
    return named.unionByName(alone).select(
        "conversation", "position", "conv_id", "turn", "role", _body(F.col("text")).alias("content"),
        F.col("p_conv").alias("parent_conv"), F.col("p_turn").alias("parent_turn"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_quotes", "n_linked", "max_level")))
