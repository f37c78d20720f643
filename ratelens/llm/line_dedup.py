"""Line deduplication by a deletion-neighbourhood join. DataFrame functions only.

A line is its lower-cased words (runs of other than ASCII white space). Two lines are copies when
their words are equal or, if both have ``MIN_WORDS`` words or more, when one edit of a word (insert,
delete, replace) turns one into the other. A line is dropped when an earlier line of the corpus is
its copy; lines come in the order of doc_id, then (for repeated ids) a hash of the text, then line
number. Blank lines are always kept.

1. Lines are folded by a 128-bit hash of their words: the first place of each different line, by a
   group-by whose partial minimum makes a line on a third of all documents cost one row a task.
2. A pigeonhole filter finds the lines worth a neighbourhood: one edit leaves the first or the last
   half of the shorter line whole, so a line with a partner shares a half-key with it. Nothing is
   lost, and lines without a partner (nearly all) stop here.
3. Each such line emits its deletion variants as hashed keys: all single-word deletions within the
   half that may differ, and itself. A variant's hash is an exclusive or of hashes of (word,
   position), so all variants of a line cost time in proportion to its words.
4. Equal keys mean one edit: the same deletion at the same place is a replacement, a line equal to
   another's variant is an insertion. Each group keeps only its earliest members, so no group is
   ever expanded into pairs; each line takes its earliest partner, and the pair's words are
   compared once.

Defined results: a null text stays null and an empty text empty; rows with a null doc_id pass
unchanged and take no part; rows equal in doc_id and text are one document and get one result each;
an empty table gives an empty table; all other columns are kept whatever their names, except that
``n_lines`` and ``n_dropped`` are set (unless ``counts`` is off: then they too are kept as they are); very long lines follow the same rule by way of a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.session import working_layers

from .common import fresh, layer, small_side

MIN_WORDS = 8
#: Lines of more words hash their variants by a window over exploded words, not by array folds.
ARRAY_WORDS = 1024


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"\s+"), "")


def _lines(docs: DataFrame) -> DataFrame:
    rows = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("dkey"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    # by the line, not by the size of its words: that filter would split every line twice
    return rows.where(F.col("line").rlike(r"\S")).select("doc_id", "dkey", "no", _words(F.col("line")).alias("w"))


def _half_keys(w: Column, n: Column, min_words: int) -> list[Column]:
    """Keys of the first and last half, by the line's length and by one less (as the longer line)."""
    out = []
    for size in (n, n - 1):
        half = F.floor(size / 2).cast("int")
        for side, start in (("first", F.lit(1)), ("last", n - half + 1)):
            key = F.xxhash64(F.lit(side), size, F.slice(w, start, half))
            out.append(F.when(size >= min_words, key))
    return out


def first_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Each different line: its hash (h1, h2), first place (doc_id, dkey, no), words and half-keys."""
    lines = _lines(docs)
    n = F.size("w")
    keys = _half_keys(F.col("w"), n, min_words)
    rows = lines.select(F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), "w").alias("h2"),
                        F.struct("doc_id", "dkey", "no").alias("place"), n.alias("n"),
                        *(k.alias(f"k{i}") for i, k in enumerate(keys)))
    # n and the keys follow from the hash: any row's will do
    return (rows.groupBy("h1", "h2")
            .agg(F.min("place").alias("place"), F.min("n").alias("n"), *(F.min(f"k{i}").alias(f"k{i}") for i in range(4)))
            .select("h1", "h2", "place.*", "n", *(f"k{i}" for i in range(4))))


def _with_partner(firsts: DataFrame, min_words: int) -> DataFrame:
    """Lines that share a half-key with another line, and which half."""
    keys = (firsts.where(F.col("n") >= min_words)
            .select("h1", "h2", F.posexplode(F.array(*(F.col(f"k{i}") for i in range(4)))).alias("i", "k"))
            .where("k is not null"))
    shared = keys.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select("k")
    return (keys.join(shared, "k").groupBy("h1", "h2")
            .agg(F.max(F.col("i") % 2 == 0).alias("same_first"), F.max(F.col("i") % 2 == 1).alias("same_last")))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the wanted lines, read again at their first place."""
    places = layer(wanted.select("doc_id", "dkey", "no", "same_first", "same_last"), "line-wanted")
    lines = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("dkey"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return (lines.join(small_side(places), ["doc_id", "dkey", "no"])
            .dropDuplicates(["doc_id", "dkey", "no"])  # repeated rows of a document
            .select(F.struct("doc_id", "dkey", "no").alias("place"), "same_first", "same_last",
                    _words(F.col("line")).alias("w")))


def _in_edited_half(i: Column, n: Column) -> Column:
    half = F.floor((n - 1) / 2)
    return (F.col("same_first") & (i >= half)) | (F.col("same_last") & (i < n - half))


def _prefix_xor(hashes: Column) -> Column:
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(hashes, start, lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1).bitwiseXOR(x))))


def _variants_by_array(lines: DataFrame) -> DataFrame:
    here = F.transform("w", lambda w, i: F.xxhash64(w, i))
    moved = F.transform("w", lambda w, i: F.xxhash64(w, i - 1))
    rows = lines.select("place", "same_first", "same_last", F.size("w").alias("n"),
                        _prefix_xor(here).alias("a"), _prefix_xor(moved).alias("b"))
    n = F.col("n")
    deletions = F.transform(
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: _in_edited_half(i, n)),
        lambda i: F.struct(
            F.get("a", i).bitwiseXOR(F.get("b", i + 1)).bitwiseXOR(F.get("b", n)).alias("key"), i.alias("pos")))
    own = F.array(F.struct(F.get("a", n).alias("key"), F.lit(-1).alias("pos")))
    # the outer form, for an inner one brings a filter that computes the array a second time
    return rows.select("place", F.inline_outer(F.concat(own, deletions)))


def _variants_by_window(lines: DataFrame) -> DataFrame:
    words = lines.select("place", "same_first", "same_last", F.size("w").alias("n"),
                         F.posexplode("w").alias("pos", "word"))
    words = words.select("place", "same_first", "same_last", "n", "pos", F.xxhash64("word", "pos").alias("a"),
                         F.xxhash64("word", F.col("pos") - 1).alias("b"))
    before = Window.partitionBy("place").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    totals = words.groupBy("place").agg(F.bit_xor("a").alias("all_a"), F.bit_xor("b").alias("all_b"))
    steps = words.withColumn("pre", F.coalesce(
        F.expr("bit_xor(a ^ b)").over(before), F.lit(0).cast("long"))).join(totals, "place")
    deleted = steps.where(_in_edited_half(F.col("pos"), F.col("n"))).select(
        "place", F.col("pre").bitwiseXOR(F.col("b")).bitwiseXOR(F.col("all_b")).alias("key"), "pos")
    return totals.select("place", F.col("all_a").alias("key"), F.lit(-1).alias("pos")).union(deleted)


def variants(lines: DataFrame) -> DataFrame:
    """(place, key, pos) of each line's own words (pos -1) and of its single-word deletions."""
    short = F.size("w") <= ARRAY_WORDS
    return _variants_by_array(lines.where(short)).unionByName(_variants_by_window(lines.where(~short)))


def _one_edit(x: Column, y: Column) -> Column:
    """Whether two word arrays that differ are one edit apart: what follows the first difference."""
    short = F.least(F.size(x), F.size(y))
    at = F.coalesce(
        F.nullif(F.array_position(F.zip_with(F.slice(x, 1, short), F.slice(y, 1, short), lambda a, b: a == b),
                                  F.lit(False)), F.lit(0)).cast("int") - 1, short)
    def rest(a: Column, skip: int) -> Column:
        return F.slice(a, at + 1 + skip, F.greatest(F.size(a) - at - skip, F.lit(0)))
    gap = F.size(x) - F.size(y)
    return (F.when(gap == 0, rest(x, 1) == rest(y, 1)).when(gap == 1, rest(x, 1) == rest(y, 0))
            .when(gap == -1, rest(x, 0) == rest(y, 1)).otherwise(False))


def near_copies(lines: DataFrame) -> DataFrame:
    """Of lines (place, same_first, same_last, w): (place, earlier) with the earliest partner."""
    emitted = variants(lines)
    shared = emitted.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    met = layer(emitted.join(shared, "key"), "line-variants")
    replaced = (met.where("pos >= 0").groupBy("key", "pos").agg(F.min("place").alias("best"), F.count("*").alias("c"))
                .where("c > 1").drop("c"))
    inserted = (met.groupBy("key").agg(F.min(F.when(F.col("pos") < 0, F.col("place"))).alias("whole"),
                                       F.min(F.when(F.col("pos") >= 0, F.col("place"))).alias("cut"))
                .where("whole is not null and cut is not null"))
    pairs = met.where("pos >= 0").join(replaced, ["key", "pos"]).select("place", "best").union(
        met.join(inserted, "key").select("place", F.when(F.col("pos") < 0, F.col("cut")).otherwise(F.col("whole"))))
    best = pairs.where("best < place").groupBy("place").agg(F.min("best").alias("earlier"))
    x = lines.select("place", F.col("w").alias("x"))
    y = lines.select(F.col("place").alias("earlier"), F.col("w").alias("y"))
    return best.join(x, "place").join(y, "earlier").where(_one_edit(F.col("x"), F.col("y"))).select("place", "earlier")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = True) -> DataFrame:
    """``docs`` with the kept lines as text, and with ``counts`` n_lines, n_dropped (null for a null doc_id)."""
    a_id, a_key, a_n, a_mask = fresh(docs, "__id", "__key", "__n", "__mask")
    with working_layers(docs.sparkSession) as still:
        firsts = layer(first_lines(docs, min_words), "line-first")
        wanted = firsts.join(_with_partner(firsts, min_words), ["h1", "h2"])
        lines = layer(_texts(docs, wanted), "line-words")
        gone = near_copies(lines).select("place.*")
        kept = firsts.select("doc_id", "dkey", "no").join(gone, ["doc_id", "dkey", "no"], "left_anti")
        lists = kept.groupBy("doc_id", "dkey").agg(F.sort_array(F.collect_list("no")).alias("kept"))
        # a byte for each line up to the last kept one: looked up in constant time
        step = F.transform("kept", lambda k, j: F.concat(
            F.repeat(F.lit("0"), k - F.coalesce(F.get("kept", j - 1), F.lit(-1)) - 1), F.lit("1")))
        masks = still(layer(lists.select(
            F.col("doc_id").alias(a_id), F.col("dkey").alias(a_key), F.size("kept").alias(a_n),
            F.array_join(step, "").cast("binary").alias(a_mask)), "line-kept"))
    names = [c for c in docs.columns if not counts or c.lower() not in ("n_lines", "n_dropped")]
    joined = docs.join(small_side(masks),
                       (F.col("doc_id") == F.col(a_id)) & (F.xxhash64("text") == F.col(a_key)), "left")
    stays = F.filter(F.split("text", "\n"), lambda line, i: ~line.rlike(r"\S") | F.coalesce(
        F.substring(a_mask, i + 1, F.lit(1)) == F.lit(b"1"), F.lit(False)))
    full = F.size(F.filter(F.split("text", "\n"), lambda line: line.rlike(r"\S")))
    part = F.col("doc_id").isNotNull()
    text = F.when(part, F.array_join(stays, "\n")).otherwise(F.col("text")).alias("text")
    columns = [text if c == "text" else F.col(f"`{c.replace('`', '``')}`") for c in names]
    if not counts:
        return joined.select(*columns)
    return joined.select(
        *columns,
        F.when(part, F.coalesce(F.size(F.split("text", "\n")), F.lit(0))).cast("long").alias("n_lines"),
        F.when(part, F.coalesce(full - F.coalesce(a_n, F.lit(0)), F.lit(0))).cast("long").alias("n_dropped"))
