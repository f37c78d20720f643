"""Decontamination, top-k, Jaccard join, line dedup, quotation links: brute force and edge cases."""

import itertools
import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from ratelens import session
from ratelens.llm import common, decontaminate, line_dedup, ngram_join, quote_links, topk
from ratelens.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings benchmark conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(
        (tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_native_operators_run_no_python(spark):
    docs, bench = (common.table(spark, SF, t) for t in ("documents", "benchmark"))
    chats = common.table(spark, SF, "conversations")
    for df in (decontaminate.contaminated(docs, bench), line_dedup.dedup_lines(docs), quote_links.link_quotes(chats)):
        assert not any(x in plan_of(df) for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# --------------------------------------------------------------------------- components

@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components_equal_union_find(spark, edges):
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_components_raise_when_their_rounds_run_out(spark):
    path = spark.range(400).selectExpr("id as a", "id + 1 as b")
    with pytest.raises(RuntimeError, match="2 rounds"):
        common.components(path, max_rounds=2)


def test_sides_are_measured(spark, monkeypatch):
    def broadcast(df):
        return "broadcast" in common.small_side(df)._jdf.queryExecution().logical().toString().lower()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 10_000)
    rows = spark.range(10)
    assert broadcast(rows.selectExpr("id", "'short' as t")) and broadcast(spark.range(0))
    assert not broadcast(rows.selectExpr("id", "repeat('x', 2000) as t"))
    assert not broadcast(rows.selectExpr("id", "sequence(1L, 200L) as t"))
    assert not broadcast(spark.range(1000))


def test_components_of_a_long_path(spark):
    got = common.components(spark.range(300).selectExpr("id as a", "id + 1 as b")).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}


# --------------------------------------------------------------------------- decontamination

def words_of(text):
    return [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]


def shingles_of(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_contamination_equals_brute_force(spark):
    r = random.Random(1)
    vocab = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(vocab, k=r.randrange(1, 40)))) for i in range(25)] + [(90, None), (91, " !"), (None, "a b")]
    docs = []
    for i in range(60):
        text = r.choices(vocab, k=r.randrange(0, 120))
        if i % 2:
            part = items[r.randrange(25)][1].split()
            for _ in range(r.randrange(3)):
                part[r.randrange(len(part))] = "zz"
            text[len(text) // 2:len(text) // 2] = part
        docs.append((i, ", ".join(text).upper() if i % 3 else " ".join(text), 1))
    docs += [(100, None, 1), (101, "", 1), (None, items[0][1], 1), docs[1], docs[1]]
    df = spark.createDataFrame(docs, "doc_id long, text string, sh int")
    got = {(x.doc_id, x.item_id): (x.n_item, x.n_shared) for x in decontaminate.contaminated(
        df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for d, t, _ in docs:
        for i, b in items:
            n = min(5, len(words_of(b)))
            s, held = shingles_of(b, 5), shingles_of(t, n) if n and len(words_of(t)) >= n else set()
            if d is not None and i is not None and s and len(s & held) >= math.ceil(0.8 * len(s) - 1e-9):
                want[d, i] = (len(s), len(s & held))
    assert got == want and len(want) > 10


def test_short_items_are_found_in_long_documents(spark):
    docs = spark.createDataFrame([(1, "one two three four five six " * 50 + "needle in haystack end"), (2, "Two, three!"), (3, "in needle"),
                                  (4, "x" * 10), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three"), (2, "needle in haystack end"), (3, "needle"), (4, "three two one zero"), (5, "")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1), (1, 2), (1, 3), (2, 1), (3, 3)}


def test_contamination_edges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (1, "other words here now ok", "y"), (2, None, "z"),
                                  (None, "a b c d e f g", "n")], "doc_id long, text string, __id string")
    items = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 7)]
    empty = items.limit(0)
    assert decontaminate.contaminated(docs, empty).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    docs = docs.withColumnRenamed("__id", "hash")
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["hash"] for r in kept.collect()) == ["n", "y", "z"]


# --------------------------------------------------------------------------- top-k

def plain_top(rows, k):
    out = []
    good = [(i, q) for i, v in rows if i is not None and (q := topk.quantise(v)) is not None]
    asked = {(i, tuple(q)) for i, q in good if i % 50 == 0}
    for i, q in asked:
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(q, c, strict=False)), j) for j, c in good if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_topk_equals_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([0.0, 0.5, -0.25, r.random()]) for _ in range(r.choice([6, 6, 4]))]) for i in range(160)]
    rows += [(200, None), (250, [1.0, None]), (251, [float("nan")] * 6), (252, []), (None, [1.0] * 6), rows[3], rows[50]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn
    vectors = df("score", common.F.lit(1)).select("vec_id", "embedding").repartition(3)
    got = topk.search(vectors, vectors.where("vec_id % 50 = 0"), 5)
    assert sorted(map(tuple, got.collect())) == plain_top(rows, 5)


def test_topk_huge_components_and_few_rows(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [-1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.search(df, df.where("vec_id = 0"), 5).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


# --------------------------------------------------------------------------- Jaccard join

def plain_join(rows):
    sets = []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j:j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    n = len(rows)
    link = [[a != b and sets[a] and rows[a][0] is not None and rows[b][0] is not None
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) for b in range(n)] for a in range(n)]
    root = [r[0] for r in rows]
    for _ in range(n):
        for a, b in itertools.product(range(n), repeat=2):
            if link[a][b]:
                root[a] = root[b] = min(root[a], root[b])
    return sorted((rows[a][0], len(sets[a]), root[a], sum(map(bool, link[a]))) for a in range(n) if rows[a][0] is not None)


def near_corpus(seed, bases=6, copies=9):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for b in range(bases):
        base = r.choices(vocab, k=r.choice([3, 30, 80, 150]))
        for _ in range(copies):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                text[r.randrange(len(text))] = r.choice(vocab)
            docs.append(" ".join(text))
    r.shuffle(docs)
    return [(i + 1, t, "x") for i, t in enumerate(docs)]


@pytest.mark.parametrize("cold,unit", [(64, 2_000_000), (2, 2_000_000), (3, 400)])
def test_join_equals_brute_force(spark, monkeypatch, cold, unit):
    monkeypatch.setattr(ngram_join, "COLD", cold)
    rows = near_corpus(cold) + [(900, None, "x"), (901, "", "x"), (902, " \t", "x"), (903, "Solo", "x"), (904, "sOLO", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    got = ngram_join.join(df, unit=unit).select("doc_id", "n_shingles", "component_id", "n_links")
    assert sorted(map(tuple, got.collect())) == plain_join(rows)


@settings(max_examples=60, deadline=None)
def names_since(spark, mark):
    return [x.rpartition("/")[2].rpartition("-")[0] for x in session._written(spark)[mark:]]


def test_cut_units_take_turns(spark, monkeypatch):
    """Blocks of few shingles: the texts dealt to pairs of blocks are more than the corpus, which is the most at a time."""
    monkeypatch.setattr(ngram_join, "WAVE", 1)
    turns = []
    units = ngram_join._units
    monkeypatch.setattr(ngram_join, "_units", lambda texts, *turn: turns.append(turn) or units(texts, *turn))
    rows = near_corpus(11, bases=2, copies=12)
    df = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    got = ngram_join.join(df, unit=200).select("doc_id", "n_shingles", "component_id", "n_links")
    assert sorted(map(tuple, got.collect())) == plain_join(rows)
    assert len(turns) > 1 and [t for t, _ in turns] == list(range(turns[0][1]))


def test_only_layers_that_results_read_stay(spark):
    rows = near_corpus(5, bases=3)
    df = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    mark = session.layers_mark(spark)
    got = ngram_join.join(df).select("doc_id", "n_shingles", "component_id", "n_links")
    assert names_since(spark, mark) == ["join-rows", "join-facts"]
    assert sorted(map(tuple, got.collect())) == plain_join(rows)


@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=9), min_size=2, max_size=9), st.booleans())
def test_unit_links_are_exact(sets, blocks):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    copies = [i % 3 + 1 for i in range(len(sets))]
    block = [i % 2 for i in range(len(sets))] if blocks else None
    got = {k: n for k, _, n in ngram_join.verify_unit(list(range(len(sets))), arrays, copies, block)}
    for a, x in enumerate(sets):
        assert got[a] == sum(copies[b] for b, y in enumerate(sets) if a != b and 100 * len(x & y) >= 85 * len(x | y)
                             and (block is None or block[a] != block[b]))


@given(st.integers(1, 400), st.integers(1, 400), st.integers(0, 400))
def test_sample_filter_is_lossless_by_size(x, y, shared):
    """The bound on shared sample shingles never exceeds what the smaller sample's margin grants."""
    x, y = max(x, y), min(x, y)
    if 100 * y >= 85 * x:
        margin = min(max(1, x // 40), max(1, y // 40))
        assert ngram_join.sample_shared(x) <= margin and ngram_join.sample_shared(y) <= max(1, y // 40)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10**6))
def test_suffix_filter_loses_no_link(shared, only_a, only_b, seed):
    r = random.Random(seed)
    tokens = [r.getrandbits(64) for _ in range(shared + only_a + only_b)]
    a = np.array(sorted(tokens[:shared + only_a]), dtype=np.uint64)
    b = np.array(sorted(tokens[:shared] + tokens[shared + only_a:]), dtype=np.uint64)
    linked = 100 * shared >= 85 * len(tokens)
    assert ngram_join.may_link(len(a), len(b), ngram_join.range_counts(a), ngram_join.range_counts(b)) or not linked


def test_suffix_filter_parts_unrelated_sets():
    r = random.Random(5)
    for n in (60, 500, 20_000):
        a, b = (np.array(sorted(r.getrandbits(64) for _ in range(n)), dtype=np.uint64) for _ in range(2))
        assert not ngram_join.may_link(n, n, ngram_join.range_counts(a), ngram_join.range_counts(b))


def test_join_edges(spark):
    schema = "doc_id long, text string, n long"
    df = spark.createDataFrame([(5, "a b c d e", 1), (5, "a b c d e", 1), (5, "quite other words in here", 1),
                                (7, "A B c d e", 1), (None, "a b c d e", 1)], schema)
    got = ngram_join.join(df).collect()
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in got if r.doc_id) == [(5, 5, 0), (5, 5, 2), (5, 5, 2), (7, 5, 2)]
    assert [(r.component_id, r.n_links) for r in got if r.doc_id is None] == [(None, 0)]
    assert ngram_join.join(df.limit(0)).count() == 0
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) in (
        [(0, "a b c d e"), (5, "a b c d e"), (5, "quite other words in here")],)


# --------------------------------------------------------------------------- line dedup

def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_dedup(rows):
    seen, out = [], {}
    for i, t, *_ in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        kept = []
        for line in t.split("\n"):
            w = line.lower().split()
            if not w:
                kept.append(line)
                continue
            if not any(w == s or (min(len(w), len(s)) >= 8 and distance_one(w, s)) for s in seen):
                kept.append(line)
            seen.append(w)
        out[i] = "\n".join(kept)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "ARRAY_WORDS", [1024, 9, 12][seed])
    r = random.Random(seed)
    vocab = ["a", "b", "c", "the", "of"]
    lines = [[r.choice(vocab) for _ in range(r.choice([1, 3, 8, 9, 10, 14]))] for _ in range(25)]
    rows = []
    for i in range(40):
        part = []
        for _ in range(r.randrange(6)):
            w = list(r.choice(lines))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                at = r.randrange(len(w) + 1)
                w[at:at + r.choice([0, 1])] = r.choice([[], ["zz"], ["a"]])
            part.append(r.choice([" ".join(w), "  ".join(w).upper(), "", " ".join(w)]))
        rows.append((i, "\n".join(part), "x"))
    df = spark.createDataFrame(rows + [(50, None, "x")], "doc_id long, text string, place string")
    got = {x.doc_id: x for x in line_dedup.dedup_lines(df).collect()}
    want = plain_dedup(rows)
    assert {i: x.text for i, x in got.items() if i != 50} == want and got[50].text is None
    for i, t, _ in rows:
        assert got[i].n_lines == t.count("\n") + 1
        assert got[i].n_dropped == sum(bool(x.split()) for x in t.split("\n")) - sum(bool(x.split()) for x in want[i].split("\n"))


def test_line_dedup_edges(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    df = spark.createDataFrame(
        [(1, long + "\n\nx", 1, "q"), (1, long + "\n\nx", 1, "q"), (2, long + " extra\ny", 2, "r"), (None, "x", 3, "s"),
         (3, "", 4, "t"), (3, "x\nnew", 5, "u")], "doc_id long, text string, n_lines long, w string")
    got = sorted(((r.doc_id or 0), r.w, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(0, "s", "x"), (1, "q", long + "\n\nx"), (1, "q", long + "\n\nx"), (2, "r", "y"), (3, "t", ""),
                   (3, "u", "new")]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b\nc d", 500, 600, "m", "k", "i", 7), (2, "c d\ne f", 501, 601, "m", "k", "i", 8)],
                               "doc_id long, text string, n_lines long, `__n` long, `__mask` string, `__KEY` string, __id string, `a.b` int")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert (got[2].text, got[2].n_lines, got[2].n_dropped, got[2]["__n"], got[2]["a.b"]) == ("e f", 2, 1, 601, 8)
    same = {r.doc_id: r for r in line_dedup.dedup_lines(df, counts=False).collect()}
    assert same[2].n_lines == 501 and same[2].text == "e f" and list(same[2].asDict()) == df.columns


def test_line_on_a_third_of_all_documents(spark):
    df = spark.range(300).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same old line', concat('only ', id)) as text")
    got = line_dedup.dedup_lines(df).agg(common.F.sum("n_dropped")).first()[0]
    assert got == 99


# --------------------------------------------------------------------------- quotation links

def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nThanks"),
        (1, 1, "assistant", "On Monday user wrote:\n> how do i  SORT?\n> Thanks\nUse sort()."),
        (1, 2, "user", ">> How do I sort?\n> Use sort().\nIt works"),
        (2, 0, "user", "> Use sort().\nReally?"),
        (2, 1, "user", "> never said\nok"),
        (3, 0, "user", "> > deep\nhm"),
        (None, 0, "user", "> Use sort().\nx"),
        (4, 0, "user", None),
        (4, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("run", common.F.lit(1))
    got = {(r.conv_id, r.turn): r for r in quote_links.link_quotes(df).collect()}
    a = got[1, 1]
    assert (a.content, a.parent_conv, a.parent_turn, a.n_quotes, a.max_level) == ("Use sort().", 1, 0, 1, 1)
    b = got[1, 2]
    assert (b.content, b.parent_turn, b.n_quotes, b.n_linked, b.max_level) == ("It works", 1, 2, 2, 2)
    c = got[2, 0]
    assert (c.conversation, c.parent_conv, c.parent_turn, c.content) == (1, 1, 1, "Really?")
    assert got[2, 1].parent_conv is None and got[2, 1].conversation == 2 and got[2, 1].content == "ok"
    assert got[3, 0].max_level == 2 and got[None, 0].conversation is None and got[None, 0].position == 0
    assert [got[k].position for k in ((1, 0), (1, 1), (1, 2), (2, 0))] == [1, 2, 3, 4]
    assert quote_links.link_quotes(df).count() == len(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    rel = con.sql(ORACLE["op6_chat_formatting"])
    assert sorted(rel.fetchall(), key=repr) == sorted(
        map(tuple, quote_links.link_quotes(df).select(*rel.columns).collect()), key=repr)
    assert quote_links.link_quotes(df.limit(0)).count() == 0


def test_long_conversation_positions(spark):
    df = spark.range(3000).selectExpr("1L as conv_id", "id as turn", "'user' as role",
                                      "if(id = 0, 'first one', concat('> first one\\nmessage ', id)) as text")
    got = quote_links.link_quotes(df).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 3001)) and [r.turn for r in got] == list(range(3000))
    assert {r.parent_turn for r in got[1:]} == {0}


def test_reply_chains_reach_their_root(spark):
    rows = [(i, 0, "u", "start" if i == 0 else f"> {'start' if i == 1 else f'say {i - 1}'}\nsay {i}") for i in range(20)]
    got = quote_links.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [(r.conversation, r.position, r.conv_id) for r in got.orderBy("position").collect()] == [
        (0, i + 1, i) for i in range(20)]
