"""Quality rules, hard negatives, conversation trie: brute force and edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.llm import hard_negatives, host_quality, prefix_trie, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


# --------------------------------------------------------------------------- quality rules

def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {i + k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(8)}
    lines, seen = [x for x in text.split("\n") if WORD.search(x)], set()
    dup = sum(1 for x in lines if x in seen or seen.add(x))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), dup, len(covered))


def test_measures_equal_brute_force():
    r = random.Random(3)
    texts = [None, "", " \n\t ", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "é\x85b\xa0c\x1cd\n\n\x0b",
             "#*$ %&|<> #", "a\na\n a\na \n", "\ud800 x", "p q " * 3000]
    for _ in range(200):
        texts.append("".join(r.choice(["a ", "b ", "c\n", "\n", "d\t", "# ", "ä "]) for _ in range(r.randrange(0, 120))))
    for t in texts:
        assert host_quality.measure(t) == brute_measures(t), t


GOOD = " ".join(f"word{i}" for i in range(40))
BAD = " ".join("#$%&"[i % 4] * (1 + i // 4) for i in range(40)) + " " + GOOD


def quality_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string, kept int, n int")
    return host_quality.judge(df, **kw)


def test_bad_host_goes_and_small_host_is_shrunk(spark):
    rows = [(i, GOOD if i % 10 else BAD, f"h{i % 7}", "clash", 5, 5) for i in range(700)]
    rows += [(1000 + i, BAD if i % 20 else GOOD, "junk", None, None, None) for i in range(200)]
    rows += [(2000, BAD, "tiny", None, None, None)]  # one bad document does not condemn a host
    rows += [(2001, "too short", "h1", None, None, None), (2002, None, "h1", None, None, None)]
    got = {r.doc_id: r for r in quality_of(spark, rows).collect()}
    assert len(got) == len(rows)
    for doc_id, text, source, *_ in rows:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == brute_measures(text)
        assert r.host_failed == (source == "junk")
        assert r.kept == (not r.base_failed and source != "junk")
    assert got[1001].failed_rules == "symbols" and got[2000].kept and got[2001].base_failed and got[2002].base_failed


def test_priors_by_hand(spark):
    hosts = [("a", 10, 1), ("b", 20, 4), ("c", 40, 30), ("d", 5, 0)]
    rates = spark.createDataFrame([(d, n, "r", f) for d, n, f in hosts] + [("a", 10, "even", 5), ("b", 10, "even", 5)],
                                  "domain string, n long, rule string, failed long")
    p = np.array([f / n for _, n, f in hosts])
    inv, mean = np.mean([1 / n for _, n, _ in hosts]), p.mean()
    true = (p.var(ddof=1) - mean * (1 - mean) * inv) / (1 - inv)
    got = {r.rule: r for r in host_quality.priors(rates).collect()}
    assert got["r"].mean == pytest.approx(mean)
    assert got["r"].strength == pytest.approx(max(host_quality.WEAKEST, mean * (1 - mean) / true - 1))
    # hosts that differ by less than chance: the strongest prior, everything is shrunk to the mean
    assert got["even"].strength == host_quality.STRONGEST
    verdict = {(r.domain, r.rule): r for r in host_quality.host_verdicts(rates).collect()}
    k = got["r"].strength
    for d, n, f in hosts:
        assert verdict[d, "r"].rate == pytest.approx((f + mean * k) / (n + k))


def test_quality_without_hosts_or_rows(spark):
    rows = [(1, BAD, None, None, None, None), (1, BAD, "", None, None, None), (None, None, None, None, None, None)]
    got = quality_of(spark, rows).collect()
    assert len(got) == 3 and not any(r.host_failed for r in got) and sorted(r.kept for r in got) == [False, True, True]
    assert quality_of(spark, []).count() == 0
    one = [(i, BAD, "only", None, None, None) for i in range(50)]  # a single host is its own prior
    assert all(r.host_failed for r in quality_of(spark, one).collect())


def test_host_of(spark):
    df = spark.createDataFrame([("HTTPS://www.A.example:80/x?y",), ("ftp://u:p@b.c#d",), ("no host",), (None,)], "url string")
    assert [r[0] for r in df.select(host_quality.host_of(F.col("url"))).collect()] == ["a.example", "b.c", None, None]


# --------------------------------------------------------------------------- hard negatives

def brute_negatives(rows, anchors, positives, k, low, high):
    ok = [(v, [math.floor(256 * x) for x in e], l) for v, e, l in rows
          if v is not None and l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    asked = {(v, tuple(e), l) for v, e, l in ok if v in anchors}
    out = []
    for a, vec, label in asked:
        scored = []
        for v, e, l in ok:
            if v != a:
                s = sum(x * y for x, y in zip(vec, e, strict=False))
                scored.append((-max(-2**63 + 1, min(2**63 - 1, s)), v, l))
        scored.sort()
        for p, pid, _ in [x for x in scored if x[2] == label][:positives]:
            hits = [x for x in scored if x[2] != label and low * -p <= 100 * -x[0] <= high * -p][:k]
            out += [(a, pid, i, v, -p, -s) for i, (s, v, _) in enumerate(hits, 1)]
    return sorted(out)


def negatives_of(spark, rows, anchors, positives, k, low, high, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label int").repartition(parts)
    got = hard_negatives.mine(df, df.where(F.col("vec_id").isin(list(anchors))), positives, k, low, high)
    return sorted(map(tuple, got.drop("positive_rank").collect()))


@pytest.mark.parametrize("seed,positives,k,low,high", [(1, 5, 10, 30, 90), (2, 3, 2, 0, 100), (3, 8, 4, 50, 60), (4, 1, 1, 90, 10)])
def test_negatives_equal_brute_force(spark, seed, positives, k, low, high):
    r = random.Random(seed)
    # small integers: many ties in scores; copies of vectors; a label that holds half of the rows
    rows = [(i, [r.choice([-1, 0, 1, 2]) / 256 for _ in range(6)], r.choice([0, 0, 0, 1, 2, 3])) for i in range(150)]
    rows += [(200 + i, rows[i % 5][1], i % 2) for i in range(30)]
    anchors = set(range(0, 150, 7))
    got = negatives_of(spark, rows, anchors, positives, k, low, high, parts=1 + seed)
    assert got == brute_negatives(rows, anchors, positives, k, low, high)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [0.5, 0.5], 1), (2, [0.4, 0.1], 2), (3, None, 1), (4, [nan, 1.0], 2), (5, [1.0, inf], 2),
            (6, [None, 1.0], 2), (7, [1.0, 0.1], None), (None, [0.4, 0.1], 2), (8, [0.3], 2), (9, [], 2), (10, [0.4, 0.1, 9.0], 3),
            (2, [0.4, 0.1], 2), (0, [1.0, 1.0], 1), (11, [-1.0, -1.0], 1)]
    got = negatives_of(spark, rows, {0, 11}, 5, 10, 30, 90)
    assert got == brute_negatives(rows, {0, 11}, 5, 10, 30, 90) and [x[3] for x in got if x[1] == 1] == [2, 2, 10]
    assert negatives_of(spark, [], {0}, 5, 10, 30, 90) == []
    assert negatives_of(spark, [(0, [1.0], 1), (1, [1.0], 2)], {0}, 5, 10, 30, 90) == []


def test_negatives_with_huge_components_are_exact(spark):
    r = random.Random(9)
    rows = [(i, [r.uniform(0, 1) * 10.0 ** r.choice([0, 5, 6]) for _ in range(4)], i % 2) for i in range(40)]
    rows += [(100 + i, [1e300, 1.0, 0.0, 1.0], i % 2) for i in range(4)]
    assert negatives_of(spark, rows, {0, 3, 100}, 4, 3, 30, 90) == brute_negatives(rows, {0, 3, 100}, 4, 3, 30, 90)


# --------------------------------------------------------------------------- conversation trie

def brute_trie(rows, base=lambda c: c, heads=lambda c: 0):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in convs.items()}
    built = {c: tuple(own.get(base(c), [])[:heads(c)] + turns[heads(c):]) for c, turns in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, path in built.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    out = []
    for node, mine in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = sum(len(x) == len(node) + 1 for x in below)
        leaves = sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        out.append((min(mine), len(node), min(members[node[:-1]]) if node else None, len(mine), children, leaves, saved,
                    hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = "conv_id long, turn long, role string, text string, depth int, key string, block string"


def trie_of(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 7, "k", "b") for r in rows], COLUMNS)
    return sorted(map(tuple, prefix_trie.conversation_trie(df, **kw).drop("key").collect()), key=repr)


def some_conversations(seed, n=40, longest=7):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randrange(1, longest)):
            rows.append((c * 3 - 20, t, r.choice(["u", None]), r.choice(["hi there", "yes", "", None, "no no\nno"])))
    return rows


@pytest.mark.parametrize("wide,band,block", [(256, 256, 1024), (0, 1, 2), (0, 3, 2), (3, 2, 3), (10, 1, 1)])
def test_trie_equals_brute_force(spark, monkeypatch, wide, band, block):
    monkeypatch.setattr(prefix_trie, "WIDE", wide)
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rows = some_conversations(wide + band + block)
    rows += [(500, t, "u", f"t{t % 3}") for t in range(12)] + [(501, t, "u", f"t{t % 3}") for t in range(11)]
    assert trie_of(spark, rows) == brute_trie(rows)
    c = F.col("conv_id")
    got = trie_of(spark, rows, base=c - c % 20, heads=F.crc32(c.cast("string").cast("binary")) % 4, max_heads=3)
    assert got == brute_trie(rows, lambda c: c - int(math.fmod(c, 20)), lambda c: zlib.crc32(str(c).encode()) % 4)


def test_trie_of_copies_and_odd_rows(spark):
    rows = [(c, t, "u", f"say {t}") for c in range(300) for t in range(3)]  # one conversation, many times
    rows += [(None, 0, "u", "x"), (900, None, None, None), (900, 2, "u", "say 0"), (900, 2, "u", "say 0"), (901, None, "", "")]
    rows += [(902, 0, "u", "long word " * 30_000), (903, 0, "u", "long word " * 30_000)]
    got = trie_of(spark, rows)
    assert got == brute_trie(rows) and (0, 3, 0, 300, 0, 1, 598, got[[g[:2] for g in got].index((0, 3))][-1]) in got
    assert trie_of(spark, []) == [] and trie_of(spark, [(None, 1, "u", "x")]) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "c")]
    got = trie_of(spark, rows, base=F.lit(99).cast("long"), heads=F.lit(1), max_heads=1)
    assert got == brute_trie(rows, lambda c: 99, lambda c: 1)
    assert [g for g in got if g[1] == 0][0][-1] == hashlib.sha256(b"2").hexdigest()


def test_equal_turn_numbers_order_alike_in_all_conversations(spark):
    turns = [(0, "u", "x"), (0, "u", "y"), (0, "a", "x"), (None, "u", "z"), (1, "u", "w")]
    rows = [(c, *t) for c, p in enumerate(itertools.islice(itertools.permutations(turns), 0, 120, 17)) for t in p]
    got = trie_of(spark, rows)
    assert len(got) == 6 and {g[3] for g in got} == {len(rows) // 5}


def test_queries_are_the_operators_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, vecs, chats = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "embeddings", "conversations"))
    assert queries.op11_quality_rules(spark, sf).count() == docs.count()
    got = queries.op12_hard_negatives(spark, sf)
    assert {r[0] for r in got.select("anchor_id").distinct().collect()} <= {
        r[0] for r in vecs.where("vec_id % 100 = 0").select("vec_id").collect()}
    assert queries.op13_prefix_trie(spark, sf).where("depth = 0").first().n_convs == chats.select("conv_id").distinct().count()
