import random

import pytest

from ratelens import contracts as C
from ratelens.operators.anomalies import detect_anomalies
from ratelens.operators.insights import candidates, diverse_top_k, rank_insights, score, summary
from ratelens.operators.segments import segment_cube
from ratelens.session import cut_lineage

from .fixtures import planted, to_df, same_schema

AN_COLS = [f.name for f in C.ANOMALY.fields]


def an_rows(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in AN_COLS) for r in rows], C.ANOMALY)


def a(key, t, change, impact, flagged=True, p=0.01, z=-2.5, n=100):
    return {"segment_key": key, "segment_type": t, "baseline_rate": 0.8, "current_rate": 0.8 + change,
            "rate_change": change, "z_score": z, "p_value": p, "is_anomaly": flagged,
            "affected_transactions": n, "estimated_revenue_impact_usd": impact}


def test_planted_pattern_ranked(spark):
    an = detect_anomalies(segment_cube(to_df(spark, planted())))
    ins = rank_insights(an)
    assert same_schema(ins.schema, C.INSIGHT)
    rows = ins.orderBy("rank").collect()
    assert 3 <= len(rows) <= 5
    assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
    top = rows[0]
    assert "BBVA" in top.segment_key and top.rate_change < -0.4
    assert "Approval Rate Collapsed" in top.title and "dropped from" in top.description
    assert any(r.segment_key == "MX|BBVA" or r.segment_key.startswith("MX|BBVA|") for r in rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_diverse_top_k_properties(spark, seed):
    rnd = random.Random(seed)
    cats = ["issuer", "amount", "time", "geo", "instrument", "other"]
    rows = [{"segment_key": f"k{i:03d}", "category": rnd.choice(cats[: rnd.randint(1, 6)]),
             "score": round(rnd.random(), 2)} for i in range(40)]
    df = spark.createDataFrame(rows, "segment_key string, category string, score double")
    for k in (1, 3, 5, 8):
        got = diverse_top_k(df, k).orderBy("rank").collect()
        beats = {r["segment_key"]: (-r["score"], r["segment_key"]) for r in rows}  # smaller is better
        chosen = [r.segment_key for r in got]
        assert len(chosen) == len(set(chosen)) == min(k, len(rows))
        assert [r.rank for r in got] == list(range(1, len(got) + 1))
        assert chosen == sorted(chosen, key=beats.get)
        best = {}
        for r in rows:
            best[r["category"]] = min(best.get(r["category"], r["segment_key"]), r["segment_key"], key=beats.get)
        # each chosen category is there with its best row; no category is left out for a filler
        cats_in = {r.category for r in got}
        assert all(best[c] in chosen for c in cats_in)
        fillers = [c for c in chosen if c not in best.values()]
        assert not fillers or cats_in == set(best)
        # nobody left out beats a filler, nor, within the winners, a chosen winner
        left = [x for x in beats if x not in chosen]
        assert all(beats[f] < beats[x] for f in fillers for x in left)
        assert all(beats[best[c]] < beats[best[d]] for c in cats_in for d in set(best) - cats_in)


def test_fallback_tops_up_to_min_n(spark):
    rows = [a("A", "issuer", -0.3, 9000.0), a("B", "country", -0.1, 50.0, flagged=False),
            a("C", "card_type", -0.1, 700.0, flagged=False), a("D", "hour_bucket", 0.1, 300.0, flagged=False)]
    got = {r.segment_key for r in candidates(an_rows(spark, rows), min_n=3).collect()}
    assert got == {"A", "C", "D"}
    got = {r.segment_key for r in candidates(an_rows(spark, rows[:1] * 1), min_n=1).collect()}
    assert got == {"A"}


def test_scores_all_equal_normalise_to_zero(spark):
    rows = [a(k, "country", -0.1, 100.0) for k in "ABC"]
    sc = score(an_rows(spark, rows)).collect()
    assert all(r.impact_norm == 0.0 and r.magnitude_norm == 0.0 and r.significance_norm == 0.0 for r in sc)
    assert all(r.score == pytest.approx(0.25 * 0.3) for r in sc)


def test_one_category_only_and_severity(spark):
    rows = [a(f"MX|B{i}", "issuer", -0.05 * i, 10_000.0 * i) for i in range(1, 8)]
    ins = rank_insights(an_rows(spark, rows)).orderBy("rank").collect()
    assert len(ins) == 5
    assert ins[0].segment_key == "MX|B7" and ins[0].severity == "critical"
    assert {r.severity for r in ins} <= {"critical", "high", "medium", "low"}


def test_summary_counts(spark):
    rows = [a("A", "issuer", -0.3, 60_000.0), a("B", "country", -0.2, 25_000.0),
            a("C", "card_type", -0.1, 100.0, flagged=False)]
    an = an_rows(spark, rows)
    ins = rank_insights(an)
    sm = summary(an, ins).collect()[0]
    assert sm.anomalies_detected == 2
    assert sm.critical_insights == 1 and sm.high_insights == 1 and sm.low_insights == 1
    assert sm.total_monthly_revenue_impact_usd == pytest.approx(85_100.0)
    assert sm.overall_baseline_rate == 0.8 and sm.analysis_timestamp.endswith("+00:00")


def test_scores_within_unit_interval(spark):
    an = detect_anomalies(segment_cube(to_df(spark, planted())))
    sc = score(candidates(an)).collect()
    assert sc and all(0.0 <= r.score <= 1.0 for r in sc)
    assert all(0.0 <= getattr(r, c) <= 1.0 for r in sc for c in ("impact_norm", "magnitude_norm",
                                                                    "significance_norm"))
