import math

import pytest

from ratelens import contracts as C
from ratelens.operators.anomalies import ARTEFACT_TYPES, compare_periods, detect_anomalies
from ratelens.operators.segments import segment_cube

from .fixtures import planted, to_df, same_schema

SEG_COLS = [f.name for f in C.SEGMENT.fields]


def seg_rows(spark, rows):
    full = []
    for r in rows:
        d = dict(zip(SEG_COLS, [None] * len(SEG_COLS)))
        d.update(r)
        full.append(tuple(d[c] for c in SEG_COLS))
    return spark.createDataFrame(full, C.SEGMENT)


def s(t, key, period, total, ok, amount=100.0):
    return {"segment_type": t, "segment_key": key, "period": period, "total_transactions": total,
            "approved_transactions": ok, "declined_transactions": total - ok,
            "approval_rate": ok / total, "total_amount_usd": amount, "approved_amount_usd": amount}


def test_period_join_semantics(spark):
    segs = seg_rows(spark, [
        s("country", "BR", "weeks_1_3", 100, 80), s("country", "BR", "weeks_4_6", 100, 60),
        s("country", "MX", "weeks_1_3", 50, 40),                      # baseline only: kept, current 0
        s("country", "CO", "weeks_4_6", 70, 10),                      # current only: dropped
        s("issuer", "MX|BBVA", "weeks_1_3", 10, 9), s("country_issuer", "MX|BBVA", "weeks_1_3", 10, 1),
        s("issuer", "MX|BBVA", "weeks_4_6", 10, 5),
        s("country", None, "weeks_1_3", 5, 5), s("country", None, "weeks_4_6", 5, 1),  # null key never matches
    ])
    got = {r.segment_key: r for r in compare_periods(segs).collect()}
    assert set(got) == {"BR", "MX", "MX|BBVA", None}
    assert got["MX"].current_total == 0 and got["MX"].current_rate == 0.0
    # country_issuer (priority 4) beats issuer (7) in the baseline; current has only issuer
    assert got["MX|BBVA"].segment_type == "country_issuer" and got["MX|BBVA"].baseline_rate == 0.1
    assert got["MX|BBVA"].current_rate == 0.5
    assert got[None].current_total == 0


def test_zero_std_gives_zero_z_and_guards(spark):
    segs = seg_rows(spark, [s("country", k, h, 100, 80) for k in ("A", "B") for h in ("weeks_1_3", "weeks_4_6")])
    out = detect_anomalies(segs).collect()
    assert all(r.z_score == 0.0 for r in out)
    assert all(r.p_value == 1.0 or r.p_value > 0.99 for r in out)
    assert not any(r.is_anomaly for r in out)


def test_revenue_impact_formula(spark):
    segs = seg_rows(spark, [s("country", "A", "weeks_1_3", 300, 240, 3000.0),
                            s("country", "A", "weeks_4_6", 300, 150, 6000.0)])
    r = detect_anomalies(segs).collect()[0]
    assert r.affected_transactions == 300
    assert r.estimated_revenue_impact_usd == pytest.approx(300 / 3 * 20.0 * 0.3 * 4.33)


def test_planted_pattern_flagged(spark):
    seg = segment_cube(to_df(spark, planted()))
    an = detect_anomalies(seg)
    assert same_schema(an.schema, C.ANOMALY)
    rows = {r.segment_key: r for r in an.collect()}
    bbva = rows["MX|BBVA"]
    assert bbva.is_anomaly and bbva.rate_change == pytest.approx(-0.44)
    assert bbva.p_value < 1e-6
    # flat segments are not flagged
    assert not rows["BR|Itau"].is_anomaly


def test_exclude_artefact_types(spark):
    seg = segment_cube(to_df(spark, planted()))
    all_types = {r.segment_type for r in detect_anomalies(seg).select("segment_type").distinct().collect()}
    kept = {r.segment_type for r in detect_anomalies(seg, exclude_types=ARTEFACT_TYPES)
            .select("segment_type").distinct().collect()}
    assert "time_weekly" in all_types and not (kept & set(ARTEFACT_TYPES))


def test_mean_std_population(spark):
    segs = seg_rows(spark, [s("country", k, h, 100, ok) for k, (b, c) in
                            {"A": (80, 70), "B": (80, 80), "C": (50, 90)}.items()
                            for h, ok in (("weeks_1_3", b), ("weeks_4_6", c))])
    out = {r.segment_key: r.z_score for r in detect_anomalies(segs).collect()}
    xs = {"A": -0.1, "B": 0.0, "C": 0.4}
    m = sum(xs.values()) / 3
    sd = math.sqrt(sum((x - m) ** 2 for x in xs.values()) / 3)
    for k, x in xs.items():
        assert out[k] == pytest.approx((x - m) / sd)
