import pytest
from pyspark.sql import functions as F

from ratelens.operators.anomalies import detect_anomalies
from ratelens.operators.enrich import enrich, fx_normalise
from ratelens.operators.extensions import risk_score, time_bucket_rates
from ratelens.operators.insights import rank_insights
from ratelens.operators.segments import segment_cube
from ratelens.operators.trends import (half_period_rate, overall_kpi, pattern_audit, weekly_trends,
                                       weekly_trends_from_segments)
from ratelens.operators import views as V

from .fixtures import planted, to_df


@pytest.fixture(scope="module")
def layers(spark):
    raw = to_df(spark, planted())
    enriched = enrich(raw)
    seg = segment_cube(enriched)
    trends = weekly_trends(raw)
    ins = rank_insights(detect_anomalies(seg))
    return raw, enriched, seg, trends, ins


def test_trend_from_segments_equals_direct(layers):
    raw, _, seg, trends, _ = layers
    assert weekly_trends_from_segments(seg).collect() == trends.collect()
    k = overall_kpi(raw).collect()[0]
    assert k.total_transactions == sum(r.total_transactions for r in trends.collect())


def test_pattern_audit_and_halves(layers):
    raw = layers[0]
    audit = {r.week_number: r for r in pattern_audit(raw).collect()}
    assert audit[1].hot_issuer_total == 100 and audit[1].hot_issuer_rate == 0.82
    assert audit[6].hot_issuer_rate == 0.38
    halves = {r.period_half: r.approval_rate for r in half_period_rate(raw).collect()}
    assert halves["weeks_1_3"] > halves["weeks_4_6"]


def test_headline_and_country(layers):
    _, _, seg, trends, _ = layers
    h = V.headline_trend(trends).collect()
    assert [r.is_inflection for r in h] == [False, False, False, True, False, False]
    cb = V.country_breakdown(seg).collect()
    assert cb[0].country == "MX" and cb[0].is_worst and cb[0].drop_pp > 0
    assert sum(r.is_worst for r in cb) == 1


def test_issuer_heatmap(layers):
    seg = layers[2]
    hm = V.issuer_heatmap(seg).collect()
    assert hm[0].issuer_bank == "BBVA" and hm[0].week_6 == 0.38
    assert all(r.week_1 is not None for r in hm)


def test_waterfall_sums_exactly(layers):
    enriched = layers[1]
    wf = V.waterfall(enriched).collect()
    base, cur = wf[0].contribution_pp, wf[-1].contribution_pp
    assert wf[0].factor == "Baseline" and wf[-1].factor == "Current"
    assert sum(r.contribution_pp for r in wf[1:-1]) == pytest.approx(cur - base, abs=1e-9)
    hot = [r for r in wf if r.factor == "hot_issuer"][0]
    assert hot.contribution_pp < 0


def test_amount_box_and_hourly(layers):
    enriched = layers[1]
    box = V.amount_box(enriched).collect()
    assert len(box) == 4 and all(r.min <= r.q1 <= r.median <= r.q3 <= r.max for r in box)
    pdf = enriched.select("period_half", "status", "amount_usd").toPandas()
    for few in (box, V.amount_box(enriched, buckets=3).collect()):
        for r in few:
            own = pdf[(pdf.period_half == r.period_half) & (pdf.status == r.status)].amount_usd
            assert [r.q1, r.median, r.q3] == pytest.approx(own.quantile([0.25, 0.5, 0.75]).tolist())
            assert (r.n, r["min"], r["max"]) == (len(own), own.min(), own.max()) and r["mean"] == pytest.approx(own.mean())
    text = V.amount_box(enriched)._jdf.queryExecution().toString()
    assert "percentile(" not in text
    hp = V.hourly_pattern(enriched)
    assert hp.agg(F.sum("total_transactions")).collect()[0][0] == enriched.count()


def test_kpi_and_cards(layers):
    _, _, _, trends, ins = layers
    k = V.kpi_row(trends, ins).collect()[0]
    assert k.decline_pp < 0 and k.decline_text.endswith("pp") and k.impact_text.startswith("~$")
    cards = V.insight_cards(ins).collect()
    assert 1 <= len(cards) <= 5 and cards[0].badge == cards[0].severity.upper()
    assert "->" in cards[0].metric_text and cards[0].impact_text.startswith("Est. impact: $")


def test_extensions(layers):
    raw = layers[0]
    rs = risk_score(raw).collect()
    assert all(0.0 <= r.risk_score <= 1.0 for r in rs)
    assert len(rs) == raw.where(F.col("week_number") > 3).count()
    tb = time_bucket_rates(raw, "day")
    assert tb.agg(F.sum("total_transactions")).collect()[0][0] == raw.count()
    fx = fx_normalise(raw).collect()
    assert all(r.amount_usd_fx == pytest.approx(r.amount * r.fx_rate) for r in fx if r.fx_rate)
