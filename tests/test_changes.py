import math
import random

import pytest

from ratelens.operators import changes
from ratelens.operators.segments import segment_cube
from ratelens.operators.trends import weekly_trends

from .fixtures import planted, row, to_df


def brute(weeks):
    """(change week, statistic) of [(week, approved, total)] by trying every split."""
    def ll(k, n):
        return sum(x * math.log(x / n) for x in (k, n - k) if x > 0)
    k, n = sum(w[1] for w in weeks), sum(w[2] for w in weeks)
    best = None
    for i in range(1, len(weeks)):
        k1, n1 = sum(w[1] for w in weeks[:i]), sum(w[2] for w in weeks[:i])
        lr = round(max(0.0, 2 * (ll(k1, n1) + ll(k - k1, n - n1) - ll(k, n))), 9)
        if best is None or lr > best[1]:
            best = (weeks[i][0], lr)
    return best


def test_change_points_equal_brute_force(spark):
    r, rows, want = random.Random(2), [], {}
    for s in range(60):
        weeks = sorted(r.sample(range(1, 30), r.randrange(1, 9)))
        mine = []
        for w in weeks:
            n = r.choice([0, 1, 3, 50, 4000])
            mine.append((w, r.choice([0, n, r.randrange(n + 1)]), n))
        rows += [(f"s{s}", *x) for x in mine]
        kept = [x for x in mine if x[2]]
        if len(kept) > 1:
            want[f"s{s}"] = brute(kept)
    rows += [("s0", None, 5, 9)]
    df = spark.createDataFrame(rows, "s string, week_number int, approved_transactions long, total_transactions long")
    got = {x.s: x for x in changes.change_points(df, ["s"]).collect()}
    assert got.keys() == want.keys()
    for s, (week, lr) in want.items():
        assert got[s].lr_statistic == pytest.approx(lr, abs=2e-9)
        if lr > 1e-6:
            assert got[s].change_week == week
        assert 0.0 <= got[s].p_value <= 1.0


def test_planted_week_is_found(spark):
    seg = segment_cube(to_df(spark, planted()))
    got = {r.segment_key: r for r in changes.segment_change_points(seg).where("segment_type = 'issuer'").collect()}
    bbva = got["MX|BBVA"]
    assert bbva.change_week == 4 and bbva.rate_before == pytest.approx(0.82) and bbva.rate_after == pytest.approx(0.38)
    assert bbva.p_value < 1e-20 and all(got[k].p_value > 0.05 for k in got if k != "MX|BBVA")


@pytest.mark.parametrize("week", [2, 3, 5, 6])
def test_headline_marks_the_week_that_shows(spark, week):
    rows = [row(i, w, status="approved" if j < (90 if w < week else 60) else "declined")
            for w in range(1, 7) for j in range(100) for i in [w * 100 + j]]
    trend = weekly_trends(to_df(spark, rows))
    assert changes.inflection_week(trend) == week
    assert [r.week_number for r in changes.headline_trend_found(trend).where("is_inflection").collect()] == [week]


def test_short_series_have_no_change(spark):
    trend = weekly_trends(to_df(spark, [row(1, 1), row(2, 1)]))
    assert changes.inflection_week(trend) is None
    assert changes.headline_trend_found(trend).where("is_inflection").count() == 0
    flat = weekly_trends(to_df(spark, [row(i, 1 + i % 4) for i in range(40)]))
    assert changes.change_points(flat.selectExpr("*", "1 as g"), ["g"]).first().p_value == 1.0
