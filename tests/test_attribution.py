import random

import pytest

from ratelens import contracts as C
from ratelens.operators.attribution import disjoint_impact
from ratelens.operators.enrich import enrich

from .fixtures import row, to_df

PER_USD = C.WEEKS_PER_MONTH / C.WEEKS_PER_PERIOD


def some_rows(seed, n=400):
    r = random.Random(seed)
    return [row(i, r.randrange(1, 7), r.choice(["BR", "MX"]), r.choice(["A", "B"]), r.choice(["Visa", "Amex"]), amount=float(r.randrange(1, 400)),
                status=r.choice(["approved", "declined"])) for i in range(n)]


INSIGHTS = [("country", "MX", -0.2), ("issuer", "MX|A", -0.3), ("card_brand", "Visa", 0.1), ("decline_reason", "do_not_honor", -0.5),
            ("country", "nowhere", -0.9)]


def holds(kind, key, r):
    dims = (C.SEGMENT_DEFINITIONS | C.DECLINED_ONLY_SEGMENT_DEFINITIONS)[kind]
    return "|".join(str(r[d]) for d in dims) == key and (kind not in C.DECLINED_ONLY_SEGMENT_DEFINITIONS or r["decline_reason"] is not None)


def brute(rows, insights):
    left, pool, out = sorted(insights), [r for r in rows if r["week_number"] > 3], []
    while left:
        gains = [(-sum(r["amount_usd"] for r in pool if holds(k, key, r)) * abs(ch), i) for i, (k, key, ch) in enumerate(left)]
        gain, i = min(gains)
        kind, key, ch = left.pop(i)
        out.append((kind, key, sum(holds(kind, key, r) for r in pool), -gain * PER_USD))
        pool = [r for r in pool if not holds(kind, key, r)]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cover_equals_brute_force(spark, seed):
    rows = some_rows(seed)
    ins = spark.createDataFrame(INSIGHTS, "segment_type string, segment_key string, rate_change double")
    got = disjoint_impact(enrich(to_df(spark, rows)), ins).orderBy("step").collect()
    want = brute(rows, INSIGHTS)
    assert [(r.segment_type, r.segment_key, r.charged_transactions) for r in got] == [w[:3] for w in want]
    assert [r.charged_impact_usd for r in got] == pytest.approx([w[3] for w in want])
    late = [r for r in rows if r["week_number"] > 3]
    # each transaction is charged once, and never more than its insight's full impact
    assert sum(r.charged_transactions for r in got) == sum(any(holds(k, key, r) for k, key, _ in INSIGHTS) for r in late)
    assert all(r.charged_impact_usd <= r.full_impact_usd + 1e-9 for r in got)
    assert sum(r.charged_impact_usd for r in got) <= sum(r["amount_usd"] for r in late) * 0.9 * PER_USD
    assert sum(r.charged_impact_usd for r in got) < sum(r.full_impact_usd for r in got)


def test_no_insights_and_too_many(spark):
    raw = enrich(to_df(spark, some_rows(1, 10)))
    schema = "segment_type string, segment_key string, rate_change double"
    assert disjoint_impact(raw, spark.createDataFrame([], schema)).count() == 0
    many = spark.createDataFrame([("country", str(i), 0.1) for i in range(17)], schema)
    with pytest.raises(ValueError, match="at most 16"):
        disjoint_impact(raw, many)
