import datetime as dt
import random

import pytest

from ratelens.operators import asof

from .fixtures import START, row, to_df


def some_rows(n=400, seed=1, days=12):
    r = random.Random(seed)
    out = []
    for i in range(n):
        issuer = r.choice(["A", "B", "C", None])
        ok = r.random() < {"A": 0.9, "B": 0.5}.get(issuer, 0.75)
        out.append(row(i, 1, r.choice(["BR", "MX", "MX"]), issuer, status="approved" if ok else "declined",
                       ts=START + dt.timedelta(days=r.randrange(days), seconds=i)))
    return out + [row(n, None, "BR", "A", null_ts=True)]


def brute(rows, i):
    """hist_n, hist_approved and the backed-off expectation of row i."""
    me = rows[i]
    if me["timestamp"] is None:
        return 0, 0, 0.5
    past = [r for r in rows if r["timestamp"] is not None and r["timestamp"].date() < me["timestamp"].date()]
    dated = [r for r in rows if r["timestamp"] is not None]
    p = (sum(r["status"] == "approved" for r in past) + 1) / (len(past) + 2)
    n = k = 0
    for dims in (("country",), ("country", "issuer_bank")):
        counts = {tuple(r[d] for d in dims): [0, 0] for r in dated}
        for r in past:
            g = counts[tuple(r[d] for d in dims)]
            g[0] += 1
            g[1] += r["status"] == "approved"
        used = [(a, b) for a, b in counts.values() if a]
        total, ok = sum(a for a, _ in used), sum(b for _, b in used)
        w = asof.STRONGEST
        if total:
            v = ok / total * (1 - ok / total)
            ex = None if v == 0 else (sum(b * b / a for a, b in used) - ok * ok / total) / v - (len(used) - 1)
            den = total - sum(a * a for a, _ in used) / total - (len(used) - 1)
            rho = None if ex is None or den == 0 else ex / den
            if rho is not None and rho > 0:
                w = min(max((1 - rho) / rho, asof.WEAKEST), asof.STRONGEST)
        n, k = counts[tuple(me[d] for d in dims)]
        p = (k + w * p) / (n + w)
    return n, k, p


def test_history_equals_brute_force(spark):
    rows = some_rows()
    got = {r.transaction_id: r for r in asof.risk_score_asof(to_df(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, x in enumerate(rows):
        n, k, p = brute(rows, i)
        r = got[x["transaction_id"]]
        assert (r.hist_n, r.hist_approved) == (n, k) and r.expected_approval == pytest.approx(p, abs=1e-9)
        assert r.risk_score == pytest.approx(1 - p, abs=1e-9)


def test_later_rows_change_nothing(spark):
    rows = some_rows(seed=4)
    cut = START.date() + dt.timedelta(days=7)
    early = [r for r in rows if r["timestamp"] is not None and r["timestamp"].date() < cut]
    # the later days all declined, with groups of their own
    later = [row(5000 + i, 2, "ZZ", "new", status="declined", ts=START + dt.timedelta(days=7 + i % 3)) for i in range(200)]
    one = {r.transaction_id: tuple(r) for r in asof.risk_score_asof(to_df(spark, early)).collect()}
    two = {r.transaction_id: tuple(r) for r in asof.risk_score_asof(to_df(spark, early + later)).collect()}
    assert all(two[t][:5] == one[t][:5] and two[t][5] == pytest.approx(one[t][5], abs=1e-12) for t in one)


def test_alike_groups_are_shrunk_harder_than_different_ones(spark):
    def weight(rates):
        rows = [(100, round(100 * x)) for x in rates]
        df = spark.createDataFrame(rows, "n long, k long").selectExpr(
            "count(*) g", "sum(n) n", "sum(k) k", "sum(1.0D * n * n) s2", "sum(1.0D * k * k / n) sp")
        return df.select(asof.prior_weight(*(df[c] for c in ("g", "n", "k", "s2", "sp")))).first()[0]
    assert weight([0.8, 0.8, 0.8]) == asof.STRONGEST
    assert asof.WEAKEST <= weight([0.1, 0.9, 0.5]) < weight([0.6, 0.8, 0.7]) < asof.STRONGEST


def test_dense_hours(spark):
    rows = [row(0, 1, "MX", ts=START), row(1, 1, "MX", status="declined", ts=START + dt.timedelta(hours=3)),
            row(2, 1, None, ts=START + dt.timedelta(hours=1)), row(3, None, "BR", null_ts=True)]
    got = asof.dense_hourly_rates(to_df(spark, rows), ["country"]).orderBy("country", "bucket").collect()
    assert [(r.country, r.bucket[11:13], r.total_transactions, r.approved_transactions, r.approval_rate) for r in got] == [
        (None, "00", 0, 0, None), (None, "01", 1, 1, 1.0), (None, "02", 0, 0, None), (None, "03", 0, 0, None),
        ("MX", "00", 1, 1, 1.0), ("MX", "01", 0, 0, None), ("MX", "02", 0, 0, None), ("MX", "03", 1, 0, 0.0)]
    assert asof.dense_hourly_rates(to_df(spark, rows[3:]), ["country"]).count() == 0
