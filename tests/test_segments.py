import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratelens import contracts as C
from ratelens.operators.enrich import enrich
from ratelens.operators.segments import segment_by, segment_cube
from ratelens.sources.bindings import transactions

from .conftest import SF_SMALL
from .fixtures import row, to_df, same_schema


def edge_rows():
    rows = []
    i = 0
    for week in (1, 2, 3, 4, 5, 6, None):
        for j in range(6):
            status = ["approved", "declined", "approved", None, "approved", "declined"][j]
            rows.append(row(i, week, country=["BR", "MX", None][j % 3], issuer=["Itau", "BBVA"][j % 2],
                            brand=["Visa", "Amex"][j % 2], ctype=["Credit", "Debit", "Prepaid"][j % 3],
                            amount=[5.0, 10.0, 199.99, 350.0, None, 42.5][j], status=status,
                            reason=["fraud_suspected", "lost_card"][j % 2] if status == "declined" else None,
                            hour=[None, 6, 12, 17, 20, 23][j]))
            i += 1
    return rows


def brute_force(pdf: pd.DataFrame) -> pd.DataFrame:
    """The reference's algorithm: one filtered group-by per definition and period."""
    out = []
    defs = [(t, d, False) for t, d in C.SEGMENT_DEFINITIONS.items()] + \
           [(t, d, True) for t, d in C.DECLINED_ONLY_SEGMENT_DEFINITIONS.items()]
    for t, dims, declined in defs:
        src = pdf[pdf.decline_reason.notna()] if declined else pdf
        periods = [(f"week_{int(w)}", src[src.week_number == w]) for w in sorted(src.week_number.dropna().unique())]
        periods += [(h, src[src.period_half == h]) for h in sorted(src.period_half.unique())]
        periods += [("all", src)]
        for label, part in periods:
            for key, g in part.groupby(dims, dropna=False):
                key = key if isinstance(key, tuple) else (key,)
                vals = [None if (v is None or (isinstance(v, float) and math.isnan(v))) else
                        str(int(v)) if d == "week_number" else str(v) for v, d in zip(key, dims)]
                skey = None if any(v is None for v in vals) else "|".join(vals)
                n = len(g)
                ok = int((g.status == "approved").sum())
                amt = g.amount_usd.dropna()
                out.append((t, skey, label, n, ok, n - ok, ok / n, round(float(amt.sum()), 6),
                            round(float(g[g.status == "approved"].amount_usd.dropna().sum()), 6),
                            *(vals + [None] * (4 - len(vals)))))
    cols = ["segment_type", "segment_key", "period", "total_transactions", "approved_transactions",
            "declined_transactions", "approval_rate", "total_amount_usd", "approved_amount_usd",
            "dimension_1", "dimension_2", "dimension_3", "dimension_4"]
    return pd.DataFrame(out, columns=cols)


def _norm(df: pd.DataFrame) -> list:
    df = df.copy()
    for c in ("total_amount_usd", "approved_amount_usd"):
        df[c] = df[c].round(6)
    df = df.astype(object).where(df.notna(), None)
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df[cols].itertuples(index=False)), key=repr)


def test_cube_matches_brute_force_on_edges(spark):
    raw = to_df(spark, edge_rows())
    enriched = enrich(raw)
    got = segment_cube(enriched).toPandas()
    exp = brute_force(enriched.toPandas())
    assert len(got) == len(exp)
    assert _norm(got) == _norm(exp)


def test_cube_contract_and_properties(spark):
    seg = segment_cube(transactions(spark, SF_SMALL, "E"))
    assert same_schema(seg.schema, C.SEGMENT)
    pdf = seg.toPandas()
    assert (pdf.approved_transactions + pdf.declined_transactions == pdf.total_transactions).all()
    assert set(pdf.segment_type) == set(C.SEGMENT_DEFINITIONS) | set(C.DECLINED_ONLY_SEGMENT_DEFINITIONS)
    # weekly periods roll up to the halves and to 'all' (no null weeks in this binding)
    for t in ("country", "issuer_brand_type", "decline_reason"):
        sub = pdf[pdf.segment_type == t]
        weeks = sub[sub.period.str.startswith("week_")]
        first = weeks[weeks.period.isin(["week_1", "week_2", "week_3"])].total_transactions.sum()
        assert first == sub[sub.period == "weeks_1_3"].total_transactions.sum()
        assert weeks.total_transactions.sum() == sub[sub.period == "all"].total_transactions.sum()
    # every non-declined type covers all rows in 'all'
    n = transactions(spark, SF_SMALL, "E").count()
    for t in C.SEGMENT_DEFINITIONS:
        assert pdf[(pdf.segment_type == t) & (pdf.period == "all")].total_transactions.sum() == n
    # SURVEY §7.5 anchor: binding E, sf0.001
    assert len(pdf) == 1292


def test_declined_only_types_see_only_declined_rows(spark):
    seg = segment_cube(to_df(spark, edge_rows()))
    dec = seg.where(F.col("segment_type").isin("decline_reason", "country_decline_reason")).toPandas()
    assert (dec.approved_transactions == 0).all() and (dec.approval_rate == 0.0).all()


def test_null_week_counts_in_second_half_and_all_only(spark):
    rows = [row(1, week=None, status="approved"), row(2, week=1, status="approved")]
    seg = segment_cube(to_df(spark, rows)).where(F.col("segment_type") == "country").toPandas()
    by_period = dict(zip(seg.period, seg.total_transactions))
    assert by_period == {"week_1": 1, "weeks_1_3": 1, "weeks_4_6": 1, "all": 2}


def test_segment_by_drill_with_filter(spark):
    raw = to_df(spark, edge_rows())
    drill = segment_by(enrich(raw), ["card_brand", "card_type", "amount_bucket", "hour_bucket"],
                       where=F.col("country") == "BR", name="drill")
    pdf = drill.toPandas()
    assert set(pdf.segment_type) == {"drill"}
    assert pdf[pdf.period == "all"].total_transactions.sum() == raw.where(F.col("country") == "BR").count()
    assert pdf.dimension_4.notna().all()


def test_cube_plan_shape(spark, capsys):
    """Grouping sets over a partially aggregated base; pruned scans."""
    segment_cube(transactions(spark, SF_SMALL, "E")).explain()
    plan = capsys.readouterr().out
    assert "Expand" in plan and "HashAggregate" in plan and "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<event_id" not in plan  # the cube never reads event_id


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_cube_matches_brute_force_random(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(150):
        status = rnd.choice(["approved", "approved", "declined", None])
        rows.append(row(i, rnd.choice([1, 2, 3, 4, 5, 6, None]), country=rnd.choice(["BR", "MX", None]),
                        issuer=rnd.choice(["Itau", "BBVA", "Nubank"]), brand=rnd.choice(["Visa", "Amex"]),
                        ctype=rnd.choice(["Credit", "Debit"]), amount=rnd.choice([None, 9.99, 55.5, 420.0, 12.34]),
                        status=status, reason=rnd.choice(["lost_card", "fraud_suspected"]) if status == "declined"
                        else None, hour=rnd.choice([None, 3, 8, 13, 18, 22])))
    enriched = enrich(to_df(spark, rows))
    got = segment_cube(enriched).toPandas()
    exp = brute_force(enriched.toPandas())
    assert _norm(got) == _norm(exp)
