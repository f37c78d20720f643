import datetime as dt

import pandas as pd

from ratelens.operators.cohorts import (acquisition_cohorts, cohort_matrix, cohort_payload, customer_weeks,
                                        first_time_vs_returning, recurring_vs_onetime, tag_customer_type)
from ratelens.sources.bindings import transactions

from .conftest import SF_SMALL
from .fixtures import START, row, to_df


def ts(day, sec=0):
    return START + dt.timedelta(days=day, seconds=sec)


def cohort_rows():
    return [
        # c1: first txn week 1 (approved); ties on timestamp broken by transaction_id
        row(1, 1, customer="c1", ts=ts(0), status="approved"),
        row(2, 1, customer="c1", ts=ts(0), status="declined"),
        row(3, 4, customer="c1", ts=ts(22), status="approved", recurring=True),
        # c2: a null timestamp in week 2 -> cohort week 2 (nulls first), first-time row in week 3
        row(4, 2, customer="c2", null_ts=True, status="declined"),
        row(5, 3, customer="c2", ts=ts(15), status="approved"),
        # c3: only null timestamps -> no first-time row
        row(6, 5, customer="c3", null_ts=True, status="approved"),
        # null customers: one first-time row among them; cohort_week null
        row(7, 2, customer=None, ts=ts(8), status="declined"),
        row(8, 2, customer=None, ts=ts(9), status="approved"),
    ]


def _null_customer(rows):
    for r in rows:
        if r["transaction_id"] in ("t000007", "t000008"):
            r["customer_id"] = None
    return rows


def test_first_time_vs_returning(spark):
    df = to_df(spark, _null_customer(cohort_rows()))
    got = {r.week: r.asDict() for r in first_time_vs_returning(df).collect()}
    assert got[1] == {"week": 1, "first_time_rate": 1.0, "first_time_n": 1, "returning_rate": 0.0, "returning_n": 1}
    assert got[2]["first_time_n"] == 1 and got[2]["first_time_rate"] == 0.0   # t7 (null customer)
    assert got[2]["returning_n"] == 2 and got[2]["returning_rate"] == 0.5
    assert got[3]["first_time_n"] == 1 and got[3]["returning_n"] == 0 and got[3]["returning_rate"] == 0.0
    assert got[5] == {"week": 5, "first_time_rate": 0.0, "first_time_n": 0, "returning_rate": 1.0, "returning_n": 1}


def test_tag_customer_type_agrees(spark):
    df = to_df(spark, _null_customer(cohort_rows()))
    tags = {r.transaction_id: r.customer_type for r in tag_customer_type(df).collect()}
    assert {k for k, v in tags.items() if v == "first_time"} == {"t000001", "t000005", "t000007"}


def test_acquisition_cohorts(spark):
    df = to_df(spark, _null_customer(cohort_rows()))
    got = {(r.cohort_week, r.transaction_week): (r.approval_rate, r.n_customers, r.n_transactions)
           for r in acquisition_cohorts(df).collect()}
    assert got[(1, 1)] == (0.5, 1, 2) and got[(1, 4)] == (1.0, 1, 1)
    assert got[(2, 2)] == (0.0, 1, 1) and got[(2, 3)] == (1.0, 1, 1)
    assert got[(5, 5)] == (1.0, 1, 1)
    assert got[(None, 2)] == (0.5, 1, 2)      # null customer: one distinct value, no cohort


def test_recurring_and_matrix(spark):
    df = to_df(spark, _null_customer(cohort_rows()))
    rec = {r.week: r for r in recurring_vs_onetime(df).collect()}
    assert rec[4].recurring_n == 1 and rec[4].recurring_rate == 1.0 and rec[4].onetime_n == 0
    m = {r.cohort_week: r for r in cohort_matrix(acquisition_cohorts(df)).collect()}
    assert m[1].w1 == 0.5 and m[1].w4 == 1.0 and m[1].w2 is None


def test_against_pandas_on_binding(spark):
    raw = transactions(spark, SF_SMALL, "L")
    pdf = raw.select("transaction_id", "timestamp", "week_number", "customer_id", "status").toPandas()
    pdf = pdf.sort_values(["customer_id", "timestamp", "transaction_id"])
    pdf["first"] = ~pdf.duplicated("customer_id")
    ft = pdf[pdf["first"]].groupby("week_number").size()
    got = {r.week: r.first_time_n for r in first_time_vs_returning(raw).collect()}
    assert got == {int(k): int(v) for k, v in ft.items()} | {w: 0 for w in got if w not in ft.index}
    cw = customer_weeks(raw).toPandas()
    assert cw.groupby("customer_id").cohort_week.nunique().max() == 1
    payload = cohort_payload(raw).collect()[0]
    assert len(payload.first_time_vs_returning) == 7  # the years 1995 to 2001
    assert isinstance(pd.DataFrame(payload.acquisition_cohorts), pd.DataFrame)
