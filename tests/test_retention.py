import random

import pytest
from pyspark.sql import functions as F

from ratelens.operators import retention as R

from .fixtures import row, to_df


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_numbers_are_dense(spark, buckets):
    ids = [f"c{i}" for i in range(1000)] * 2 + [None]
    got = R.number_customers(spark.createDataFrame([(x,) for x in ids], "customer_id string"), buckets).collect()
    assert sorted(r.number for r in got) == list(range(1, 1001)) and len({r.customer_id for r in got}) == 1000


def test_numbering_has_no_one_task_window_over_customers(spark):
    df = spark.range(100).selectExpr("cast(id as string) as customer_id")
    plan = R.number_customers(df)._jdf.queryExecution().optimizedPlan().toString()
    # the one unpartitioned window runs over the buckets' sizes
    assert plan.count("Window [") == 2 and plan.count("_bucket") > 0
    assert "Aggregate [_bucket" in plan


def brute(rows, keep):
    return len({r["customer_id"] for r in rows if keep(r["week_number"]) and r["customer_id"]})


def some_rows(n=2500, customers=700, seed=3):
    r = random.Random(seed)
    return [row(i, r.randrange(1, 7), customer=f"u{min(r.randrange(customers), r.randrange(customers))}") for i in range(n)]


def test_distinct_customers_of_any_range(spark):
    rows = some_rows()
    layer = R.cohort_bitmaps(to_df(spark, rows)).cache()
    for a in range(1, 7):
        for b in range(a, 7):
            assert R.distinct_customers(layer, a, b).first()[0] == brute(rows, lambda w, a=a, b=b: a <= w <= b)
    by = {r.cohort_week: r.n_customers for r in R.distinct_customers(layer, 1, 6, ("cohort_week",)).collect()}
    first = {}
    for r in sorted(rows, key=lambda r: r["timestamp"]):
        first.setdefault(r["customer_id"], r["week_number"])
    assert by == {w: sum(x == w for x in first.values()) for w in set(first.values())}
    assert R.distinct_customers(layer, 9, 12).first()[0] == 0


def test_retention_equals_sets(spark):
    rows = some_rows(seed=8)
    early = F.coalesce(F.col("week_number") <= 3, F.lit(False))
    got = {r.cohort_week: r for r in R.cohort_retention(R.cohort_bitmaps(to_df(spark, rows), buckets=5), early, ~early).collect()}
    first, weeks = {}, {}
    for r in sorted(rows, key=lambda r: r["timestamp"]):
        first.setdefault(r["customer_id"], r["week_number"])
        weeks.setdefault(r["customer_id"], set()).add(r["week_number"])
    for cohort, r in got.items():
        mine = [weeks[c] for c, w in first.items() if w == cohort]
        e, l = [min(w) <= 3 for w in mine], [max(w) > 3 for w in mine]
        both = sum(x and y for x, y in zip(e, l, strict=True))
        assert (r.n_customers, r.n_early, r.n_late, r.n_retained) == (len(mine), sum(e), sum(l), both)
        assert r.retention_rate == (pytest.approx(both / sum(e), abs=6e-5) if sum(e) else 0.0)
    assert len(got) == len(set(first.values()))


def test_more_customers_than_one_bitmap(spark):
    n = 70_000  # three parts of 32,768
    df = spark.range(n).selectExpr("cast(id as string) customer_id", "cast(1 + id % 2 as int) cohort_week", "cast(1 + id % 2 as int) week_number")
    layer = R.cohort_bitmaps(per_customer=df.union(df.selectExpr("customer_id", "cohort_week", "week_number + 2")))
    assert layer.select("part").distinct().count() == 3
    assert R.distinct_customers(layer, 1, 4).first()[0] == n and R.distinct_customers(layer, 2, 3).first()[0] == n
