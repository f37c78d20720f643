import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.operators import boxes
from ratelens.operators.enrich import enrich

from .fixtures import row, to_df


def amounts(seed=1, n=4000):
    r = random.Random(seed)
    rows = [row(i, r.randrange(1, 7), status=r.choice(["approved", "declined"]), amount=round(r.expovariate(1 / 60), 2)) for i in range(n)]
    rows += [row(n + i, 2, amount=a) for i, a in enumerate([None, 9999.0, 9999.0])]
    return rows


def test_whiskers_equal_numpy(spark):
    rows = amounts()
    got = {(r.period_half, r.status): r for r in boxes.amount_box_whiskers(enrich(to_df(spark, rows))).collect()}
    assert len(got) == 4
    for (half, status), r in got.items():
        x = np.array([a["amount_usd"] for a in rows if a["amount_usd"] is not None and a["status"] == status
                      and (a["week_number"] <= 3) == (half == "weeks_1_3")])
        q1, q3 = np.quantile(x, 0.25), np.quantile(x, 0.75)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert (r.n, r.n_below, r.n_above) == (len(x), (x < low).sum(), (x > high).sum())
        assert (r.lower_whisker, r.upper_whisker) == (x[x >= low].min(), x[x <= high].max())
        assert r.q1 == pytest.approx(q1) and r.max == x.max()
    assert got["weeks_1_3", "approved"].n_above >= 2


def test_whiskers_of_a_group_without_amounts(spark):
    got = boxes.amount_box_whiskers(enrich(to_df(spark, [row(1, 1, amount=None), row(2, 5, amount=3.0)]))).collect()
    by = {r.period_half: r for r in got}
    assert by["weeks_1_3"].n == 0 and by["weeks_1_3"].lower_whisker is None and by["weeks_1_3"].n_above == 0
    assert by["weeks_4_6"].lower_whisker == by["weeks_4_6"].upper_whisker == 3.0


def test_sketch_boxes_of_any_weeks(spark):
    rows = amounts(seed=2, n=60_000)
    layer = boxes.amount_sketches(to_df(spark, rows)).cache()
    assert layer.count() == 12 and layer.agg(F.max(F.octet_length("sketch"))).first()[0] < 64_000
    for weeks in (F.col("week_number") <= 3, F.col("week_number").between(2, 5), F.lit(True)):
        keep = {r[0] for r in layer.where(weeks).select("week_number").distinct().collect()}
        for r in boxes.box_from_sketches(layer, weeks).collect():
            x = np.sort([a["amount_usd"] for a in rows if a["amount_usd"] is not None and a["status"] == r.status and a["week_number"] in keep])
            assert (r.n, r.min, r.max) == (len(x), x[0], x[-1])
            for name, q in boxes.QUANTILES:
                # the rank of the answer, as a share of all rows, within the sketch's error
                low, high = np.searchsorted(x, r[name], "left") / len(x), np.searchsorted(x, r[name], "right") / len(x)
                assert low - 0.01 <= q <= high + 0.01, (name, r[name])
