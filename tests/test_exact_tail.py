import math

import pytest
from pyspark.sql import functions as F

from ratelens.functions import stats
from ratelens.operators.anomalies import detect_anomalies
from ratelens.operators.segments import segment_cube

from .fixtures import planted, to_df


def test_erfc_to_the_far_tail(spark):
    zs = [i / 64 for i in range(0, 30 * 64 + 1)] + [0.46875, 4.0, 4.0 + 1e-12, 1e-300, 37.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = df.select("z", stats.erfc("z").alias("e"), stats.two_sided_p("z", "exact").alias("p")).collect()
    for r in got:
        for value, x in ((r.e, r.z), (r.p, r.z / math.sqrt(2))):
            want = math.erfc(x)
            # below the normal doubles the exponent's rounding is all that is left
            assert value == pytest.approx(want, rel=1e-12 if want > 1e-290 else 1e-2, abs=5e-324), (r.z, value, want)


def test_erfc_of_odd_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (0.0,)], "z double")
    got = [r[0] for r in df.select(stats.erfc("z")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2] == 0.0 and got[3] == 1.0


def test_methods_agree_and_differ_where_they_should(spark):
    rows = [(80, 100, 70, 100), (0, 0, 1, 2), (5, 5, 7, 7), (0, 9, 0, 4), (900_000, 1_000_000, 100_000, 1_000_000), (50, 100, 50, 100)]
    df = spark.createDataFrame(rows, "a long, n long, b long, m long")
    p = {m: [r.p for r in stats.with_p_value(df, "a", "n", "b", "m", "p", m).collect()] for m in stats.P_METHODS}
    old = [r[0] for r in df.select(stats.two_proportion_p_value("a", "n", "b", "m")).collect()]
    assert p["polynomial"] == pytest.approx(old, abs=1e-15)
    assert p["exact"] == pytest.approx(old, abs=2e-7)
    assert p["exact"][1:4] == [1.0, 1.0, 1.0] and p["exact"][5] == 1.0
    assert p["exact"][0] == pytest.approx(math.erfc(0.1 / math.sqrt(0.75 * 0.25 * 0.02) / math.sqrt(2)), rel=1e-12)
    with pytest.raises(ValueError, match="method"):
        stats.two_sided_p("z", "scipy")


def test_anomalies_by_either_tail(spark):
    seg = segment_cube(to_df(spark, planted()))
    exact = {r.segment_key: r for r in detect_anomalies(seg, p_method="exact").where("segment_type = 'issuer'").collect()}
    usual = {r.segment_key: r for r in detect_anomalies(seg).where("segment_type = 'issuer'").collect()}
    assert exact.keys() == usual.keys() and exact["MX|BBVA"].is_anomaly
    for key, r in exact.items():
        assert r.p_value == pytest.approx(usual[key].p_value, abs=2e-7) and r.z_score == usual[key].z_score


def test_the_exact_tail_stays_in_codegen(spark):
    df = spark.range(5).select((F.col("id") * 2.0).alias("z"))
    plan = df.select(stats.two_sided_p("z", "exact"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(1) Project" in plan
