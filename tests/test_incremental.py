import random
import re

import pytest
from pyspark.sql import functions as F

from ratelens.operators import incremental as N
from ratelens.operators.segments import segment_cube
from ratelens.sources import io
from ratelens.sources.bindings import transactions

from .conftest import SF_SMALL
from .fixtures import row, to_df
from .test_segments import edge_rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_weeks_one_by_one_equal_the_whole_cube(spark, tmp_root):
    raw = transactions(spark, SF_SMALL, "E")
    base, seg = f"{tmp_root}/base", f"{tmp_root}/seg"
    weeks = [3, 1, 6, 2, 5, 4]
    for w in weeks:
        got = N.load_weeks(raw, [w], base, seg)
    assert rows_of(got) == rows_of(segment_cube(raw))


def test_null_week_and_null_dimensions(spark, tmp_root):
    raw = to_df(spark, edge_rows())
    base, seg = f"{tmp_root}/base", f"{tmp_root}/seg"
    N.load_weeks(raw, [1, 2, None], base, seg)
    got = N.load_weeks(raw, [3, 4, 5, 6], base, seg)
    assert rows_of(got) == rows_of(segment_cube(raw))


def test_loading_a_week_again_replaces_it(spark, tmp_root):
    r = random.Random(5)
    first = [row(i, 1 + i % 6, status=r.choice(["approved", "declined"])) for i in range(300)]
    base, seg = f"{tmp_root}/base", f"{tmp_root}/seg"
    N.load_weeks(to_df(spark, first), [1, 2, 3, 4, 5, 6], base, seg)
    again = [x for x in first if x["week_number"] != 5] + [row(900 + i, 5, country="CL", amount=7.0) for i in range(20)]
    got = N.load_weeks(to_df(spark, again), [5], base, seg)
    assert rows_of(got.where("segment_type <> 'time_weekly' or segment_key = '5'")) == rows_of(
        segment_cube(to_df(spark, again)).where("segment_type <> 'time_weekly' or segment_key = '5'"))
    assert got.where("period = 'week_5'").agg(F.max("total_transactions")).first()[0] == 20


def test_a_week_that_lost_its_rows(spark, tmp_root):
    rows = [row(i, 1 + i % 3) for i in range(60)]
    base, seg = f"{tmp_root}/base", f"{tmp_root}/seg"
    N.load_weeks(to_df(spark, rows), [1, 2, 3], base, seg)
    left = [x for x in rows if x["week_number"] != 2]
    got = N.load_weeks(to_df(spark, left), [2], base, seg)
    whole = "period in ('all', 'weeks_1_3')"
    assert rows_of(got.where(whole)) == rows_of(segment_cube(to_df(spark, left)).where(whole))


def test_only_the_loaded_weeks_rows_are_read(spark, tmp_root):
    raw_path = f"{tmp_root}/raw"
    io.write_layer(transactions(spark, SF_SMALL, "E"), raw_path, partition_by=["week_number"])
    raw = spark.read.parquet(raw_path)
    seen = raw.where(N._weeks_filter([6]))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*week_number#\d+ = 6", plan) or re.search(r"PartitionFilters: \[[^\]]*6", plan)
    files = {r[0] for r in seen.select(F.input_file_name()).distinct().collect()}
    assert files and all("week_number=6" in f for f in files)
    base, seg = f"{tmp_root}/base", f"{tmp_root}/seg"
    N.load_weeks(raw, [1, 2, 3, 4, 5], base, seg)
    # the other weeks' raw files are not needed any more
    for w in range(1, 6):
        spark.read.parquet(f"{raw_path}/week_number={w}").limit(0).write.mode("overwrite").parquet(f"{tmp_root}/gone-{w}")
    got = N.load_weeks(raw.where("week_number = 6"), [6], base, seg)
    assert rows_of(got) == rows_of(segment_cube(transactions(spark, SF_SMALL, "E")))


def test_touched_periods():
    assert N.touched_periods([2]) == ["week_2", "weeks_1_3", "all"]
    assert N.touched_periods([2, 5]) == ["week_2", "week_5", "weeks_1_3", "weeks_4_6", "all"]
    assert N.touched_periods([None]) == ["weeks_4_6", "all"]
    assert N.touched_periods([3], split_week=2, n_weeks=8) == ["week_3", "weeks_3_8", "all"]


def test_no_week_is_an_error(spark, tmp_root):
    with pytest.raises(ValueError, match="no week"):
        N.load_weeks(to_df(spark, [row(1)]), [], f"{tmp_root}/base", f"{tmp_root}/seg")
