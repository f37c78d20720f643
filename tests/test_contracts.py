import pytest
from pyspark.sql import functions as F

from ratelens import contracts as C

from .fixtures import row, to_df, same_schema


def test_validate_tolerates_extra_columns_and_timezones(spark):
    df = to_df(spark, [row(1)]).withColumn("extra", F.lit(1))
    C.validate(df)
    C.validate(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))


def test_validate_missing_and_wrong_type(spark):
    df = to_df(spark, [row(1)])
    with pytest.raises(ValueError, match="hour_of_day"):
        C.validate(df.drop("hour_of_day"))
    with pytest.raises(TypeError, match="week_number"):
        C.validate(df.withColumn("week_number", F.col("week_number").cast("long")))
    with pytest.raises(ValueError, match="Column set differs"):
        C.validate(df.withColumn("extra", F.lit(1)), strict=True)


def test_conform_orders_and_casts(spark):
    df = to_df(spark, [row(1)])
    shuffled = df.select(*reversed(df.columns)).withColumn("week_number", F.col("week_number").cast("long"))
    out = C.conform(shuffled, C.RAW_TRANSACTION)
    assert same_schema(out.schema, C.RAW_TRANSACTION)
