"""Bindings of the driver's tables to the raw-transaction contract (FIXTURES.md §3).

The test tables carry no approval field, so each binding derives one with a
fixed rule. ``plans/oracle.py`` repeats the same rules in SQL.

Scale notes
-----------
* No join carries a broadcast hint: nation and region (fixed-size by the TPC-H
  spec) are under the threshold anyway; customer / orders / part grow with the
  scale factor. Spark's size-checked ``autoBroadcastJoinThreshold`` and AQE's runtime
  conversion decide, and fall back to a sort-merge join beyond the threshold;
  AQE's skew-join split handles a hot user / order key on the fact side.
* Every read selects only the columns it needs, so the parquet scans are pruned.
  No row is left out: a line item of any year is in a week (year - 1994), and P3
  puts every week beyond the split into the current half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import week_index

# FIXED VALUES of the bindings (ours; the oracle SQL repeats them)
EVENTS_START = "2024-01-01"
EVENTS_PERIOD_DAYS = 5
LINEITEM_FIRST_YEAR = 1995
LINEITEM_PRICE_DIVISOR = 210
# FX rate per r_regionkey 0..4 (local currency -> USD)
REGION_FX = [0.20, 0.058, 0.00025, 1.0, 0.5]


# Declared schemas of the driver's tables (the columns the bindings read).
# Reading with a declared schema skips footer inference (one job per table)
# and reads exactly these columns.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region with the FX rate per region (fixed-size by the TPC-H spec)."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    fx = F.lit(None).cast("double")
    for key in reversed(range(len(REGION_FX))):
        fx = F.when(F.col("r_regionkey") == key, F.lit(REGION_FX[key])).otherwise(fx)
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
           .select("n_nationkey", "n_name", "r_regionkey", "r_name", fx.alias("fx_rate")))


def _currency_cols(amount_usd) -> list:
    return [
        F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("currency"),
        F.try_divide(amount_usd, F.col("fx_rate")).alias("amount"),
    ]


def events_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding E: one transaction per event; declined when event_type = 'error'."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = geography(spark, sf_dir)
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    declined = F.coalesce(F.col("event_type") == F.lit("error"), F.lit(False))
    joined = (ev.join(cust, ev.user_id == cust.c_custkey, "left")
              .join(geo, F.col("c_nationkey") == geo.n_nationkey, "left")
              .withColumn("_k", k))
    kk = F.col("_k")
    out = joined.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        week_index("ts", EVENTS_START, EVENTS_PERIOD_DAYS).alias("week_number"),
        F.col("r_name").alias("country"),
        *_currency_cols(F.col("value")),
        F.col("value").cast("double").alias("amount_usd"),
        F.col("c_mktsegment").alias("card_brand"),
        F.when(kk % 20 < 12, F.lit("Credit")).when(kk % 20 < 19, F.lit("Debit"))
         .otherwise(F.lit("Prepaid")).alias("card_type"),
        F.col("n_name").alias("issuer_bank"),
        F.when(declined, F.lit(C.STATUS_DECLINED)).otherwise(F.lit(C.STATUS_APPROVED)).alias("status"),
        F.when(declined, F.concat(F.lit("reason_"), (kk % 8).cast("string"))).alias("decline_reason"),
        kk.cast("string").alias("merchant_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        (kk % 7 == 0).alias("is_recurring"),
        F.hour("ts").cast("int").alias("hour_of_day"),
    )
    return C.conform(out, C.RAW_TRANSACTION)


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding L: one transaction per line item; declined when returned."""
    li = (read_table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    geo = geography(spark, sf_dir)
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
              .join(cust, F.col("o_custkey") == cust.c_custkey, "left")
              .join(part, F.col("l_partkey") == part.p_partkey, "left")
              .join(geo, F.col("c_nationkey") == geo.n_nationkey, "left"))
    declined = F.coalesce(F.col("l_returnflag") == F.lit("R"), F.lit(False))
    # round(l_extendedprice / 210, 2) half-up, done on integer cents so it is exact
    cents = F.round(F.col("l_extendedprice") * F.lit(100.0), 0).cast("long")
    usd_cents = ((cents + F.lit(LINEITEM_PRICE_DIVISOR // 2))
                 - (cents + F.lit(LINEITEM_PRICE_DIVISOR // 2)) % F.lit(LINEITEM_PRICE_DIVISOR)) \
        / F.lit(LINEITEM_PRICE_DIVISOR)
    amount_usd = (usd_cents.cast("long") / F.lit(100.0))
    # composite key: (l_orderkey, l_linenumber) alone repeats in the test data
    tx_id = F.concat_ws("|", *[F.col(c).cast("string") for c in
                               ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                        F.col("l_quantity").cast("long").cast("string"))
    out = joined.select(
        tx_id.alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        (F.year("l_shipdate") - F.lit(LINEITEM_FIRST_YEAR - 1)).cast("int").alias("week_number"),
        F.col("r_name").alias("country"),
        *_currency_cols(amount_usd),
        amount_usd.alias("amount_usd"),
        F.col("p_type").alias("card_brand"),
        F.when(F.col("l_discount") < 0.06, F.lit("Credit")).when(F.col("l_discount") < 0.095, F.lit("Debit"))
         .otherwise(F.lit("Prepaid")).alias("card_type"),
        F.col("n_name").alias("issuer_bank"),
        F.when(declined, F.lit(C.STATUS_DECLINED)).otherwise(F.lit(C.STATUS_APPROVED)).alias("status"),
        F.when(declined, F.col("o_orderpriority")).alias("decline_reason"),
        F.col("l_suppkey").cast("string").alias("merchant_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("l_partkey") % 7 == 0).alias("is_recurring"),
        (F.col("l_quantity").cast("long") % 24).cast("int").alias("hour_of_day"),
    )
    return C.conform(out, C.RAW_TRANSACTION)


BINDINGS = {"E": events_transactions, "L": lineitem_transactions}


def transactions(spark: SparkSession, sf_dir: str, binding: str = "E") -> DataFrame:
    return BINDINGS[binding](spark, sf_dir)
