"""Layer contracts (schemas) and the fixed values the analytics depend on.

Every layer of the job is a DataFrame that conforms to one of the StructTypes
below; ``conform`` casts and orders columns, ``validate`` checks an input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("week_number", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("amount_usd", T.DoubleType()),
    T.StructField("card_brand", T.StringType()),
    T.StructField("card_type", T.StringType()),
    T.StructField("issuer_bank", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("decline_reason", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("is_recurring", T.BooleanType()),
    T.StructField("hour_of_day", T.IntegerType()),
])

SEGMENT = T.StructType([
    T.StructField("segment_type", T.StringType()),
    T.StructField("segment_key", T.StringType()),
    T.StructField("dimension_1", T.StringType()),
    T.StructField("dimension_2", T.StringType()),
    T.StructField("dimension_3", T.StringType()),
    T.StructField("dimension_4", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("approved_transactions", T.LongType()),
    T.StructField("declined_transactions", T.LongType()),
    T.StructField("approval_rate", T.DoubleType()),
    T.StructField("total_amount_usd", T.DoubleType()),
    T.StructField("approved_amount_usd", T.DoubleType()),
])

WEEKLY_TREND = T.StructType([
    T.StructField("week_number", T.IntegerType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("approved_transactions", T.LongType()),
    T.StructField("approval_rate", T.DoubleType()),
    T.StructField("total_amount_usd", T.DoubleType()),
])

ANOMALY = T.StructType([
    T.StructField("segment_key", T.StringType()),
    T.StructField("segment_type", T.StringType()),
    T.StructField("baseline_rate", T.DoubleType()),
    T.StructField("current_rate", T.DoubleType()),
    T.StructField("rate_change", T.DoubleType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("affected_transactions", T.LongType()),
    T.StructField("estimated_revenue_impact_usd", T.DoubleType()),
])

INSIGHT = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("insight_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("segment_key", T.StringType()),
    T.StructField("baseline_rate", T.DoubleType()),
    T.StructField("current_rate", T.DoubleType()),
    T.StructField("rate_change", T.DoubleType()),
    T.StructField("affected_transactions", T.LongType()),
    T.StructField("estimated_revenue_impact_usd", T.DoubleType()),
    T.StructField("severity", T.StringType()),
])

# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the reference application's values for the
# results to match it. Stated plainly, in their natural order.
# ---------------------------------------------------------------------------

WEEKS_PER_PERIOD = 3
WEEKS_PER_MONTH = 4.33
SPLIT_WEEK = 3          # weeks 1..3 are the baseline half, 4..6 the current half
N_WEEKS = 6

STATUS_APPROVED = "approved"
STATUS_DECLINED = "declined"

# amount_usd upper bounds (exclusive); anything else falls to the last label
AMOUNT_BUCKETS = [
    ("sub_$10", 10.0),
    ("$10-50", 50.0),
    ("$50-100", 100.0),
    ("$100-200", 200.0),
    ("$200-350", 350.0),
    ("$350-500", None),
]

# hour_of_day [low, high); anything else falls to the last label
HOUR_BUCKETS = [
    ("morning_6_12", 6, 12),
    ("afternoon_12_17", 12, 17),
    ("evening_17_20", 17, 20),
    ("night_20_24", 20, 24),
    ("late_night_0_6", None, None),
]

# segment type -> ordered grouping columns
SEGMENT_DEFINITIONS = {
    "time_weekly": ["week_number"],
    "country": ["country"],
    "card_brand": ["card_brand"],
    "card_type": ["card_type"],
    "issuer": ["country", "issuer_bank"],
    "amount_bucket": ["amount_bucket"],
    "hour_bucket": ["hour_bucket"],
    "country_brand": ["country", "card_brand"],
    "country_brand_type": ["country", "card_brand", "card_type"],
    "issuer_brand_type": ["country", "issuer_bank", "card_brand", "card_type"],
}

# segment types computed over declined transactions only
DECLINED_ONLY_SEGMENT_DEFINITIONS = {
    "decline_reason": ["decline_reason"],
    "country_decline_reason": ["country", "decline_reason"],
}

# de-duplication priority of segment types sharing a segment_key (lower wins)
TYPE_PRIORITY = {
    "composite": 0,
    "issuer_brand_type": 1,
    "country_brand_type": 2,
    "country_issuer_brand": 3,
    "country_issuer": 4,
    "issuer_brand": 5,
    "country_brand": 6,
    "issuer": 7,
    "country_card_type": 8,
    "country": 9,
    "card_brand": 10,
    "card_type": 11,
    "amount_bucket": 12,
    "hour_bucket": 13,
}
TYPE_PRIORITY_DEFAULT = 99

# anomaly flag: (|z| > Z or p < P) and affected > N
ANOMALY_Z = 2.0
ANOMALY_P = 0.05
ANOMALY_MIN_AFFECTED = 50

# insight ranking
SPECIFICITY = {
    "issuer_brand_type": 1.0,
    "composite": 1.0,
    "country_issuer": 0.9,
    "issuer": 0.85,
    "country_brand_type": 0.7,
    "country_brand": 0.6,
    "amount_bucket": 0.8,
    "hour_bucket": 0.8,
    "country": 0.3,
    "card_brand": 0.2,
    "card_type": 0.2,
}
SPECIFICITY_DEFAULT = 0.5

CATEGORY = {
    "issuer": "issuer",
    "country_issuer": "issuer",
    "issuer_brand_type": "issuer",
    "composite": "issuer",
    "amount_bucket": "amount",
    "hour_bucket": "time",
    "country": "geo",
    "country_brand": "geo",
    "country_brand_type": "geo",
    "card_brand": "instrument",
    "card_type": "instrument",
}
CATEGORY_DEFAULT = "other"

SCORE_WEIGHTS = {"impact": 0.30, "magnitude": 0.30, "significance": 0.15, "specificity": 0.25}
TOP_N = 5
MIN_N = 3

# severity by monthly impact (strictly greater than)
SEVERITY_THRESHOLDS = [("critical", 50_000), ("high", 20_000), ("medium", 5_000)]
SEVERITY_DEFAULT = "low"

# segment_key -> human label (anything else is shown as the key itself)
SEGMENT_LABELS = {
    "MX|Mastercard|Debit|BBVA": "BBVA Mexico (Mastercard Debit)",
    "MX|BBVA": "BBVA Mexico",
    "MX|BBVA|Mastercard|Debit": "BBVA Mexico (Mastercard Debit)",
    "MX|BBVA|Visa|Credit": "BBVA Mexico (Visa Credit)",
    "$10-50": "Low-value ($10-$50)",
    "$50-100": "Mid-value ($50-$100)",
    "$100-200": "High-value ($100-$200)",
    "$200-350": "High-value ($200-$350)",
    "$350-500": "Premium ($350-$500)",
    "evening_17_20": "Evening (17h-20h)",
    "night_20_24": "Night (20h-24h)",
    "late_night_0_6": "Late Night (0h-6h)",
    "morning_6_12": "Morning (6h-12h)",
    "afternoon_12_17": "Afternoon (12h-17h)",
    "MX": "Mexico",
    "BR": "Brazil",
    "CO": "Colombia",
    "Credit": "Credit Cards",
    "Debit": "Debit Cards",
    "Visa": "Visa",
    "Mastercard": "Mastercard",
    "Amex": "Amex",
}

# chart colour bands and target line
RATE_GREEN_THRESHOLD = 0.75
RATE_YELLOW_THRESHOLD = 0.65
TARGET_THRESHOLD = 0.70
INFLECTION_WEEK = 4
MAX_CARDS = 5

# planted degradation patterns of the generated data (audit predicates)
PATTERN_HOT_COUNTRY = "MX"
PATTERN_HOT_ISSUER = "BBVA"
PATTERN_HIGH_VALUE_USD = 200.0
PATTERN_EVENING_HOUR = 20

# reference per-country FX rates (local currency -> USD)
COUNTRY_FX = {"BR": 0.20, "MX": 0.058, "CO": 0.00025}

# two-sided normal tail, Abramowitz & Stegun 26.2.17 polynomial
NORMAL_TAIL_P = 0.2316419
NORMAL_TAIL_B = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]

# ---------------------------------------------------------------------------
# Schema helpers
# ---------------------------------------------------------------------------

_TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


class SchemaError(TypeError):
    pass


def validate(df: DataFrame, schema: T.StructType = RAW_TRANSACTION, strict: bool = False) -> DataFrame:
    """Raise if a contract column is missing or has another type.

    Extra columns are tolerated unless ``strict``; timestamps match with or
    without a time zone. Returns ``df`` unchanged, so it chains.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in actual:
            raise ValueError(f"Missing required column: {field.name}")
        got = actual[field.name]
        if isinstance(field.dataType, _TIMESTAMP_TYPES):
            if not isinstance(got, _TIMESTAMP_TYPES):
                raise SchemaError(f"Column '{field.name}': expected timestamp, got {got.simpleString()}")
        elif got != field.dataType:
            raise SchemaError(
                f"Column '{field.name}': expected {field.dataType.simpleString()}, got {got.simpleString()}")
    if strict:
        extra = set(actual) ^ {f.name for f in schema.fields}
        if extra:
            raise ValueError(f"Column set differs from contract: {sorted(extra)}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every contract column to its type and select them in contract order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
