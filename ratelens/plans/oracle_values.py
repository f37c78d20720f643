"""FIXED VALUES of the oracle, typed apart from the engine's.

They must equal the reference application's values; the engine's own copy is
``contracts.py`` (and the bindings' rules ``sources/bindings.py``). Neither reads the other, so a
change of either alone turns a comparison red. Plain, in natural order.
"""

WEEKS_PER_PERIOD = 3
WEEKS_PER_MONTH = 4.33


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

# two-sided normal tail, Abramowitz & Stegun 26.2.17 polynomial
NORMAL_TAIL_P = 0.2316419
NORMAL_TAIL_B = [0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429]

# the bindings of the test tables
EVENTS_START = "2024-01-01"
EVENTS_PERIOD_DAYS = 5
LINEITEM_FIRST_YEAR = 1995
LINEITEM_PRICE_DIVISOR = 210
REGION_FX = [0.20, 0.058, 0.00025, 1.0, 0.5]

# arguments of the named queries
E_PATTERN = {"country": "AMERICA", "issuer": "NATION_1"}
L_PATTERN = {"country": "EUROPE", "issuer": "NATION_3"}
FALLBACK_MIN_N = 10
DRILL_DIMS = ["card_brand", "card_type", "amount_bucket", "hour_bucket"]
RISK_DIMS = ["country", "card_brand", "card_type"]
L_VARIANTS = ("enrich_buckets", "segments_all", "anomalies", "insights", "first_time_vs_returning",
              "acquisition_cohorts", "weekly_trend", "pattern_audit", "waterfall", "amount_box",
              "country_breakdown", "issuer_heatmap", "summary", "hourly_pattern", "recurring_vs_onetime",
              "change_points", "cohort_retention", "amount_box_whiskers", "segments_incremental")
