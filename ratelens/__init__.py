"""ratelens: payment-approval analytics on Spark.

Raw transactions -> enrich -> approval-rate cube (grouping sets) -> period
comparison with z-scores and two-proportion tests -> ranked insights, plus
customer cohorts and the data behind the dashboard views. Every operator takes
and returns a DataFrame.
"""

__version__ = "0.1.0"
