"""The data behind the dashboard views (rendering is not built).

Every view reads a layer (trends, segments, insights) or the enriched rows and
stays a DataFrame; the weeks of a pivot are read from its (small) layer, so no
week is ever left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import half_labels, is_approved, pattern_flags, period_half, rate_band, safe_rate
from ..functions.text import fixed, scaled_int
from ..session import cut_lineage


def headline_trend(trends: DataFrame, target: float = C.TARGET_THRESHOLD,
                   inflection_week: int = C.INFLECTION_WEEK) -> DataFrame:
    """V1: weekly rate, colour band, target line, inflection marker."""
    return trends.select(
        "week_number", "total_transactions", "approval_rate",
        rate_band("approval_rate").alias("rate_band"),
        F.lit(target).alias("target_rate"),
        (F.col("approval_rate") < F.lit(target)).alias("below_target"),
        F.coalesce(F.col("week_number") == F.lit(inflection_week), F.lit(False)).alias("is_inflection"),
    ).orderBy("week_number")


def country_breakdown(segments: DataFrame, segment_type: str = "country", split_week: int = C.SPLIT_WEEK,
                      n_weeks: int = C.N_WEEKS) -> DataFrame:
    """V2: early/late rate per country (missing -> 0.0), drop in pp, worst first.

    ``is_worst`` marks the first country of the order (lowest late rate) when its
    drop is positive, like the chart's annotation.
    """
    early, late = half_labels(split_week, n_weeks)
    seg = segments.where((F.col("segment_type") == segment_type) & F.col("period").isin(early, late))
    per = (seg.groupBy(F.col("dimension_1").alias("country"))
           .agg(F.max(F.when(F.col("period") == early, F.col("approval_rate"))).alias("_e"),
                F.max(F.when(F.col("period") == late, F.col("approval_rate"))).alias("_l")))
    order_key = F.struct(F.col("_l").isNull().alias("no_late"), F.col("_l").alias("late"),
                         F.col("country").alias("c"))
    worst = per.agg(F.min(order_key)).scalar()
    out = per.select(
        "country",
        F.coalesce("_e", F.lit(0.0)).alias("early_rate"),
        F.coalesce("_l", F.lit(0.0)).alias("late_rate"),
        ((F.coalesce("_e", F.lit(0.0)) - F.coalesce("_l", F.lit(0.0))) * F.lit(100.0)).alias("drop_pp"),
        rate_band(F.coalesce("_l", F.lit(0.0))).alias("late_band"),
        order_key.alias("_ord"))
    out = out.withColumn("is_worst", (F.col("_ord") == worst) & (F.col("drop_pp") > 0))
    return out.orderBy("_ord").drop("_ord")


def issuer_heatmap(segments: DataFrame, segment_type: str = "issuer") -> DataFrame:
    """V3: issuer x week approval rate (missing -> 0.0), worst last week first.

    The weeks are those of the layer: as many numbers as it has weekly periods.

    Keyed by segment_key / dimension_2 (the issuer). The reference pivots on
    dimension_1, which is the country for issuer rows; that is not repeated.
    """
    # weekly periods by prefix ('weeks_...' halves do not match); prunes period partitions
    seg = segments.where((F.col("segment_type") == segment_type) & F.col("period").startswith("week_"))
    weeks = sorted((r[0] for r in seg.select("period").distinct().collect()), key=lambda p: int(p[len("week_"):]))
    if not weeks:
        raise ValueError(f"the segment layer has no weekly row of type '{segment_type}'")
    wide = (seg.groupBy("segment_key", F.col("dimension_1").alias("country"),
                        F.col("dimension_2").alias("issuer_bank"))
            .pivot("period", weeks).agg(F.first("approval_rate")))
    wide = wide.na.fill(0.0, subset=weeks)
    return wide.orderBy(F.col(weeks[-1]).asc(), F.col("segment_key").asc_nulls_last())


FACTORS = ["hot_issuer", "high_value", "evening", "other"]


def waterfall(enriched: DataFrame, split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS,
              **pattern_params) -> DataFrame:
    """V4: exact decomposition of the half-over-half rate change by pattern factor.

    Each row goes to the first pattern it matches (hot issuer, high value,
    evening, other -- the generator's priority). With weights w and rates r per
    factor in each half, contribution = mean(w)*dr + dw*(mean(r) - mean(R)),
    which sums exactly to the overall change. Values in percentage points.
    """
    flags = pattern_flags(**pattern_params)
    factor = (F.when(flags["is_hot_issuer"], F.lit("hot_issuer"))
              .when(flags["is_high_value"], F.lit("high_value"))
              .when(flags["is_evening"], F.lit("evening")).otherwise(F.lit("other")))
    early, late = half_labels(split_week, n_weeks)
    half = period_half("week_number", split_week, n_weeks)
    ok = is_approved()
    # the raw rows are grouped once; grouping sets over the four factor rows add the total
    factors = (enriched.withColumn("factor", factor).groupBy("factor")
               .agg(F.count_if(half == early).alias("nb"), F.count_if((half == early) & ok).alias("ab"),
                    F.count_if(half == late).alias("nc"), F.count_if((half == late) & ok).alias("ac")))
    per = (factors.groupingSets([[F.col("factor")], []], "factor")
           .agg(*(F.sum(c).alias(c) for c in ("nb", "ab", "nc", "ac")), F.grouping_id().alias("_total")))
    # at most 5 rows (4 fixed factors + the total): the totals are a window over them
    everything = Window.partitionBy()
    per = per.withColumns({f"t{c}": F.max(F.when(F.col("_total") == 1, F.col(c))).over(everything)
                           for c in ("nb", "ab", "nc", "ac")})
    rb_all = safe_rate("tab", "tnb")
    rc_all = safe_rate("tac", "tnc")
    wb = safe_rate("nb", "tnb")
    wc = safe_rate("nc", "tnc")
    rb = safe_rate("ab", "nb")
    rc = safe_rate("ac", "nc")
    contrib = ((wb + wc) / 2 * (rc - rb) + (wc - wb) * ((rb + rc) / 2 - (rb_all + rc_all) / 2)) * 100.0
    step = F.array_position(F.array(*[F.lit(f) for f in FACTORS]), F.col("factor")).cast("int")
    rows = F.when(F.col("_total") == 0, F.array(
        F.struct(F.col("factor"), F.lit("relative").alias("measure"), contrib.alias("contribution_pp"),
                 step.alias("step")))
    ).otherwise(F.array(
        F.struct(F.lit("Baseline").alias("factor"), F.lit("absolute").alias("measure"),
                 (rb_all * 100.0).alias("contribution_pp"), F.lit(0).alias("step")),
        F.struct(F.lit("Current").alias("factor"), F.lit("total").alias("measure"),
                 (rc_all * 100.0).alias("contribution_pp"), F.lit(len(FACTORS) + 1).alias("step"))))
    return per.select(F.explode(rows).alias("s")).select("s.*").orderBy("step")


#: Buckets of the distinct amounts of a group, by approximate quantiles.
BOX_BUCKETS = 256


def amount_counts(enriched: DataFrame) -> DataFrame:
    """A written layer of rows (c) per half, status and distinct amount (a)."""
    return cut_lineage(enriched.groupBy("period_half", "status", F.col("amount_usd").alias("a"))
                       .agg(F.count(F.lit(1)).alias("c")), "amount-counts")


def amount_box(enriched: DataFrame | None, buckets: int = BOX_BUCKETS, counts: DataFrame | None = None) -> DataFrame:
    """V5: box statistics of amount_usd by half x status, with exact quantiles.

    The rows are counted per distinct amount once; the amounts of a group are
    split into ``buckets`` ranges by approximate quantiles, the counts of the
    ranges (at most ``buckets`` a group) are summed up, and only the ranges that
    hold a wanted rank are ordered. No task ever holds a whole group. ``counts`` (``amount_counts``)
    may be given in place of the rows.
    """
    group = ["period_half", "status"]
    counts = amount_counts(enriched) if counts is None else counts
    known = F.col("a").isNotNull()
    edges = F.array(*(F.lit(i / buckets) for i in range(1, buckets)))
    box = counts.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(known, F.col("c"))), F.lit(0)).alias("n"), F.min("a").alias("min"), F.max("a").alias("max"),
        F.try_divide(F.sum(F.col("a") * F.col("c")), F.sum(F.when(known, F.col("c")))).alias("mean"),
        F.percentile_approx("a", edges, 10_000).alias("cuts"))
    keys = counts.where(known).join(box.select(*(F.col(g).alias(f"_{g}") for g in group), "n", "cuts"),
                                    [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group])
    ranged = keys.select(*group, "n", "a", "c", F.size(F.filter("cuts", lambda x: x < F.col("a"))).alias("range"))
    up_to = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*group, "range").agg(F.sum("c").alias("held"), F.min("n").alias("n")).withColumn(
        "before", F.coalesce(F.sum("held").over(up_to), F.lit(0)))
    quantiles = (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    wanted = totals.select(*group, "range", "before", "held", F.explode(F.array(*(
        F.struct(F.lit(name).alias("q"), (F.lit(q) * (F.col("n") - 1)).alias("at")) for name, q in quantiles))).alias("w"))
    wanted = wanted.select(*group, "range", "before", "held", "w.q", F.explode(F.array(
        F.struct(F.floor("w.at").alias("rank"), (F.lit(1.0) - (F.col("w.at") - F.floor("w.at"))).alias("share")),
        F.struct((F.floor("w.at") + 1).alias("rank"), (F.col("w.at") - F.floor("w.at")).alias("share")))).alias("r"))
    wanted = wanted.where((F.col("r.share") > 0) & F.col("r.rank").between(F.col("before"), F.col("before") + F.col("held") - 1))
    near = Window.partitionBy(*group, "range").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    asked = wanted.select(*(F.col(g).alias(f"_{g}") for g in group), F.col("range").alias("_range")).distinct()
    some = (ranged.join(asked, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.col("range") == F.col("_range")])
            .withColumn("inside", F.coalesce(F.sum("c").over(near), F.lit(0)))
            .select(*(F.col(g).alias(f"_{g}") for g in group), F.col("range").alias("_range"), "a", "c", "inside"))
    rank = F.col("r.rank") - F.col("before")
    hit = wanted.join(some, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.col("range") == F.col("_range")]).where(
        (rank >= F.col("inside")) & (rank < F.col("inside") + F.col("c")))
    found = hit.groupBy(*group).agg(*(
        F.sum(F.when(F.col("q") == name, F.col("a") * F.col("r.share"))).alias(name) for name, _ in quantiles))
    found = found.select(*(F.col(g).alias(f"_{g}") for g in group), "q1", "median", "q3")
    return (box.join(found, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], "left")
            .select(*group, "n", "min", "q1", "median", "q3", "max", "mean").orderBy(*group))


def hourly_pattern(enriched: DataFrame) -> DataFrame:
    """V6: approval rate by hour of day x half."""
    return (enriched.groupBy("hour_of_day", "period_half")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.count_if(is_approved()).alias("approved_transactions"))
            .withColumn("approval_rate", safe_rate("approved_transactions", "total_transactions"))
            .orderBy("hour_of_day", "period_half"))


def kpi_row(trends: DataFrame, insights: DataFrame) -> DataFrame:
    """Current (last week) and baseline (first week) rate, change in pp, total impact."""
    impact = insights.agg(F.sum("estimated_revenue_impact_usd")).scalar()
    k = trends.agg(F.max_by("approval_rate", "week_number").alias("current_rate"),
                   F.min_by("approval_rate", "week_number").alias("baseline_rate"))
    total = F.coalesce(impact, F.lit(0.0))
    return k.select(
        "current_rate", "baseline_rate",
        scaled_int((F.col("current_rate") - F.col("baseline_rate")) * 100.0, 0).cast("int").alias("decline_pp"),
        total.alias("total_impact_usd"),
        F.concat(fixed(F.col("current_rate") * 100.0, 0), F.lit("%")).alias("current_text"),
        F.concat(fixed(F.col("baseline_rate") * 100.0, 0), F.lit("%")).alias("baseline_text"),
        F.concat(fixed((F.col("current_rate") - F.col("baseline_rate")) * 100.0, 0, plus=True),
                 F.lit("pp")).alias("decline_text"),
        F.concat(F.lit("~$"), fixed(total / 1_000_000.0, 1), F.lit("M")).alias("impact_text"))


def insight_cards(insights: DataFrame, max_cards: int = C.MAX_CARDS) -> DataFrame:
    """The first ``max_cards`` insights by rank with their card texts."""
    top = insights.orderBy("rank").limit(max_cards)
    return top.select(
        "rank", "severity", F.upper("severity").alias("badge"), "title",
        F.concat(fixed(F.col("baseline_rate") * 100.0, 0), F.lit("% -> "),
                 fixed(F.col("current_rate") * 100.0, 0), F.lit("% ("),
                 fixed(F.col("rate_change") * 100.0, 0, plus=True), F.lit("pp)")).alias("metric_text"),
        F.concat(F.lit("Est. impact: $"), fixed(F.col("estimated_revenue_impact_usd") / 1000.0, 0),
                 F.lit("K/month | "), F.format_number(F.col("affected_transactions"), 0),
                 F.lit(" txns affected")).alias("impact_text"))
