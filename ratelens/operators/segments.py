"""The approval-rate cube over segment definitions x periods.

Plan (three shuffles whatever the number of definitions and periods; only the
first one sees raw rows):

1. base aggregate: the definitions are grouped into clusters by their maximal
   dimension sets (a definition whose dimensions are a subset of another's is
   served by that one's grain), and one ``groupingSets`` over the raw rows
   computes week + cluster dims + declined flag for each cluster. Partial
   aggregation runs map-side with small hash tables, so the shuffle carries at
   most one row per grain key per task -- a hot key holding a third of all
   rows costs one row, not a third. Money is summed as long units (fast path).
2. weekly cube: ``groupingSets`` over the small base, one set per definition
   (each with the week and the cluster id), named by ``grouping_id()``; a
   definition keeps only its own cluster's rows.
3. periods: counts and sums are additive, so each weekly row of step 2 (a
   table the size of the output) feeds its week, its half and 'all' and one
   plain ``groupBy`` rolls them up. Rates are derived last.

Declined-only definitions group on the declined flag as well and keep the
flag=true side, which equals filtering to declined rows first. A null week
is a group of its own in steps 1-2: it has no weekly period but counts in the
second half and in 'all', as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.columns import (half_labels, is_approved, money_units, money_units_to_double,
                                 period_half, safe_rate, sql_literal, week_label)
from .enrich import enrich

DECLINED_FLAG = "_declined"
WEEK = "week_number"
MEASURES = ("n", "n_approved", "amount", "approved_amount")


def _definitions(definitions, declined_only):
    defs = C.SEGMENT_DEFINITIONS if definitions is None else definitions
    dec = C.DECLINED_ONLY_SEGMENT_DEFINITIONS if declined_only is None else declined_only
    out = [(t, list(d), False) for t, d in defs.items()]
    out += [(t, list(d), True) for t, d in dec.items()]
    if len({t for t, _, _ in out}) < len(out):
        raise ValueError("a segment type is defined twice (definitions and declined_only share a name)")
    for t, d, _ in out:
        if not 1 <= len(d) <= 4:
            raise ValueError(f"segment '{t}' needs 1 to 4 dimensions, got {d}")
    return out


def _grain(defs) -> list[str]:
    dims = [WEEK]
    for _, d, _ in defs:
        dims += [c for c in d if c not in dims]
    return dims


def clusters(defs) -> tuple[list[list[str]], dict[str, int]]:
    """Maximal dimension sets of the definitions, and each type's cluster.

    A definition whose dimensions are a subset of another's is computed from
    that one's base, so the base has one small grain per maximal set (e.g.
    {country, issuer, brand, type}, {amount_bucket}, {hour_bucket},
    {country, decline_reason}) instead of the product of all dimensions.
    """
    order = _grain(defs)
    sets = [(t, frozenset(d) - {WEEK}) for t, d, _ in defs]  # every grain has the week
    maximal: list[frozenset] = []
    for _, ds in sorted(sets, key=lambda x: (-len(x[1]), sorted(x[1]))):
        if not any(ds <= m for m in maximal):
            maximal.append(ds)
    assign = {t: next(i for i, m in enumerate(maximal) if ds <= m) for t, ds in sets}
    return [[c for c in order if c in m] for m in maximal], assign


def base_aggregate(enriched: DataFrame, defs) -> DataFrame:
    """Additive measures per cluster grain (week + cluster dims + declined flag).

    One scan and one shuffle: ``groupingSets`` with one set per cluster, with
    map-side partial aggregation (a hot key costs one row per task). ``_cid``
    names the cluster of a row. Money is summed as long units (fast path).
    """
    cl, _ = clusters(defs)
    cols = _grain(defs) + [DECLINED_FLAG]
    sets = [[WEEK] + dims + [DECLINED_FLAG] for dims in cl]
    gids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets]
    approved = is_approved("status")
    units = money_units("amount_usd")
    base = (enriched
            .withColumn(DECLINED_FLAG, F.col("decline_reason").isNotNull())
            .groupingSets([[F.col(c) for c in s] for s in sets], *cols)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(approved).alias("n_approved"),
                 F.sum(units).alias("amount"),
                 F.sum(F.when(approved, units)).alias("approved_amount"),
                 F.grouping_id().alias("_gid1")))
    cid = F.expr("map(" + ", ".join(f"{g}, {i}" for i, g in enumerate(gids)) + ")[_gid1]")
    return base.withColumn("_cid", cid).drop("_gid1")


def _ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _case_sql(per_type: dict[str, str]) -> Column:
    """CASE segment_type WHEN ... as one SQL expression (one JVM call)."""
    whens = " ".join(f"WHEN {sql_literal(t)} THEN {expr}" for t, expr in per_type.items())
    return F.expr(f"CASE segment_type {whens} END")


def _dim_sql(d: str) -> str:
    return f"CAST({_ident(d)} AS STRING)"


def _key_sql(dims: list[str]) -> str:
    # null in any dimension -> null key (concat, not concat_ws)
    if len(dims) == 1:
        return _dim_sql(dims[0])
    return "concat(" + ", '|', ".join(_dim_sql(d) for d in dims) + ")"


def _sum_wide(c: str) -> Column:
    # the half / 'all' roll-up runs on output-sized rows: DECIMAL(38,0) cannot overflow
    return F.sum(F.col(c).cast("decimal(38,0)"))


def weekly_cube(base: DataFrame, defs) -> DataFrame:
    """Step 2: one row per (segment type, its dimension values, week), from its cluster's base rows."""
    dims = _grain(defs)
    _, assign = clusters(defs)
    group_cols = dims + [DECLINED_FLAG, "_cid"]
    sets: dict[int, list[str]] = {}
    types_by_gid: dict[int, list[str]] = {}
    for t, d, dec in defs:
        members = {WEEK, "_cid", *d} | ({DECLINED_FLAG} if dec else set())
        gid = sum(1 << (len(group_cols) - 1 - i) for i, c in enumerate(group_cols) if c not in members)
        sets[gid] = [c for c in group_cols if c in members]
        types_by_gid.setdefault(gid, []).append(t)

    # long sums over the small base (fast path; ANSI mode raises on overflow)
    cube = (base.groupingSets([[F.col(c) for c in s] for s in sets.values()], *group_cols)
            .agg(*[F.sum(m).alias(m) for m in MEASURES], F.grouping_id().alias("_gid")))
    gid_map = ", ".join(f"{gid}, array({', '.join(sql_literal(t) for t in ts)})"
                        for gid, ts in types_by_gid.items())
    typed = cube.withColumn("segment_type", F.explode(F.expr(f"map({gid_map})[_gid]")))
    # a type only reads the base rows of its own cluster
    own = ", ".join(f"{sql_literal(t)}, {c}" for t, c in assign.items())
    typed = typed.where(F.expr(f"map({own})[segment_type]") == F.col("_cid"))
    declined_types = [t for t, _, dec in defs if dec]
    if declined_types:
        typed = typed.where(~F.col("segment_type").isin(declined_types) | F.col(DECLINED_FLAG))

    by_type = {t: d for t, d, _ in defs}
    dim_cols = [_case_sql({t: (_dim_sql(d[i]) if i < len(d) else "CAST(NULL AS STRING)")
                           for t, d in by_type.items()}).alias(f"dimension_{i + 1}") for i in range(4)]
    return typed.select(
        "segment_type",
        _case_sql({t: _key_sql(d) for t, d in by_type.items()}).alias("segment_key"),
        *dim_cols, WEEK, *MEASURES)


def _finish(df: DataFrame) -> DataFrame:
    out = df.select(
        "segment_type", "segment_key", "dimension_1", "dimension_2", "dimension_3", "dimension_4", "period",
        F.col("n").cast("long").alias("total_transactions"),
        F.col("n_approved").cast("long").alias("approved_transactions"),
        (F.col("n") - F.col("n_approved")).cast("long").alias("declined_transactions"),
        safe_rate("n_approved", "n").alias("approval_rate"),
        money_units_to_double("amount").alias("total_amount_usd"),
        money_units_to_double("approved_amount").alias("approved_amount_usd"))
    return C.conform(out, C.SEGMENT)


def segment_cube(df: DataFrame | None, definitions: dict | None = None, declined_only: dict | None = None,
                 split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS,
                 base: DataFrame | None = None, only_periods: list[str] | None = None) -> DataFrame:
    """All segment rows (SEGMENT contract) for every definition and period.

    ``df`` is raw or enriched transactions; pass ``base`` (from
    ``base_aggregate(enriched, defs)``) to reuse an already computed base.
    ``only_periods`` rolls up no other periods (``operators.incremental``).
    """
    defs = _definitions(definitions, declined_only)
    if base is None:
        if "amount_bucket" not in df.columns or "hour_bucket" not in df.columns:
            df = enrich(df, split_week, n_weeks)
        base = base_aggregate(df, defs)
    weekly = weekly_cube(base, defs)
    keys = ["segment_type", "segment_key", "dimension_1", "dimension_2", "dimension_3", "dimension_4"]
    # one branch: every weekly row feeds its week (none for a null week), its
    # half and 'all'. (A union of a weekly branch and a roll-up branch would
    # read the raw rows twice: the week filter is pushed below the base
    # aggregate, so the two branches no longer share its shuffle.)
    periods = F.array(week_label(WEEK), period_half(WEEK, split_week, n_weeks), F.lit("all"))
    rolled = (weekly.withColumn("period", F.explode(periods))
              .where(F.col("period").isNotNull() if only_periods is None else F.col("period").isin(only_periods))
              .groupBy(*keys, "period")
              .agg(*[_sum_wide(m).alias(m) for m in MEASURES]))
    return _finish(rolled)


def segment_by(df: DataFrame, dims: list[str], where: Column | None = None, name: str = "drill",
               declined_only: bool = False, split_week: int = C.SPLIT_WEEK,
               n_weeks: int = C.N_WEEKS) -> DataFrame:
    """Approval rate on any 1-4 dimensions, optionally over a filtered slice."""
    if where is not None:
        df = df.where(where)
    spec = {name: dims}
    return segment_cube(df, definitions={} if declined_only else spec,
                        declined_only=spec if declined_only else {},
                        split_week=split_week, n_weeks=n_weeks)

