"""A3 / C2 / S7 kept up to date: adding a week without reading all weeks again.

Two layers hand over. The base layer holds the cube's additive measures per cluster grain, partitioned by week; it is
the size of the dimensions' cardinality times the weeks, not of the rows. The segment layer is
partitioned by period. Loading a week

1. reads that week's raw rows alone (a raw layer partitioned by week is pruned to its folder),
2. replaces the week's partition of the base (dynamic partition overwrite: other weeks' files stay),
3. rolls up, from the base, the periods that the week is part of -- itself, its half and ``all`` --
   and replaces those partitions of the segment layer.

Loading a week again replaces it, so a repeated or corrected load does not count twice. A week whose
rows have all gone leaves an empty base partition and no row of its own period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..functions.columns import half_labels
from . import segments as S
from .enrich import enrich


def _overwrite(df: DataFrame, path: str, column: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def _base_schema(defs) -> T.StructType:
    """Columns of the base layer; the dimensions are strings, as the segment rows hold them."""
    dims = [c for c in S._grain(defs) if c != S.WEEK]
    return T.StructType([*(T.StructField(c, T.StringType()) for c in dims),
                         T.StructField(S.DECLINED_FLAG, T.BooleanType()),
                         *(T.StructField(m, T.LongType()) for m in S.MEASURES),
                         T.StructField("_cid", T.IntegerType()), T.StructField(S.WEEK, T.IntegerType())])


def _weeks_filter(weeks: list[int | None]):
    known = [w for w in weeks if w is not None]
    keep = F.col(S.WEEK).isin(known) if known else F.lit(False)
    return keep | F.col(S.WEEK).isNull() if None in weeks else keep


def touched_periods(weeks: list[int | None], split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> list[str]:
    """The periods that rows of ``weeks`` count in; a null week is in the second half and in ``all``."""
    early, late = half_labels(split_week, n_weeks)
    halves = {early if w is not None and w <= split_week else late for w in weeks}
    return [f"week_{w}" for w in weeks if w is not None] + sorted(halves) + ["all"]


def read_base(spark: SparkSession, path: str, definitions: dict | None = None,
              declined_only: dict | None = None) -> DataFrame:
    return spark.read.schema(_base_schema(S._definitions(definitions, declined_only))).parquet(path)


def load_weeks(raw: DataFrame, weeks: list[int | None], base_path: str, segments_path: str,
               definitions: dict | None = None, declined_only: dict | None = None,
               split_week: int = C.SPLIT_WEEK, n_weeks: int = C.N_WEEKS) -> DataFrame:
    """Put ``weeks`` of ``raw`` into both layers (a first load or an update); the segment layer is returned.

    ``None`` among the weeks stands for the rows without one.
    """
    if not weeks:
        raise ValueError("no week to load")
    spark = raw.sparkSession
    defs = S._definitions(definitions, declined_only)
    schema = _base_schema(defs)
    rows = enrich(raw.where(_weeks_filter(weeks)), split_week, n_weeks)
    base = S.base_aggregate(rows, defs)
    base = base.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
    # a week without rows must replace its partition too: it keeps one empty row of no cluster
    known = spark.createDataFrame([(w,) for w in weeks], T.StructType([T.StructField(S.WEEK, T.IntegerType())]))
    blank = known.select(*(F.col(S.WEEK) if f.name == S.WEEK else F.lit(-1).alias(f.name) if f.name == "_cid"
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    _overwrite(base.unionByName(blank), base_path, S.WEEK)
    stored = read_base(spark, base_path, definitions, declined_only).where(F.col("_cid") >= 0)
    periods = touched_periods(weeks, split_week, n_weeks)
    cube = S.segment_cube(None, definitions, declined_only, split_week, n_weeks, base=stored, only_periods=periods)
    _overwrite(cube, segments_path, "period")
    return C.conform(spark.read.schema(C.SEGMENT).parquet(segments_path), C.SEGMENT)
