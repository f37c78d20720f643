"""Session settings and small execution helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are designed around. On a cluster these come from
# spark-defaults / spark-submit; ``get_spark`` applies them only for local runs.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}

# Local-only: the test tables are a few MB, so AQE's default 1 MB minimum
# would coalesce a shuffle into 2-3 tasks on 8 cores. On a cluster the
# shuffles are large and the defaults apply.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def get_spark(app: str = "ratelens", cpus: int | str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used to configure a cluster job)."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", os.environ.get("RATELENS_DRIVER_MEMORY", "8g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in {**RECOMMENDED_CONF, **LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine (master ``local`` or ``local[...]``: tests,
    the bench) may do without: it gets a private folder. Anywhere else an unset
    folder raises, since executors could not read each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # spark.checkpoint.dir is a static (core) setting: it cannot be set on a
    # running session, so the private folder is only remembered here.
    global _LOCAL_ROOT
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = fallback or tempfile.mkdtemp(prefix="ratelens-ckpt-")
    return _LOCAL_ROOT


_LOCAL_ROOT: str | None = None


#: The layers each Spark application has written and not yet deleted, oldest first.
_LAYERS: dict[str, list[str]] = {}
#: The folder that a frame returned by ``cut_lineage`` reads.
_FOLDER: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: The layers written so far inside the innermost ``working_layers`` of this thread.
_WORKING: ContextVar[list[str] | None] = ContextVar("working_layers", default=None)


def _written(spark: SparkSession) -> list[str]:
    return _LAYERS.setdefault(spark.sparkContext.applicationId, [])


def layer_path(spark: SparkSession, name: str) -> str:
    """A new folder for a layer under the shared checkpoint folder, entered in the registry."""
    path = f"{checkpoint_root(spark)}/layers/{name}-{uuid.uuid4().hex}"
    _written(spark).append(path)
    if (working := _WORKING.get()) is not None:
        working.append(path)
    return path


def layers_mark(spark: SparkSession) -> int:
    """Where the registry stands; give it to ``drop_layers`` to delete later layers alone."""
    return len(_written(spark))


def drop_layers(spark: SparkSession, since: int = 0, keep: str | None = None) -> int:
    """Delete the application's layers (those written after ``since``, but for ``keep``); call it when
    the results that read them are written."""
    return _delete(spark, [p for p in _written(spark)[since:] if p != keep])


def _delete(spark: SparkSession, names: list[str]) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written(spark)
    gone = 0
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(name)
        gone += bool(path.getFileSystem(conf).delete(path, True))
        if name in paths:
            paths.remove(name)
    return gone


def drop_layer(*frames: DataFrame) -> int:
    """Delete the layers that ``frames``, as ``cut_lineage`` returned them, read: call it when all that was made
    of them is written."""
    return sum(_delete(df.sparkSession, [_FOLDER.pop(df)]) for df in frames if df in _FOLDER)


@contextmanager
def working_layers(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """At its end, delete the layers that this thread wrote inside, but for those given to the function it yields."""
    mine: list[str] = []
    kept: list[str] = []
    outer = _WORKING.get()
    token = _WORKING.set(mine)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(_FOLDER[df])
        return df

    try:
        yield keep
    finally:
        _WORKING.reset(token)
    _delete(spark, [p for p in mine if p not in kept and p in _written(spark)])
    if outer is not None:
        outer.extend(kept)


#: Set to true, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold inside only."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def cut_lineage(df: DataFrame, name: str = "layer") -> DataFrame:
    """Materialise ``df`` once as a parquet table under the shared checkpoint
    folder and return a scan of it.

    Used for small intermediate layers (segments, anomalies) that several
    downstream subqueries read: the plan above is computed exactly once (a
    plain ``checkpoint()`` computes an uncached plan twice), the result
    survives executor loss, and the read-back is a pruned columnar scan. The
    shuffle files of the plan above are deleted once the table is written.
    """
    path = layer_path(df.sparkSession, name)
    with settings(df.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        df.write.mode("overwrite").parquet(path)
    # the schema is known: no inference job on read-back
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDER[made] = path
    return made
