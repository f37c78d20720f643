import os
import time

import pytest

from ratelens import session
from ratelens.session import checkpoint_root, cut_lineage


def test_cut_lineage_writes_under_the_checkpoint_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    df = cut_lineage(spark.range(10).withColumnRenamed("id", "x"), "probe")
    assert df.count() == 10 and df.columns == ["x"]
    assert any(name.startswith("probe-") for name in os.listdir(os.path.join(root.replace("file:", ""), "layers")))


def test_fallback_when_unset(spark, monkeypatch):
    class NoConf:
        def get(self, key, default=None):
            return default

    class FakeCtx:
        master = "local[2]"

        def getConf(self):
            return NoConf()

    class FakeSession:
        conf = NoConf()
        sparkContext = FakeCtx()

    monkeypatch.setattr(session, "_LOCAL_ROOT", None)
    root = checkpoint_root(FakeSession())
    assert os.path.isdir(root) and os.path.basename(root).startswith("ratelens-ckpt-")
    assert checkpoint_root(FakeSession()) == root
    FakeCtx.master = "spark://host:7077"
    monkeypatch.setattr(session, "_LOCAL_ROOT", None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(FakeSession())


def test_drop_layers_deletes_what_was_written(spark):
    session.drop_layers(spark)
    df = cut_lineage(spark.range(3), "gone")
    assert df.count() == 3
    assert session.drop_layers(spark) == 1
    assert not any(name.startswith("gone-") for name in
                   os.listdir(os.path.join(checkpoint_root(spark).replace("file:", ""), "layers")))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_once_a_layer_is_written(spark):
    before = shuffle_files(spark)
    df = cut_lineage(spark.range(5000).repartition(7, "id").groupBy("id").count(), "shuffled")
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and df.count() == 5000
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_working_layers_keep_what_they_are_told(spark):
    mark = session.layers_mark(spark)
    with session.working_layers(spark) as outer:
        first = outer(cut_lineage(spark.range(3), "first"))
        with session.working_layers(spark) as inner:
            cut_lineage(spark.range(4), "second")
            third = inner(cut_lineage(spark.range(5), "third"))
        assert third.count() == 5 and len(session._written(spark)) == mark + 2
        gone = cut_lineage(spark.range(6), "fourth")
        assert session.drop_layer(gone) == 1 and session.drop_layer(gone) == 0
    assert first.count() == 3 and len(session._written(spark)) == mark + 1


def test_job_entry_sets_no_master():
    import inspect

    from ratelens.plans import jobs
    assert ".master(" not in inspect.getsource(jobs) and "get_spark" not in inspect.getsource(jobs)
