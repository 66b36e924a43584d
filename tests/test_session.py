from types import SimpleNamespace

import pytest

from voxloom import session


def bare(master: str, configured: str | None = None, checkpoint: str | None = None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_the_named_folder_is_used():
    assert session.shared_dir(bare("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert session.shared_dir(bare("yarn", None, "hdfs://x/other")) == "hdfs://x/other"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        session.shared_dir(bare("yarn"))
    local = bare("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_audio_batches_leave_the_session_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with session.audio_batches(spark):
        assert spark.conf.get(key) == "1024"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "7")
    with session.audio_batches(spark):
        assert spark.conf.get(key) == "7"
    assert spark.conf.get(key) == "7"
    spark.conf.unset(key)


def test_spread_only_small_scans(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = lambda d: d._jdf.queryExecution().executedPlan().toString().count("RoundRobinPartitioning")
    assert parts(session.spread(df, bytes_per_task=1 << 18)) == 1
    assert parts(session.spread(df, bytes_per_task=1 << 18, small_bytes=1)) == 0
    assert parts(session.spread(df, bytes_per_task=1 << 30)) == 0
