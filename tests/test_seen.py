"""De-duplication of a stream against a table of seen keys."""

import pytest
from pyspark.sql import types as T

from voxloom.session import hadoop_path, path_exists
from voxloom.streaming import totals
from voxloom.streaming.seen import SeenKeys

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture
def feed(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path / "out"), ["k"], SCHEMA, buckets=4)

    def arrive(*rows):
        if rows:
            spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        seen.run(totals.file_stream(spark, str(tmp_path / "in"), SCHEMA, 1), str(tmp_path / "checkpoint"))
        return sorted((r.k or "", r.v) for r in seen.rows().collect())

    return seen, arrive, tmp_path


def remove(spark, path):
    fs, p = hadoop_path(spark, str(path))
    assert fs.delete(p, True)


def test_first_arrivals_over_runs(spark, feed):
    seen, arrive, _ = feed
    assert arrive(("a", 1), ("b", 2), ("b", 2), (None, 3)) == [("", 3), ("a", 1), ("b", 2)]
    want = [("", 3), ("a", 1), ("b", 2), ("c", 5)]
    assert arrive(("a", 4), ("c", 5), (None, 6)) == want
    assert arrive() == want
    seen.pack()
    assert len(seen._runs("seen", "part=")) == 1 and seen.seen().count() == 4
    assert arrive(("c", 7), ("d", 8)) == [*want, ("d", 8)]


def test_lost_checkpoint_adds_nothing(spark, feed):
    seen, arrive, root = feed
    arrive(("a", 1))
    before = arrive(("b", 2), ("a", 3))
    remove(spark, root / "checkpoint")
    assert arrive() == before
    assert arrive(("c", 4), ("b", 5)) == [*before, ("c", 4)]


def test_batch_that_broke_off(spark, feed):
    """Rows without keys, and keys that never were finished, are written again, by the same checkpoint or a new one."""
    seen, arrive, root = feed
    arrive(("a", 1))
    for keep_checkpoint in (True, False):
        run = [r for r in seen._runs("finished") if not r.startswith("packed")][-1]
        remove(spark, root / "out" / "finished" / run)
        if keep_checkpoint:  # the batch is done again under its name
            seen.add(spark.createDataFrame([("a", 1)], SCHEMA), run)
            assert sorted(r.k for r in seen.rows().collect()) == ["a"]
        else:
            remove(spark, root / "checkpoint")
            assert arrive() == [("a", 1)]


def test_half_written_keys_are_no_seen_keys(spark, feed):
    seen, arrive, root = feed
    arrive(("a", 1))
    seen.spark.createDataFrame([("z", 0)], "k string, bucket int").write.partitionBy("bucket").parquet(str(root / "out" / "seen" / "part=broken"))
    assert arrive(("z", 9)) == [("a", 1), ("z", 9)]
    assert not path_exists(spark, str(root / "out" / "seen" / "part=broken"))


def test_reads_only_the_buckets_of_the_batch(spark, feed):
    seen, arrive, _ = feed
    arrive(*[(f"k{i}", i) for i in range(40)])
    plan = seen.seen([2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.bucket for r in seen.seen([2]).collect()} == {2}


def test_session_settings_stay(spark, feed):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    feed[1](("a", 1))
    assert spark.conf.get(key, None) == before
