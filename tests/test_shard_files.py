"""Shards on a local disk: one file each, no checksum file beside it; folders with older checksum files stay usable."""

from pathlib import Path

from pyspark.sql import functions as F

from voxloom.sinks.files import write_shards


def rows(spark, n, start=0):
    return spark.range(start, start + n, 1, 3).select("id", F.concat(F.lit("s"), F.col("id") % 2).alias("source"), F.repeat(F.lit("x"), 50).alias("text"))


def test_a_shard_is_one_file(spark, tmp_path):
    out = str(tmp_path / "s")
    write_shards(rows(spark, 100), out, 8, ["source"])
    names = [p.name for p in Path(out).rglob("*") if p.is_file()]
    assert not [x for x in names if x.endswith(".crc")]
    per_file = spark.read.parquet(out).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(per_file) == sum(x.endswith(".parquet") for x in names) and max(r["count"] for r in per_file) <= 8
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(100))


def test_beside_and_over_files_with_checksums(spark, tmp_path):
    out = str(tmp_path / "s")
    rows(spark, 10).write.partitionBy("source").parquet(out)
    assert list(Path(out).rglob("*.crc"))
    write_shards(rows(spark, 20, 10), out, 4, ["source"], mode="append")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(30))
    write_shards(rows(spark, 5, 50), out, 4, ["source"])
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(50, 55))
    assert not list(Path(out).rglob("*.crc"))
