"""Repair of a built table: first row of every id, checked, in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.dedup import drop_repeats, duplicate_counts
from ..session import audio_batches
from ..sinks.files import replace_in_place
from ..sources.scan import read_keyed


class CheckFailed(ValueError):
    """A built table does not pass its checks."""


def failures(df: DataFrame, target_sr: int = 16000) -> list[str]:
    """Names of failed checks with their counts; empty for a good table."""
    sums = quality.verify_rows(df, quality.row_checks(target_sr)).groupBy("check").agg(F.sum("violations").alias("n"))
    found = [f"{r.check}: {r.n} rows" for r in sums.filter("n > 0").orderBy("check").collect()]
    found += [name for name, ok in quality.verify_schema(df.drop("split")) if not ok]
    if quality.has_repeats(df):
        found.append("utt_id: not unique")
    return found


def require_good(df: DataFrame, target_sr: int = 16000) -> None:
    found = failures(df, target_sr)
    if found:
        raise CheckFailed("; ".join(found))


def dedup_table(spark: SparkSession, path: str, rows_per_file: int = 1024, target_sr: int = 16000) -> dict[str, int]:
    """Keep the first row of every ``utt_id`` and return the counts.

    Files come in the order in which they were written: names of part files say nothing about it.
    """
    counts = duplicate_counts(spark.read.parquet(path).select("utt_id"), ["utt_id"]).head().asDict()
    if counts["removed"]:
        rows = read_keyed(spark, path)
        placed = rows.select(
            "*", F.col("_metadata.file_modification_time").alias("_time"), F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_pos"))
        clean = drop_repeats(placed, ["utt_id"], ["_time", "_file", "_pos"]).drop("_time", "_file", "_pos")
        with audio_batches(spark):
            replace_in_place(spark, path, clean, lambda new: require_good(new, target_sr),
                             rows_per_file=rows_per_file, partition_by=("source", "split"))
    return counts
