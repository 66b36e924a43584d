"""Fewer, larger files without moving rows between tasks.

The files of a split are packed into bins by their stored bytes; one task reads the files of a bin one
after the other and writes one file.  Files that are large enough, or alone in their bin, are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import AUDIO_BATCHES, hadoop_path, own_settings

TARGET_BYTES = 1024**3  # half of the largest file allowed, as other columns may be stored less densely
BINS_PER_JOB = 200
#: Small batches of audio; a union keeps one partition for each bin, although all of them are single ones.
SETTINGS = {**AUDIO_BATCHES, "spark.sql.unionOutputPartitioning": "false"}


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """``(path, stored bytes)`` of the files of one folder, by name; no file is opened."""
    fs, p = hadoop_path(spark, folder)
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(p) if s.isFile()]
    return sorted(f for f in found if not f[0].rsplit("/", 1)[-1].startswith(("_", ".")))


def bins(files: Sequence[tuple[str, int]], target: int = TARGET_BYTES) -> list[list[str]]:
    """Files to be joined, largest first into the first bin with room; only bins of two files or more."""
    made: list[tuple[int, list[str]]] = []
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if size >= target:
            continue
        at = next((i for i, (room, _) in enumerate(made) if room >= size), None)
        if at is None:
            made.append((target - size, [path]))
        else:
            made[at][1].append(path)
            made[at] = (made[at][0] - size, made[at][1])
    return [paths for _, paths in made if len(paths) > 1]


def packed_scan(spark: SparkSession, schema: T.StructType, groups: Sequence[Sequence[str]]) -> DataFrame:
    """The rows of all ``groups`` of files, one partition each; nothing is shuffled."""
    own = own_settings(spark, SETTINGS)
    return reduce(DataFrame.unionAll, [own.read.schema(schema).parquet(*files).coalesce(1) for files in groups])


def compact_folder(spark: SparkSession, folder: str, schema: T.StructType, target: int = TARGET_BYTES, rows_per_file: int = 0) -> tuple[int, int]:
    """Join the small files of one folder; return how many were read and written.

    New files come before the old ones go: a run that breaks off leaves rows twice.  Call it on folders that
    are not released yet and can be built again, as a merge does.
    """
    groups = bins(data_files(spark, folder), target)
    fs, _ = hadoop_path(spark, folder)
    for i in range(0, len(groups), BINS_PER_JOB):
        some = groups[i:i + BINS_PER_JOB]
        packed_scan(spark, schema, some).write.mode("append").option("maxRecordsPerFile", rows_per_file).option("compression", "snappy").parquet(folder)
        for path in (f for files in some for f in files):
            fs.delete(hadoop_path(spark, path)[1], False)
    return sum(map(len, groups)), len(groups)
