"""Merging built sources into one corpus partitioned by source and split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import without_existing
from ..session import hadoop_path, path_exists
from ..sinks.files import manifest, rows_within, write_shards
from .compact import TARGET_BYTES, compact_folder

KEYS = ("source", "split")
KEY_SCHEMA = "source string, split string"
#: Finished splits, one JSON line each, written after their rows; readers of the corpus pass over ``_`` folders.
FINISHED = "_merged/splits"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder name of a null key


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """All sources as one table; the redundant rate column goes, missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.drop("sampling_rate") for p in parts])


def split_key(df: DataFrame):
    return F.concat_ws("_", "source", "split")


def split_folders(spark: SparkSession, path: str) -> dict[tuple, object]:
    """``(source, split)`` and folder of every split below ``path``, from folder names; no file is opened."""
    fs, root = hadoop_path(spark, path)

    def below(folder, key: str):
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(f"{key}="):
                value = name.removeprefix(f"{key}=")
                yield None if value == NO_VALUE else unquote(value), status.getPath()

    if not fs.exists(root):
        return {}
    return {(a, b): p for a, folder in below(root, "source") for b, p in below(folder, "split")}


def existing_keys(spark: SparkSession, path: str) -> DataFrame:
    """Finished ``(source, split)`` pairs: those recorded, or all folders where no merge has kept a record."""
    if path_exists(spark, f"{path}/{FINISHED}"):
        return spark.read.schema(KEY_SCHEMA).json(f"{path}/{FINISHED}").distinct()
    return spark.createDataFrame(list(split_folders(spark, path)), KEY_SCHEMA)


def _record(spark: SparkSession, path: str, keys: list[tuple]) -> None:
    spark.createDataFrame(keys, KEY_SCHEMA).coalesce(1).write.mode("append").option("ignoreNullFields", "false").json(f"{path}/{FINISHED}")


def merge_corpus(spark: SparkSession, parts: Sequence[DataFrame], path: str, compact: bool = False, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Append the splits that ``path`` does not hold yet and return its manifest.

    A split counts as held once it is recorded, which comes last; folders that a
    merge left before that are removed and their splits written again.  One merge
    per corpus at a time.  Files stay within 2 GB by a row limit derived from the
    widest row.  Nothing is shuffled: rows are written where they are read, and
    ``compact`` then joins the small files of each new split, a bin of
    ``target_bytes`` a task, before the split is recorded.
    """
    path = path.rstrip("/")
    if not path_exists(spark, f"{path}/{FINISHED}"):
        _record(spark, path, list(split_folders(spark, path)))
    finished = existing_keys(spark, path)
    known = {tuple(r) for r in finished.collect()}  # one row per split
    fs, _ = hadoop_path(spark, path)
    for key, folder in split_folders(spark, path).items():
        if key not in known:
            fs.delete(folder, True)
    rows = without_existing(union_sources(parts), finished, KEYS)
    limit = rows_within(rows)
    write_shards(rows, path, limit, KEYS, mode="append")
    new = {k: folder.toString() for k, folder in split_folders(spark, path).items() if k not in known}
    if compact:
        columns = T.StructType([f for f in rows.schema if f.name not in KEYS])
        for folder in new.values():
            compact_folder(spark, folder, columns, target_bytes, limit)
    _record(spark, path, list(new))
    saved = existing_keys(spark, path)
    return manifest(saved, split_key(saved))
