"""File listings and unreadable files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_path, path_exists
from .scan import literal_path, plain_path

MAGIC = b"PAR1"  # fixed value: last bytes of a Parquet file


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*.parquet", recursive: bool = False) -> DataFrame:
    """``(file, length)`` without opening the files."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select(F.col("_metadata.file_path").alias("file"), "length")


def read_tolerant(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """All readable rows; unreadable files are skipped and show up in :func:`corrupt_files`."""
    return (
        spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*([path] if isinstance(path, str) else path))
    )


def ranges_readable(spark: SparkSession, path: str) -> bool:
    """Whether workers can read parts of the files themselves; files of other storage are read through Spark."""
    store, p = hadoop_path(spark, path)
    try:
        fs.FileSystem.from_uri(store.getUri().toString() + "/")
    except (pa.ArrowException, OSError, ValueError):
        return False
    return p is not None


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each named file ends with the mark; only those bytes are read."""
    for batch in batches:
        complete = []
        for name in batch["file"].to_pylist():
            store, path = fs.FileSystem.from_uri(name)
            with store.open_input_file(path) as f:
                f.seek(max(0, f.size() - len(MAGIC)))
                complete.append(f.read(len(MAGIC)) == MAGIC)
        yield pa.RecordBatch.from_arrays([batch["file"], pa.array(complete, pa.bool_())], ["file", "complete"])


def _end_marks(spark: SparkSession, doubtful: DataFrame, by_ranges: bool) -> DataFrame:
    """``file, complete`` of the files in doubt; Spark reads them where the workers cannot (their names pass the driver)."""
    if by_ranges:
        return doubtful.mapInArrow(_whole, "file string, complete boolean")
    names = [literal_path(r[0]) for r in doubtful.select(plain_path(F.col("file"))).toLocalIterator()]
    if not names:
        return spark.createDataFrame([], "file string, complete boolean")
    return spark.read.format("binaryFile").load(names).select(
        F.col("_metadata.file_path").alias("file"), (F.substring("content", -len(MAGIC), len(MAGIC)) == F.lit(MAGIC)).alias("complete"))


def corrupt_files(spark: SparkSession, path: str | list[str], schema: T.StructType | str, glob: str = "*") -> DataFrame:
    """``(file, length, state, n_rows)`` for every file; nothing is deleted.

    ``n_rows`` are the rows that can be read, found by decoding every column, as a
    whole footer may stand over broken pages: a file that gives fewer rows than
    its footer names is ``partial``, or ``corrupt`` if it gives none.  Of files
    without rows the last bytes tell empty ones from broken ones.  Files of no
    bytes are passed over, as Spark lists none.
    """
    rows = read_tolerant(spark, path, schema)
    file = F.col("_metadata.file_path").alias("file")
    held = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n_held"))
    # The hash makes the scan decode all columns; its maximum is null for no file that gives rows.
    decoded = F.max(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).isNotNull()
    read = rows.groupBy(file).agg(F.when(decoded, F.count(F.lit(1))).alias("n_rows"))
    listed = list_files(spark, path, glob)
    ends = _end_marks(spark, listed.join(held, "file", "left_anti").select("file"),
                      ranges_readable(spark, path if isinstance(path, str) else path[0]))
    n_rows, n_held = F.coalesce("n_rows", F.lit(0)), F.coalesce("n_held", F.lit(0))
    state = (
        F.when((n_held > 0) & (n_rows >= n_held), "readable").when(n_rows > 0, "partial")
        .when(F.coalesce("complete", F.lit(False)), "empty").otherwise("corrupt")
    )
    return (
        listed.join(held, "file", "left").join(read, "file", "left").join(ends, "file", "left")
        .select("file", "length", state.alias("state"), n_rows.alias("n_rows"))
    )


VERDICT_SCHEMA = "file string, length long, modified timestamp, state string, n_rows long"


def checked_files(spark: SparkSession, path: str | list[str], schema: T.StructType | str, known: str, glob: str = "*") -> DataFrame:
    """:func:`corrupt_files` that remembers: ``file, length, modified, state, n_rows`` of every file.

    ``known`` names a table of verdicts by path, length and modification time.  Only files that it lacks are opened;
    their verdicts are added.  A call that fails is made again; what is told twice counts once.  The names of
    new files pass the driver, as in Spark's own listing.
    """
    keys = ["file", "length", "modified"]
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        .select(F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified")))

    def told() -> DataFrame:
        if not path_exists(spark, known):
            return spark.createDataFrame([], VERDICT_SCHEMA)
        return spark.read.schema(VERDICT_SCHEMA).parquet(known).dropDuplicates(keys)

    new = listed.join(told(), keys, "left_anti")
    names = [literal_path(r[0]) for r in new.select(plain_path(F.col("file"))).toLocalIterator()]
    if names:
        found = corrupt_files(spark, names, schema, glob).join(new.select("file", "modified"), "file")
        found.select(*keys, "state", "n_rows").write.mode("append").parquet(known)
    return listed.join(told(), keys)
