"""Writers for corpora and their side outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path
from ..sources.scan import read_keyed

MAX_FILE_BYTES = 2 * 1024**3  # fixed value: largest file of a merged corpus

# On local disks Hadoop's file system writes a checksum file beside each file and, without its native library,
# starts a process for each of the two that sets its mode.  The raw one does neither; Parquet's pages keep their own checksums.
LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_shards(df: DataFrame, path: str, rows_per_file: int, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Snappy Parquet with at most ``rows_per_file`` rows per file and column statistics.

    Rows are written where they are: waveforms do not cross a shuffle.  The limit may make very many
    files, so a file costs no more than its rows and footer.
    """
    # Static: splits that are no longer in the data go, whatever the session prefers.
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static").option("maxRecordsPerFile", rows_per_file).option("compression", "snappy").options(**LOCAL_FILES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def row_bytes(samples: Column, text: Column) -> Column:
    """Upper bound for the stored size of a unified row: 4 bytes per sample, ``text`` bytes of text, scalars."""
    return samples.cast("long") * 4 + text + 256


def rows_within(df: DataFrame, max_bytes: int = MAX_FILE_BYTES, samples: str = "n_samples", text: str = "text", chars: str = "num_chars") -> int:
    """Rows per file that keep every file within ``max_bytes``.

    Where the number of characters was stored at build, no text is read: a character takes 4 bytes at most.
    """
    width = F.coalesce(F.col(chars).cast("long") * 4, F.octet_length(text)) if chars in df.columns else F.octet_length(text)
    widest = df.agg(F.max(row_bytes(F.col(samples), width))).head()[0]
    return max(1, int(max_bytes // widest)) if widest else 1


def write_drop_log(dropped: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines of ``source, split, utt_id, reason``."""
    dropped.select("source", "split", "utt_id", "reason").write.mode("append" if append else "overwrite").json(path)


def embed_bytes(files: DataFrame, content: str = "content", out: str = "audio") -> DataFrame:
    """Audio inline as ``struct<bytes, path>`` with no path, so no outside file is needed."""
    return files.withColumn(out, F.struct(F.col(content).alias("bytes"), F.lit(None).cast("string").alias("path"))).drop(content)


def manifest(keys: DataFrame, key: Column) -> DataFrame:
    """One row ``{"splits": [...]}``; the keys are one per split."""
    return keys.select(key.alias("k")).distinct().agg(
        F.to_json(F.struct(F.sort_array(F.collect_list("k")).alias("splits"))).alias("manifest"))


def replace_in_place(spark: SparkSession, path: str, new_rows: DataFrame, check=None, **write) -> None:
    """Replace the table at ``path`` by ``new_rows``, which may read from it.

    The new table is complete and checked beside the old one before two renames
    swap them; a failure before that leaves the old table as it was.
    """
    path = path.rstrip("/")
    tag = uuid.uuid4().hex[:8]
    staging, retired = f"{path}.new-{tag}", f"{path}.old-{tag}"
    write_shards(new_rows, staging, **{"rows_per_file": 0, **write})
    if check is not None:
        check(read_keyed(spark, staging))
    fs, current = hadoop_path(spark, path)
    _, new = hadoop_path(spark, staging)
    _, old = hadoop_path(spark, retired)
    if fs.exists(current) and not fs.rename(current, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, current):
        fs.rename(old, current)
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)
