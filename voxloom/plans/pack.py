"""Metadata lines and a folder of audio files to one self-contained table."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.joins import CHUNK_BYTES, CHUNK_ROWS, content_chunks, missing_audio, pair_audio
from ..session import audio_batches, hadoop_path, path_exists
from ..sinks.files import embed_bytes, write_shards
from ..sources.metadata import read_metadata
from ..sources.scan import binary_content, binary_files


def pack(spark: SparkSession, metadata: str, audio_dir: str, out: str, glob: str = "*.wav", rows_per_file: int = 1024,
         max_rows: int = CHUNK_ROWS, max_bytes: int = CHUNK_BYTES) -> int | None:
    """Write ``audio struct<bytes, path>, sentence`` rows; return how many records have no file.

    Does nothing and returns ``None`` if ``out`` exists.  Ids meet in a join of names alone; each chunk of
    records then goes to its own files, which are read once and where they are.  The table is complete before
    it gets its name, so a run that breaks off is no finished one.
    """
    out = out.rstrip("/")
    if path_exists(spark, out):
        return None
    records = read_metadata(spark, metadata)
    sounds = binary_files(spark, audio_dir, glob).select("id", "path", "content")
    paired = pair_audio(records, sounds.select("id", F.col("path").alias("file"))).select("file", F.col("text").alias("sentence"))
    staging = f"{out}.new-{uuid.uuid4().hex[:8]}"
    with audio_batches(spark):
        spark.createDataFrame([], "audio struct<bytes:binary,path:string>, sentence string").write.parquet(staging)
        for chunk in content_chunks(paired, "file", sounds, lambda paths: binary_content(spark, paths), max_rows, max_bytes):
            write_shards(embed_bytes(chunk.select("content", "sentence")), staging, rows_per_file, mode="append")
    fs, new = hadoop_path(spark, staging)
    if not fs.rename(new, hadoop_path(spark, out)[1]):
        raise OSError(f"cannot name the new table {out}")
    return missing_audio(records, sounds.select("id")).count()
