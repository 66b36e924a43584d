"""Incremental, resumable build of a source with a file stream.

The stream's checkpoint decides which files belong to which batch.  The stream
itself carries file names; each batch is then planned as an ordinary scan of its
files, with column pruning.

Every output of a batch lies in a folder named after the batch and is written
by overwriting it, so a batch that is run again after a failure leaves the same
rows.  A batch is finished when its progress is written, which comes last: one
row per file with the rows it holds, the rows read and the next free index.  Ids
go on from there.

If the checkpoint is lost, finished batches stay as they are: their files are
passed over, new batches get new numbers, and what an unfinished batch left is
removed before its files are read again.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrow_signal import Decoder
from ..plans.build import STAGED_SCHEMA, index_keys, staged_rows
from ..plans.report import duration_ticks, progress_totals
from ..session import audio_batches, hadoop_path, path_exists
from ..sinks.files import write_drop_log, write_shards
from ..sources.scan import literal_path, locate, scan_parquet, with_origin
from ..specs import SourceSpec

BATCH = T.StructField("batch_id", T.LongType())
PROGRESS_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("split", T.StringType()), T.StructField("file", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("rows_held", "rows_in", "kept", "dropped", "ticks", "next_index")], BATCH])


class IncrementalBuild:
    def __init__(self, spark: SparkSession, spec: SourceSpec, raw_root: str, out_root: str,
                 schema: T.StructType | None = None, files_per_batch: int = 256, decoder: Decoder | None = None,
                 tolerant: bool = False, extra: Callable[[DataFrame], DataFrame] | None = None,
                 audio_files: DataFrame | str | None = None):
        """``tolerant`` skips unreadable files; they stay in :meth:`remaining_files`, and files read in part
        in :meth:`incomplete_files`.  ``extra`` and ``audio_files`` are those of a batch build."""
        self.spark, self.spec, self.decoder, self.tolerant = spark, spec, decoder, tolerant
        self.extra, self.audio_files = extra, audio_files
        self.raw_root, self.out, self.files_per_batch = raw_root, out_root.rstrip("/"), files_per_batch
        self.folder, self.recursive = locate(spark, spec, raw_root)
        self.schema = schema or scan_parquet(spark, self.folder, None, self.recursive, tolerant).schema

    def _path(self, part: str, batch_id: int | None = None) -> str:
        return f"{self.out}/{part}" if batch_id is None else f"{self.out}/{part}/batch_id={batch_id}"

    def _remove(self, path: str) -> None:
        fs, p = hadoop_path(self.spark, path)
        fs.delete(p, True)

    def run(self, force: bool = False) -> None:
        """Process the files that have arrived since the last run, then return.

        ``force`` forgets the checkpoint and what was built with it, so no rows
        of an earlier build can remain.
        """
        if force:
            for part in ("checkpoint", "start", "rows", "drop_log", "progress"):
                self._remove(self._path(part))
        self._recover()
        reader = (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", self.files_per_batch).option("pathGlobFilter", "*.parquet")
            .option("ignoreCorruptFiles", str(self.tolerant).lower())
        )
        if self.recursive:
            reader = reader.option("recursiveFileLookup", "true")
        names = reader.parquet(self.folder).select(F.col("_metadata.file_path").alias("_file"))
        query = (
            names.writeStream.foreachBatch(self._process)
            .option("checkpointLocation", self._path("checkpoint")).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def _recover(self) -> None:
        """Where the stream starts anew over finished batches, keep them and number on from the last."""
        if path_exists(self.spark, self._path("checkpoint")):
            return
        finished = {r[0] for r in self.progress().select("batch_id").distinct().collect()}  # one number per batch
        for part in ("rows", "drop_log"):
            fs, p = hadoop_path(self.spark, self._path(part))
            for folder in fs.listStatus(p) if fs.exists(p) else ():
                name = folder.getPath().getName()
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) not in finished:
                    fs.delete(folder.getPath(), True)
        # Written before the checkpoint exists, so a run that fails in between starts here again.
        first = max(finished) + 1 if finished else 0
        self.spark.range(1).select(F.lit(first).cast("long").alias("first")).coalesce(1).write.mode("overwrite").json(self._path("start"))

    def _first_batch(self) -> int:
        if not path_exists(self.spark, self._path("start")):
            return 0
        return self.spark.read.schema("first long").json(self._path("start")).head()[0]

    def _process(self, batch: DataFrame, stream_batch: int) -> None:
        first = self._first_batch()
        batch_id = first + stream_batch
        if first:
            done = self.progress().filter(F.col("batch_id") < first).select(F.col("file").alias("_file")).distinct()
            batch = batch.join(done, "_file", "left_anti")
        # At most files_per_batch names.
        files = [literal_path(unquote(r[0])) for r in batch.distinct().collect()]
        if not files:
            return
        raw = with_origin(scan_parquet(self.spark, files, self.schema, tolerant=self.tolerant), self.spec)
        rows = staged_rows(raw, self.spec, self.decoder, self._base(batch_id), self.extra, self.audio_files)
        with audio_batches(self.spark):
            write_shards(rows, self._path("rows", batch_id), self.spec.rows_per_file, ("_status", "source", "split"))
        written = self.spark.read.schema(STAGED_SCHEMA).parquet(self._path("rows", batch_id))
        write_drop_log(written.filter(F.col("_status") == "dropped"), self._path("drop_log", batch_id))
        self._write_progress(batch_id, raw, written)

    def _base(self, batch_id: int) -> DataFrame | None:
        """Next free index per index scope after the earlier batches."""
        earlier = self.progress().filter(F.col("batch_id") < batch_id)
        return earlier.groupBy(*index_keys(self.spec)).agg(F.max("next_index").alias("base"))

    def _write_progress(self, batch_id: int, raw: DataFrame, written: DataFrame) -> None:
        """One row per file: rows by its footer, and scalar columns of what was written."""
        ok = F.col("_status") == "kept"
        keys = ["source", "split", "file"]
        held = raw.groupBy("source", "split", F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("rows_held"))
        found = written.groupBy("source", "split", F.col("_file").alias("file")).agg(
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(ok).alias("kept"),
            F.count_if(~ok).alias("dropped"),
            F.sum(F.when(ok, duration_ticks(F.col("duration")))).alias("ticks"),
            (F.max(F.substring_index("utt_id", "_", -1).cast("long")) + 1).alias("next_index"),
        )
        counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_in", "kept", "dropped", "ticks", "next_index")]
        (
            held.join(found, keys, "left").select(*keys, "rows_held", *counts)
            .coalesce(1).write.mode("overwrite").parquet(self._path("progress", batch_id))
        )

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        if not path_exists(self.spark, self._path(part)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(part))

    def rows(self) -> DataFrame:
        return self._read("rows", T.StructType([*STAGED_SCHEMA.fields, BATCH]))

    def kept(self) -> DataFrame:
        return self.rows().filter(F.col("_status") == "kept").drop("_status", "_file", "reason_code", "reason", "batch_id")

    def dropped(self) -> DataFrame:
        return self.rows().filter(F.col("_status") == "dropped").select("source", "split", "utt_id", "reason")

    def progress(self) -> DataFrame:
        return self._read("progress", PROGRESS_SCHEMA)

    def totals(self) -> DataFrame:
        """Running totals per source in file order."""
        return progress_totals(self.progress(), ["batch_id", "file"])

    def incomplete_files(self) -> DataFrame:
        """``file, rows_held, rows_in`` of files of which a tolerant build could not read every row."""
        return self.progress().filter("rows_in < rows_held").select("file", "rows_held", "rows_in")

    def remaining_files(self) -> DataFrame:
        """Raw files no finished batch has read; names only."""
        from ..operators.joins import remaining
        from ..sources.files import list_files

        present = list_files(self.spark, self.folder, recursive=self.recursive)
        return remaining(present, self.progress(), ["file"])
