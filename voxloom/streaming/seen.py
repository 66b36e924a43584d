"""De-duplication of a stream against a table of all keys seen, instead of an operator's state.

Nothing is kept in the executors: the keys lie in the shared folder, bucketed by their hash, and a
micro-batch reads the buckets that its keys fall into.

Layout below ``path``::

    rows/run=<run>/              first arrivals of one micro-batch
    seen/part=<run>/bucket=<n>/  their keys
    seen/part=packed-<id>/...    keys of many runs, after :meth:`SeenKeys.pack`
    finished/<run>               written last: this run's rows and keys are complete

A run is a micro-batch of one checkpoint.  If it is done again, its own rows and keys are replaced.  If the
checkpoint is lost, a new one begins with other run names: what unfinished runs left is removed, all
finished keys are known, and files that were read before add nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import null_safe_join
from ..session import hadoop_path, path_exists, small_side

BUCKETS = 64
MAX_BATCH_KEYS = 500_000  # keys of a batch up to which they go to the table, not the table through a shuffle


class SeenKeys:
    """First arrivals of every key, written to ``path``; keys may be null.  One stream per ``path`` at a time."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.schema, self.buckets = spark, path.rstrip("/"), list(keys), schema, buckets
        self.key_schema = T.StructType([schema[k] for k in self.keys])

    def _runs(self, folder: str, prefix: str = "") -> list[str]:
        fs, p = hadoop_path(self.spark, f"{self.path}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix) and not n.startswith(("_", ".")))

    def _delete(self, relative: str) -> None:
        fs, p = hadoop_path(self.spark, f"{self.path}/{relative}")
        fs.delete(p, True)

    def _finish(self, run: str) -> None:
        fs, p = hadoop_path(self.spark, f"{self.path}/finished/{run}")
        fs.create(p, True).close()

    def _generation(self, checkpoint: str) -> str:
        """A name that lives and goes with the checkpoint."""
        fs, folder = hadoop_path(self.spark, f"{checkpoint}-generation")
        _, offsets = hadoop_path(self.spark, checkpoint)
        if fs.exists(folder) and not fs.exists(offsets):
            fs.delete(folder, True)
        if not fs.exists(folder):
            _, named = hadoop_path(self.spark, f"{checkpoint}-generation/{uuid.uuid4().hex[:12]}")
            fs.create(named, True).close()
        return fs.listStatus(folder)[0].getPath().getName()

    def recover(self) -> None:
        """Remove what runs left that never finished."""
        finished = set(self._runs("finished"))
        for run in self._runs("rows", "run="):
            if run not in finished:
                self._delete(f"rows/run={run}")
        for part in self._runs("seen", "part="):
            if part not in finished:
                self._delete(f"seen/part={part}")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def seen(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Keys of all finished runs with their bucket; naming buckets prunes the folders that are read."""
        schema = T.StructType([*self.key_schema.fields, T.StructField("bucket", T.IntegerType())])
        folders = [f"{self.path}/seen/part={p}" for p in self._runs("seen", "part=")]
        if not folders:
            return self.spark.createDataFrame([], schema)
        # Each part is a root of its own, so that the bucket is the only folder key.
        parts = self.spark.read.schema(schema).option("basePath", f"{self.path}/seen").parquet(*folders).select(*self.keys, "bucket")
        return parts if buckets is None else parts.filter(F.col("bucket").isin(*buckets))

    def add(self, batch: DataFrame, run: str) -> None:
        """Write the rows of ``batch`` whose keys are new, and remember these."""
        self._delete(f"finished/{run}")
        for stale in (f"rows/run={run}", f"seen/part={run}"):
            self._delete(stale)
        first = self._bucketed(batch.dropDuplicates(self.keys))
        asked = first.select(*self.keys, "bucket")
        touched = [r.bucket for r in asked.select("bucket").distinct().collect()]  # at most ``buckets``
        known = null_safe_join(self.seen(touched), small_side(asked, MAX_BATCH_KEYS), [*self.keys, "bucket"], "left_semi") if touched else self.seen([])
        # What is known of a batch is at most the batch.
        new = null_safe_join(first, small_side(known.distinct(), MAX_BATCH_KEYS), [*self.keys, "bucket"], "left_anti")
        rows = f"{self.path}/rows/run={run}"
        new.select(*self.schema.fieldNames()).write.parquet(rows)
        # The keys are those of the rows that were written, whatever a second evaluation would choose.
        self._bucketed(self.spark.read.schema(self.schema).parquet(rows).select(*self.keys)).write.partitionBy("bucket").parquet(f"{self.path}/seen/part={run}")
        self._finish(run)

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Drain the available input."""
        self.recover()
        generation = self._generation(checkpoint)

        def add(batch: DataFrame, batch_id: int) -> None:
            self.add(batch, f"{generation}-{batch_id:08d}")

        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    def rows(self) -> DataFrame:
        """First arrivals so far."""
        if not path_exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows").select(*self.schema.fieldNames())

    def pack(self) -> None:
        """Gather the keys of all parts in one file a bucket; while no stream runs.

        The packed part is finished before the others go; keys that lie in both for a while do no harm.
        """
        old = self._runs("seen", "part=")
        if len(old) < 2:
            return
        part = f"packed-{uuid.uuid4().hex[:12]}"
        self.seen().repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/seen/part={part}")
        self._finish(part)
        for p in old:
            self._delete(f"seen/part={p}")
