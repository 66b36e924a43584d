"""Streaming aggregates and de-duplication over file streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def running_totals(stream: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Totals per key so far; state holds one row per key."""
    return stream.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain the available input into batch folders below ``path``; a repeated batch overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last update of every key of a table written in update mode."""
    updates = spark.read.parquet(path)
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(*keys, "_v.*")


def stream_dedup(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """First arrival of every key within ``delay``; older keys are forgotten, so the state stays bounded.

    Keys that have to be known for ever belong in a table: :class:`voxloom.streaming.seen.SeenKeys`.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def observed_totals(df: DataFrame, name: str, **aggregates: Column) -> tuple[DataFrame, Callable[[], dict]]:
    """Live counters of a batch write without a second pass: ``(df, values after the action)``."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in aggregates.items()]), lambda: seen.get
