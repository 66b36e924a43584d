"""Cutting ordered rows into blocks that one task can sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir

BLOCK = "_block"


def range_blocks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``_block``, the range of ``order`` they fall into, whatever its distribution.

    Spark samples the order to cut even ranges.  The sampled bounds could differ
    if the plan ran again, so the rows are kept with their block in the shared
    checkpoint folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.repartitionByRange(*order).withColumn(BLOCK, F.spark_partition_id().cast("long")).checkpoint()


def _seconds(df: DataFrame, ts: str) -> Column:
    """Whole seconds that never run backwards, also where a local clock does."""
    at = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.unix_date(F.to_date(at)) * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.unix_seconds(at)


def time_blocks(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], block_rows: int = 1_000_000) -> DataFrame:
    """Rows with ``_block``: equal spans of time, of about ``block_rows`` rows over all keys.

    If bursts leave a span of one key with many times that, the rows are cut by
    ranges of ``order`` instead.
    """
    second = _seconds(df, ts)
    low, high, n = df.agg(F.min(second), F.max(second), F.count(ts)).head()
    width = max(1, (high - low + 1) * block_rows // n) if n else 1
    cut = df.withColumn(BLOCK, F.call_function("div", (second - F.lit(low or 0)).cast("long"), F.lit(width)))
    largest = cut.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).head()[0] or 0
    return range_blocks(df, [*keys, *order]) if largest > 4 * block_rows else cut
