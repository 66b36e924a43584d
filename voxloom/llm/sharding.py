"""Shards of near equal bytes by sampled splitters.

Records are ordered by the hash of their text, so equal texts lie together.  A size-weighted sample of
keys gives quantile boundaries of :data:`RANGES` ranges, or of more where they would pass
:data:`RANGE_BYTES`.  A range that holds more than its share, such as a much repeated text, is subdivided
by the hash of the id.  The exact sizes of all ranges (at most twice their number of rows) then place each
range, and running sums inside a range place each record: a shard ends where its share of the bytes ends.

Law: ``bytes``.  No shard differs from the mean by more than the records at its two ends.

Nulls: a null text has no bytes; null ids are ordered first; repeated rows are records of their own, in
any order among themselves; empty texts have size 1; a very long text is one record and may fill a
shard; an empty table gives an empty result.  All columns are returned; result columns take free names
where the input has theirs already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import col, fresh, saved

SHARDS = 8
SAMPLES, RANGES = 8192, 256
#: A range is sorted by one task, so large tables get more ranges (and as many more samples), each of about this size.
RANGE_BYTES, MAX_RANGES = 256 << 20, 65_536


def _ranges(splitters: list[int]):
    edges = np.array(splitters, np.int64)

    def run(keys: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for k in keys:
            yield pa.array(np.searchsorted(edges, k.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    run.__annotations__ = {"keys": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "int")


def splitters(sized: DataFrame, key: str, size: str, total: int, ranges: int = RANGES, samples: int = SAMPLES) -> list[int]:
    """Quantile boundaries from a sample that takes a record with a chance proportional to its size.

    ``samples`` are expected at most, whatever the number of records; the draw is a hash, so a rerun of a
    lost task draws the same.
    """
    draw = F.pmod(F.xxhash64(key, size, F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = sized.filter(draw < F.col(size) * (samples / max(1, total))).select(key).toArrow()
    keys = np.sort(drawn[key].to_numpy())
    if not len(keys):
        return []
    return sorted({int(k) for k in keys[np.arange(1, ranges) * len(keys) // ranges]})


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot`` (place in the shard, from 0)."""
    spark = docs.sparkSession
    text, columns = F.coalesce(col(docs, text_col), F.lit("")), docs.columns
    size, key, part, piece, shard, slot, parts, total_at, row_at, running, row, first = (fresh(docs, n) for n in (
        "size", "_key", "_range", "_piece", "shard", "slot", "_parts", "_bytes", "_rows", "_sum", "_row", "_first"))
    d = docs.withColumns({size: F.octet_length(text).cast("long") + 1, key: F.xxhash64(text)})
    total = d.agg(F.sum(size)).first()[0] or 0
    ranges = min(MAX_RANGES, max(RANGES, total // RANGE_BYTES))
    edges = splitters(d, key, size, total, ranges, SAMPLES // RANGES * ranges)
    d = d.withColumn(part, _ranges(edges)(F.col(key)))
    sums = d.groupBy(part).agg(F.sum(size).alias("b")).collect()  # at most `ranges` rows
    share = max(1, total // ranges)
    split = spark.createDataFrame([(r[0], max(1, -(-r.b // share)) if r.b > 2 * share else 1) for r in sums], f"`{part}` int, `{parts}` long")
    # Bounded by the number of ranges.
    d = d.join(F.broadcast(split), part).withColumn(piece, F.pmod(F.xxhash64(col(docs, id_col)), F.col(parts))).drop(parts)
    counts = sorted(d.groupBy(part, piece).agg(F.sum(size).alias("b"), F.count("*").alias("n")).collect())  # at most 2 * `ranges` rows
    before, b, n = [], 0, 0
    for r in counts:
        before.append((r[0], r[1], b, n))
        b, n = b + r.b, n + r.n
    before = spark.createDataFrame(before, f"`{part}` int, `{piece}` long, `{total_at}` long, `{row_at}` long")
    order = Window.partitionBy(part, piece).orderBy(key, col(docs, id_col), size)
    placed = d.withColumns({running: F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)), row: F.row_number().over(order)})
    placed = placed.join(F.broadcast(before), [part, piece])
    middle = F.col(total_at) + F.col(running) - F.col(size) / 2
    placed = placed.withColumn(shard, F.least(F.floor(middle * shards / F.lit(max(1, total))), F.lit(shards - 1)).cast("int"))
    placed = saved(placed.withColumn(row, F.col(row_at) + F.col(row) - 1).select(
        *[col(docs, c) for c in columns], size, shard, row), "shards")
    starts = placed.groupBy(shard).agg(F.min(row).alias(first))  # one row per shard
    return placed.join(F.broadcast(starts), shard).select(
        *[col(docs, c) for c in columns], size, shard, (F.col(row) - F.col(first)).alias(slot))


def write_shards(sharded: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard, each record once."""
    sharded.write.mode("overwrite").partitionBy(shard).parquet(path)
