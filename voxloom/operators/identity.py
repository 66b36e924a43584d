"""Row indices, utterance ids and speaker labels.

An index over a split must not send the whole split through one task, since
one split may hold a third of all rows.  Both forms below count narrow blocks
first and add the block's offset to a position inside the block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import WHITESPACE, falsy_to_empty
from ..session import small_side
from ..specs import SourceSpec
from .blocks import BLOCK, range_blocks
from .joins import null_safe_join


MAX_FILES = 1_000_000  # per-file offsets (about 100 bytes each) are broadcast up to this many files


def block_offsets(blocks: DataFrame, keys: Sequence[str], order: Sequence[str], count: str, offset: str) -> DataFrame:
    """Rows before each block of its key; ``blocks`` holds one row per block."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumn(offset, F.coalesce(F.sum(count).over(w), F.lit(0)).cast("long"))


def with_row_index(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    files: Sequence[str] = (),
    out: str = "row_index",
    block_rows: int = 100_000,
    max_blocks: int = 1_000_000,
) -> DataFrame:
    """Zero-based index of every row within ``keys``, ordered by ``files`` and then by ``position``.

    ``position`` is an integer, unique within ``keys`` and ``files``; a block of
    ``block_rows`` consecutive positions therefore holds at most that many rows,
    whatever the size of its key.  If positions are so sparse that a key would
    have more than ``max_blocks`` blocks, the rows are cut by ranges instead.
    Pass narrow rows.  Null keys are a group of their own; a null position comes first in its key.
    """
    group = [*keys, *files, BLOCK]
    blocked = df.withColumn(BLOCK, F.call_function("div", F.col(position).cast("long"), F.lit(block_rows)))
    per_key = blocked.select(*group).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if (per_key.agg(F.max("n")).head()[0] or 0) > max_blocks:
        group = [*keys, BLOCK]
        blocked = range_blocks(df, [*keys, *files, position])
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*files, position)) - 1
    sizes = blocked.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = block_offsets(sizes, keys, [c for c in group if c not in keys], "_rows", "_offset").drop("_rows")
    # One partitioning by block serves the rank and the join.
    return (
        null_safe_join(blocked.withColumn("_rank", rank), offsets, group)
        .withColumn(out, (F.col("_offset") + F.col("_rank")).cast("long"))
        .drop(BLOCK, "_rank", "_offset")
    )


def with_file_index(df: DataFrame, keys: Sequence[str], file: str = "_file", position: str = "_pos",
                    out: str = "row_index", base: DataFrame | None = None) -> DataFrame:
    """Index from the position of a row in its file: no row is shuffled.

    Needs the file-source columns ``_metadata.file_path`` and
    ``_metadata.row_index``.  Only per-file counts are aggregated; they come from
    a scan that reads no data column.  ``base`` gives a start per key
    (``keys..., base``) for incremental runs.
    """
    counts = df.groupBy(*keys, file).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = block_offsets(counts, keys, [file], "_rows", "_offset").drop("_rows")
    if base is not None:
        offsets = (
            offsets.join(base, list(keys), "left") if keys else offsets.crossJoin(base)
        ).withColumn("_offset", F.col("_offset") + F.coalesce("base", F.lit(0))).drop("base")
    joined = null_safe_join(df, small_side(offsets, MAX_FILES), [*keys, file])
    return joined.withColumn(out, F.col("_offset") + F.col(position)).drop("_offset")


def utt_id(source: Column, split: Column, index: Column) -> Column:
    return F.format_string("%s_%s_%08d", source, split, index)


def id_suffix(ids: Column, prefix: Column) -> Column:
    """Number behind ``prefix``; null for ids of another form."""
    return F.when(F.startswith(ids, prefix), F.substring(ids, F.length(prefix) + 1, F.lit(20)).try_cast("long"))


def next_index(ids: DataFrame, prefix: Column, keys: Sequence[str] = (), column: str = "utt_id") -> DataFrame:
    """First free index behind the ids in use, 0 if there is none."""
    return ids.groupBy(*keys).agg(
        F.coalesce(F.max(id_suffix(F.col(column), prefix)) + 1, F.lit(0)).cast("long").alias("next_index")
    )


def speaker_from_column(raw: Column, source: Column, data_type: str = "string") -> Column:
    """``ds:<label>``, or ``ds:<source>_unknown`` for a missing label."""
    label = F.btrim(falsy_to_empty(raw, data_type), F.lit(WHITESPACE))
    return F.concat(F.lit("ds:"), F.when(label == "", F.concat(source, F.lit("_unknown"))).otherwise(label))


def speaker_from_config(template: str, config: Column) -> Column:
    return F.format_string(template, config)


def speaker_id(spec: SourceSpec, df: DataFrame) -> Column:
    if spec.speaker_rule == "column":
        kind = df.schema[spec.speaker].dataType.typeName()
        return speaker_from_column(F.col(spec.speaker), F.lit(spec.name), kind)
    if spec.speaker_rule == "config":
        return speaker_from_config(spec.speaker, F.col("config"))
    return F.lit(spec.speaker)
