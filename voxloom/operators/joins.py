"""Joins of metadata, audio, progress and configuration."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialized, small_side

#: From paths to ``path, content`` of these files alone.
Loader = Callable[[list[str]], DataFrame]
#: Rows and bytes (as JSON) of narrow rows that are broadcast at once.
CHUNK_ROWS, CHUNK_BYTES = 200_000, 64 << 20


def pair_audio(meta: DataFrame, audio: DataFrame, on: Sequence[str] | str = "id") -> DataFrame:
    """Metadata with its audio.  Ids are unique on both sides, so a shuffle join has no hot key.

    Pass measured scalars instead of waveforms wherever the samples are not
    needed afterwards: only what is selected here crosses the shuffle.
    """
    return meta.join(audio, on, "inner")


def content_chunks(rows: DataFrame, key: str, files: DataFrame, load: Loader | None = None,
                   max_rows: int = CHUNK_ROWS, max_bytes: int = CHUNK_BYTES) -> Iterator[DataFrame]:
    """``rows`` with the ``content`` of the file whose ``path`` is in ``key``, in as many frames as needed.

    Contents never cross a shuffle: the narrow rows are counted and measured where they are, cut into chunks
    of at most about ``max_rows`` rows and ``max_bytes``, and each chunk is broadcast against the files.  Rows
    of one key that would overfill a chunk are dealt over all.  With ``load`` each chunk reads its own files
    only, so every content is read once (that of a dealt key once a chunk); without it every chunk scans ``files``.
    """
    narrow = materialized(rows, "asked")
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in narrow.columns])))
    n, n_bytes = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).head()
    if not n:
        return
    chunks = max(-(-n // max_rows), -(-n_bytes // max_bytes))
    if chunks > 1:
        chunks *= 2  # hashed keys fill chunks unevenly
        often = narrow.groupBy(key).count().filter(F.col("count") > max(1, n // chunks // 4)).select(key, F.lit(True).alias("_often"))  # at most 4 a chunk
        dealt = narrow.withColumn("_row", F.monotonically_increasing_id()).join(F.broadcast(often), key, "left")
        place = F.when(F.col("_often"), F.col("_row")).otherwise(F.xxhash64(key))
        narrow = materialized(dealt.withColumn("_chunk", F.pmod(place, F.lit(chunks)).cast("int")).drop("_row", "_often"), "chunks", ["_chunk"])
    for i in range(chunks):
        part = narrow if chunks == 1 else narrow.filter(F.col("_chunk") == i).drop("_chunk")
        at = files
        if load is not None:
            paths = [r[0] for r in part.select(key).distinct().collect()]  # within the bound of a chunk
            if not paths:
                continue
            at = load(paths)
        yield at.select(F.col("path").alias(key), "content").join(F.broadcast(part), key).select(*rows.columns, "content")


def resolve_paths(rows: DataFrame, files: DataFrame, audio: str = "audio", load: Loader | None = None,
                  max_rows: int = CHUNK_ROWS, max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Fill the bytes of rows that only name a file, from ``files (path, content)``.

    A row's path is compared as it stands with the end of the files' paths; if no
    file ends so, its base name counts, but only if one file has it.  A name that
    several files share is no match: the row keeps no bytes, and is not repeated.
    Rows that already hold bytes, or name no file, take no part in the join; the
    others are taken out once, without their audio.  See :func:`content_chunks`;
    beyond one chunk the filled rows are written to the shared folder chunk by chunk.
    """
    holds = F.octet_length(f"{audio}.bytes") > 0
    needs = F.coalesce(~holds, F.lit(True)) & F.coalesce(F.trim(f"{audio}.path") != "", F.lit(False))
    others = [c for c in rows.columns if c != audio]
    asked = F.regexp_replace("_path", "^(?:\\./|/)+", "")
    narrow = materialized(rows.filter(needs).select(*others, F.col(f"{audio}.path").alias("_path")).withColumn("_asked", asked), "paths")
    wanted = narrow.select("_asked").distinct()
    depth = F.size(F.split("_asked", "/"))
    depths = sorted({1} | {r[0] for r in wanted.select(depth).distinct().collect()})  # as many as folders are deep
    # Ends of the files' paths, counted before the join: a base name that many files share is one row.
    ends = files.select("path", F.explode(F.array(*[F.substring_index("path", "/", -n) for n in depths])).alias("_end"))
    ends = ends.distinct().groupBy("_end").agg(F.count(F.lit(1)).alias("_n"), F.min("path").alias("_match"))
    by_name = ends.select(F.col("_end").alias("_name"), F.col("_n").alias("_n_named"), F.col("_match").alias("_named"))
    matched = (
        wanted.withColumn("_name", F.substring_index("_asked", "/", -1))
        .join(ends, F.col("_asked") == F.col("_end"), "left").join(by_name, "_name", "left")
        .select("_asked", F.when(F.col("_n") == 1, F.col("_match")).when(F.col("_n").isNull() & (F.col("_n_named") == 1), F.col("_named")).alias("_found"))
        .filter("_found IS NOT NULL")
    )
    found = narrow.join(matched, "_asked", "left")

    def filled(content: Column) -> Column:
        kind = rows.schema[audio].dataType
        return F.struct(*[(content if f.name == "bytes" else F.col("_path") if f.name == "path" else F.lit(None).cast(f.dataType)).alias(f.name)
                          for f in kind]).alias(audio)

    def whole(df: DataFrame, content: Column) -> DataFrame:
        return df.select(*[filled(content) if c == audio else F.col(c) for c in rows.columns])

    chunks = [whole(c, F.col("content")) for c in content_chunks(found.filter("_found IS NOT NULL"), "_found", files, load, max_rows, max_bytes)]
    if len(chunks) > 1:
        chunks = [materialized(c, "filled") for c in chunks]
    return reduce(DataFrame.unionByName, [rows.filter(~needs), whole(found.filter("_found IS NULL"), F.lit(None).cast("binary")), *chunks])


def missing_audio(meta: DataFrame, audio: DataFrame, on: Sequence[str] | str = "id") -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    return meta.join(audio.select(*keys), keys, "left_anti")


def remaining(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work items (files, or configuration and split) not finished yet."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def without_existing(rows: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of splits that are not saved yet.

    The saved keys are few (one per split directory); up to the checked bound
    they are broadcast, so a hot split is filtered where it is read.
    """
    return null_safe_join(rows, small_side(existing.select(*keys).distinct(), 10_000), keys, "left_anti")


def apply_registry(rows: DataFrame, registry: DataFrame, on: Sequence[str] | str = "source") -> DataFrame:
    """Attach the settings of each row's source; the registry holds one row per source.

    No row is lost: a source that the registry does not know, or a null one, fails the query with its name,
    whatever is selected afterwards.  The filter stays in every plan that counts or passes on rows; the check
    in each attached column keeps later filters on it from turning the join into an inner one.
    """
    keys = [on] if isinstance(on, str) else list(on)
    mark = "_known"
    joined = null_safe_join(rows, small_side(registry.withColumn(mark, F.lit(True)), 10_000), keys, "left")
    unknown = F.raise_error(F.concat(F.lit("no settings for "), F.to_json(F.struct(*keys))))
    checked = joined.filter(F.coalesce(F.col(mark), unknown.cast("boolean")))
    attached = {c: F.when(F.col(mark), F.col(c)).otherwise(unknown) for c in registry.columns if c not in keys}
    return checked.withColumns(attached).drop(mark)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])
