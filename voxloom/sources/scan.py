"""Scans of raw and built files as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import hadoop_path
from ..specs import REGISTRY, SourceSpec


def _matches(spark: SparkSession, pattern: str) -> bool:
    fs, p = hadoop_path(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def discover(spark: SparkSession, root: str) -> tuple[str, bool]:
    """``(folder, recursive)`` that holds Parquet files: ``data/``, the folder itself, any depth."""
    root = root.rstrip("/")
    for folder in (f"{root}/data", root):
        if _matches(spark, f"{folder}/*.parquet"):
            return folder, False
    fs, p = hadoop_path(spark, root)
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                return root, True
    raise FileNotFoundError(f"no parquet files under {root}")


def scan_parquet(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType | str | None = None,
                 recursive: bool = False, tolerant: bool = False) -> DataFrame:
    """Many files as one table; with a schema no file is opened for inference.

    ``tolerant`` skips unreadable files; :func:`voxloom.sources.files.corrupt_files` names them.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def file_stem() -> Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")


def split_from_file() -> Column:
    """File name up to its first dash (without the extension)."""
    return F.substring_index(file_stem(), "-", 1)


def plain_path(uri: Column) -> Column:
    """A path as people write it; ``_metadata.file_path`` is percent-encoded, but for its plus signs."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """``path`` for a reader that would take brackets, braces, stars and question marks for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def config_from_file() -> Column:
    """Name of the folder that holds the file; ``key=value`` folders give the value."""
    return F.regexp_extract(plain_path(F.col("_metadata.file_path")), r"/(?:[^/=]+=)?([^/]+)/[^/]+$", 1)


def config_short(config: Column, short: dict[str, str]) -> Column:
    """Short name of a configuration, itself where none is registered."""
    if not short:
        return config
    pairs = F.create_map(*[F.lit(v) for pair in short.items() for v in pair])
    return F.coalesce(F.element_at(pairs, config), config)


def split_for(spec: SourceSpec) -> Column:
    if spec.split_rule == "constant":
        return F.lit(spec.split)
    if spec.split_rule == "config":
        return F.concat_ws("_", config_short(config_from_file(), spec.configs), split_from_file())
    return split_from_file()


def locate(spark: SparkSession, spec: SourceSpec, root: str) -> tuple[str, bool]:
    """``(path or pattern, recursive)`` of a source's raw files; an error if there are none."""
    base = f"{root.rstrip('/')}/{spec.path}"
    if spec.split_rule != "config":
        return discover(spark, base)
    if not _matches(spark, f"{base}/*/*.parquet"):
        raise FileNotFoundError(f"no parquet files under {base}")
    return f"{base}/*", False


def with_origin(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Raw rows with ``source, config, split, _file, _pos``.

    ``_pos`` is the row's place in its file as the Parquet reader knows it, so it
    does not depend on how the file is split into tasks.
    """
    config = config_from_file() if spec.split_rule == "config" else F.lit(None).cast("string")
    return raw.select(
        *[c for c in raw.columns if c not in ("source", "config", "split")],
        F.lit(spec.name).alias("source"), config.alias("config"), split_for(spec).alias("split"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"),
    )


def scan_source(spark: SparkSession, spec: SourceSpec, root: str, schema: T.StructType | str | None = None,
                tolerant: bool = False) -> DataFrame:
    """All raw rows of a source; only columns used later are read."""
    path, recursive = locate(spark, spec, root)
    return with_origin(scan_parquet(spark, path, schema, recursive, tolerant), spec)


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str] = ("source", "split")) -> DataFrame:
    """A saved table whose ``keys`` are text: as a folder name, split ``001`` would be read as the number 1."""
    schema = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([
        T.StructField(f.name, T.StringType(), f.nullable) if f.name in keys else f for f in schema])).parquet(path)


def read_corpus(spark: SparkSession, path: str, source: str | None = None, split: str | None = None) -> DataFrame:
    """A built corpus; naming a source or split prunes the folders that are listed and read."""
    df = read_keyed(spark, path)
    if source is not None:
        df = df.filter(F.col("source") == source)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df


def iterate(df: DataFrame) -> Iterator[Row]:
    """Rows for a consumer outside Spark, one partition at a time in memory."""
    return df.toLocalIterator(prefetchPartitions=True)


def head_per_split(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First ``n`` rows of every split; each task passes on at most ``n`` rows per split."""
    from pyspark.sql.window import Window as W

    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def binary_files(spark: SparkSession, path: str, glob: str = "*.wav", id_column: str = "id") -> DataFrame:
    """Files as ``(id, path, length, content)``; content is read only if selected."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        .select(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias(id_column), "path", "length", "content")
    )


def binary_content(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, content`` of the named files alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load([literal_path(p) for p in paths]).select("path", "content")


REGISTRY_SCHEMA = (
    "source string, path string, text_cols array<string>, audio_col string, rate_col string, audio_kind string, "
    "codec string, speaker_rule string, speaker string, split_rule string, index_scope string, rows_per_file int, "
    "target_sr int, min_s double, max_s double, clip_amp double, clip_ms double, min_run int")


def registry_frame(spark: SparkSession, registry: Sequence[SourceSpec] = REGISTRY) -> DataFrame:
    """The registry as rows, one per source."""
    names = [c.split()[0] for c in REGISTRY_SCHEMA.split(", ")]
    rows = [
        {
            n: s.name if n == "source" else list(s.text_cols) if n == "text_cols"
            else getattr(s, n) if hasattr(s, n) else getattr(s.signal, n)
            for n in names
        }
        for s in registry
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows), REGISTRY_SCHEMA)
