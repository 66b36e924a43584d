"""Schemas that differ from file to file: fingerprints of the footers, and reads that respect them.

A scan takes the schema of one file for all.  Here every footer is read where the file lies, files are
grouped by the fingerprint of their schema, and each group is scanned with its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from ..functions import signal as sig
from ..session import path_exists
from ..specs import AUDIO_FIELDS, SourceSpec
from .files import ranges_readable
from .profile import audio_kind
from .scan import literal_path, locate, plain_path, with_origin

FOOTER_SCHEMA = "file string, length long, modified timestamp, n_rows long, fingerprint string, schema string"
#: The audio column of files that hold it in different ways.
AUDIO_STRUCT = "struct<bytes:binary,path:string,array:array<float>,sampling_rate:double>"
MAX_SCHEMAS = 64


def _footer(source) -> tuple[int | None, str | None, str | None]:
    """Rows, fingerprint and Spark schema (null where Spark has no such type); all null if it is no Parquet file."""
    try:
        file = pq.ParquetFile(source)
    except (pa.ArrowException, OSError):
        return None, None, None
    columns = file.schema_arrow.remove_metadata()
    print_of = hashlib.sha256("\n".join(sorted(f"{f.name}: {f.type}" for f in columns)).encode()).hexdigest()
    try:
        schema = from_arrow_schema(columns, prefer_timestamp_ntz=False).json()
    except PySparkException:
        schema = None
    return file.metadata.num_rows, print_of, schema


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        if "content" in batch.schema.names:
            found = [_footer(pa.BufferReader(c.as_buffer())) for c in batch["content"]]
        else:
            for name in batch["file"].to_pylist():
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as f:
                    found.append(_footer(f))
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in ("file", "length", "modified")), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])],
            ["file", "length", "modified", "n_rows", "fingerprint", "schema"])


def footers(spark: SparkSession, path: str | Sequence[str], glob: str = "*.parquet", recursive: bool = False,
            known: str | None = None) -> DataFrame:
    """``file, length, modified, n_rows, fingerprint, schema`` of every file.

    A file that is no Parquet has null in the last three.  Order of columns does not matter to the fingerprint.
    ``known`` names a table that remembers footers by path, length and time: only other files are opened, and
    what they hold is added to it.  A call that fails is made again; what is told twice counts once.
    Storage that Arrow cannot open is read whole, through Spark, one file in a row (up to 2 GB).
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    m = F.col("_metadata")
    files = reader.load(path if isinstance(path, str) else list(path)).select(
        m["file_path"].alias("file"), F.col("length"), F.col("modificationTime").alias("modified"), "content")
    schema = T.StructType.fromDDL(FOOTER_SCHEMA)
    if known is not None and path_exists(spark, known):
        told = spark.read.schema(schema).parquet(known)
        files = files.join(told.select("file", "length", "modified"), ["file", "length", "modified"], "left_anti")
    if ranges_readable(spark, path if isinstance(path, str) else path[0]):
        files = files.drop("content")
    found = files.mapInArrow(_footers, schema)
    if known is None:
        return found
    found.write.mode("append").parquet(known)
    listed = reader.load(path if isinstance(path, str) else list(path)).select(
        m["file_path"].alias("file"), F.col("length"), F.col("modificationTime").alias("modified"))
    told = spark.read.schema(schema).parquet(known).dropDuplicates(["file", "length", "modified"])
    return listed.join(told, ["file", "length", "modified"]).select(*schema.fieldNames())


def schema_groups(found: DataFrame, *keys: str) -> DataFrame:
    """``keys..., fingerprint, schema, n_files, n_rows, example`` per schema that occurs."""
    return found.groupBy(*keys, "fingerprint").agg(
        F.min("schema").alias("schema"), F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("file").alias("example"))


def as_audio_struct(df: DataFrame, name: str, spec: SourceSpec, channel_axis: str = "last") -> Column:
    """Audio of any representation as one struct of bytes, path, samples and rate."""
    col, kind = F.col(name), audio_kind(df.schema[name].dataType)
    none = F.lit(None)
    if kind.endswith("struct"):
        fields = df.schema[name].dataType.fieldNames()
        parts = [col[f] if f in fields else none for f in ("bytes", "path", "array", "sampling_rate")]
    elif kind == "bytes":
        parts = [col, none, none, none]
    elif kind.startswith("list"):
        rate = F.col(spec.rate_col) if spec.rate_col and spec.rate_col in df.columns else F.lit(spec.signal.target_sr)
        parts = [none, none, sig.downmix(col, channel_axis) if kind == "list of lists" else col, rate]
    else:
        raise ValueError(f"source {spec.name}: audio column {name} has an unusable type")
    types = ("binary", "string", "array<float>", "double")
    made = F.struct(*[p.cast(t).alias(n) for p, t, n in zip(parts, types, ("bytes", "path", "array", "sampling_rate"))])
    return F.when(col.isNotNull(), made)


def scan_by_schema(spark: SparkSession, spec: SourceSpec, root: str, known: str | None = None, tolerant: bool = False) -> DataFrame:
    """All raw rows of a source whose files differ in schema, as :func:`voxloom.sources.scan.scan_source` gives them.

    Columns that a file lacks are null; plain types widen as in a union; where audio is held in different ways it
    becomes one struct.  Files that are no Parquet end the read, unless ``tolerant``.  The driver holds the names of
    the files, as Spark's own listing does, and at most :data:`MAX_SCHEMAS` schemas.
    """
    path, recursive = locate(spark, spec, root)
    found = footers(spark, path, recursive=recursive, known=known)
    groups = schema_groups(found).limit(MAX_SCHEMAS + 1).collect()
    if len(groups) > MAX_SCHEMAS:
        raise ValueError(f"source {spec.name} has more than {MAX_SCHEMAS} schemas")
    bad = [g for g in groups if g.schema is None]
    if bad and not tolerant:
        raise ValueError(f"source {spec.name}: {sum(g.n_files for g in bad)} files without a usable schema, such as {bad[0].example}")
    names: dict[str, list[str]] = {}
    for r in found.filter("schema is not null").select("fingerprint", plain_path(F.col("file")).alias("file")).toLocalIterator():
        names.setdefault(r.fingerprint, []).append(r.file)
    parts = []
    for g in groups:
        if g.schema is not None:
            reader = spark.read.schema(T.StructType.fromJson(json.loads(g.schema)))
            if tolerant:
                reader = reader.option("ignoreCorruptFiles", "true")
            parts.append(with_origin(reader.parquet(*map(literal_path, names[g.fingerprint])), spec))
    if not parts:
        raise FileNotFoundError(f"no readable parquet files under {path}")
    audio = next((n for n in (spec.audio_col, *AUDIO_FIELDS) if any(n in p.columns for p in parts)), None)
    if len({p.schema[audio].dataType.simpleString() for p in parts if audio in p.columns}) > 1:
        parts = [p.withColumn(audio, as_audio_struct(p, audio, spec)) if audio in p.columns else p for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
