"""Batch build of one source.

One job decodes, measures and gates every row and writes kept and dropped rows
side by side (``_status=kept`` and ``_status=dropped``).  The corpus is the kept
folder, the drop log is read from the narrow columns of the other: audio is
decoded once, written once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import signal as sig
from ..functions import text as txt
from ..functions.arrow_signal import Decoder, bytes_stage, samples_stage
from ..operators import gates, identity
from ..operators.joins import resolve_paths
from ..session import audio_batches
from ..sinks.files import write_drop_log, write_shards
from ..sources.drift import scan_by_schema
from ..sources.profile import audio_field, audio_kind
from ..sources.scan import binary_content, binary_files, scan_source
from ..specs import SignalParams, SourceSpec

UNIFIED_SCHEMA = T.StructType([
    T.StructField("utt_id", T.StringType(), False),
    T.StructField("audio", T.StructType([
        T.StructField("array", T.ArrayType(T.FloatType(), False)),
        T.StructField("sampling_rate", T.IntegerType()),
    ])),
    T.StructField("text", T.StringType()),
    T.StructField("duration", T.FloatType()),
    T.StructField("n_samples", T.IntegerType()),
    T.StructField("speaker_id", T.StringType()),
    T.StructField("snr_db", T.FloatType()),
    T.StructField("rms_db", T.FloatType()),
    T.StructField("num_chars", T.IntegerType()),
    T.StructField("num_words", T.IntegerType()),
    T.StructField("speaking_rate", T.FloatType()),
])


#: What a build writes, folders last.  Read with it, splits stay text and an empty build is an empty table.
STAGED_SCHEMA = T.StructType([
    *UNIFIED_SCHEMA.fields,
    *[T.StructField(c, T.StringType()) for c in ("_file", "reason_code", "reason", "_status", "source", "split")],
])


@dataclass(frozen=True)
class BuildPaths:
    root: str

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def kept(self) -> str:
        return f"{self.root}/rows/_status=kept"

    @property
    def drop_log(self) -> str:
        return f"{self.root}/dropped"


def rebuild_audio(df: DataFrame, flat: str = "audio_flat", rate: str = "sampling_rate") -> DataFrame:
    """Struct column ``audio`` from the flat layout."""
    return df.withColumn("audio", F.struct(F.col(flat).alias("array"), F.col(rate).alias("sampling_rate"))).drop(flat, rate)


def signal_column(df: DataFrame, spec: SourceSpec, keep_samples: bool = True, decoder: Decoder | None = None,
                  channel_axis: str = "last") -> Column:
    """The signal stage for this source; the representation is chosen from the column type, once."""
    name = spec.audio_col if spec.audio_col in df.columns else audio_field(df.schema)
    if name is None:
        raise ValueError(f"source {spec.name} has no audio column")
    col, kind = F.col(name), audio_kind(df.schema[name].dataType)
    if kind == "bytes":
        return bytes_stage(spec.signal, keep_samples, decoder=decoder)(col)
    if kind == "encoded struct":
        return bytes_stage(spec.signal, keep_samples, decoder=decoder)(col["bytes"])
    if kind == "decoded struct":
        fields = df.schema[name].dataType.fieldNames()
        rate = col["sampling_rate"] if "sampling_rate" in fields else None
        decoded = samples_stage(spec.signal, keep_samples)(col["array"], sig.source_rate(rate))
        if "bytes" not in fields:
            return decoded
        encoded = bytes_stage(spec.signal, keep_samples, decoder=decoder)(F.when(col["array"].isNull(), col["bytes"]))
        return F.when(col["array"].isNotNull(), decoded).otherwise(encoded)
    if kind.startswith("list"):
        samples = sig.downmix(col, channel_axis) if kind == "list of lists" else col
        rate = F.col(spec.rate_col) if spec.rate_col else None
        return samples_stage(spec.signal, keep_samples)(samples, sig.source_rate(rate, spec.signal.target_sr))
    raise ValueError(f"source {spec.name}: audio column {name} has an unusable type")


def text_column(df: DataFrame, spec: SourceSpec) -> Column:
    present = [c for c in spec.text_cols if c in df.columns]
    if not present:
        raise ValueError(f"source {spec.name} has none of the text columns {spec.text_cols}")
    if len(spec.text_cols) == 1:
        kind = df.schema[present[0]].dataType.typeName()
        return txt.normalize_text(txt.falsy_to_empty(F.col(present[0]), kind))
    strings = [c for c in present if isinstance(df.schema[c].dataType, T.StringType)]
    return txt.extract_text([F.col(c) for c in strings])


def annotate(raw: DataFrame, spec: SourceSpec, keep_samples: bool = True, decoder: Decoder | None = None) -> DataFrame:
    """Every raw row with its text, speaker, signal metrics and reason; no shuffle.

    Rejected rows keep their metrics but not their waveform.
    """
    carried = [c for c in ("utt_id", "source", "config", "split", "_file", "_pos") if c in raw.columns]
    narrow = raw.select(
        *carried,
        text_column(raw, spec).alias("text"),
        identity.speaker_id(spec, raw).alias("speaker_id"),
        signal_column(raw, spec, keep_samples, decoder).alias("_sig"),
    )
    rows = gates.with_reason(narrow.select(*carried, "text", "speaker_id", "_sig.*"), spec.signal, spec.reason_prefix)
    if keep_samples:
        rows = rows.withColumn("samples", F.when(F.col("reason_code").isNull(), F.col("samples")))
    return rows


def unified_columns(params: SignalParams, rate: Column | None = None) -> list[Column]:
    """The unified schema from annotated rows with an ``utt_id``; ``rate`` where rows have rates of their own."""
    n, rate, text = F.col("n_samples"), F.lit(params.target_sr) if rate is None else rate, F.col("text")
    words = txt.num_words(text)
    return [
        F.col("utt_id"),
        F.struct(F.col("samples").alias("array"), rate.cast("int").alias("sampling_rate")).alias("audio"),
        text,
        sig.duration(n, rate).cast("float").alias("duration"),
        n,
        F.col("speaker_id"),
        F.col("snr_db").cast("float").alias("snr_db"),
        F.col("rms_db").cast("float").alias("rms_db"),
        txt.num_chars(text).cast("int").alias("num_chars"),
        words.cast("int").alias("num_words"),
        txt.speaking_rate(words, n, rate).cast("float").alias("speaking_rate"),
    ]


def index_keys(spec: SourceSpec) -> list[str]:
    return [] if spec.index_scope == "source" else ["split"]


def staged_rows(raw: DataFrame, spec: SourceSpec, decoder: Decoder | None = None, base: DataFrame | None = None,
                extra: Callable[[DataFrame], DataFrame] | None = None, audio_files: DataFrame | str | None = None) -> DataFrame:
    """Unified rows plus ``source, split, reason, _status``, ready to be written.

    ``audio_files`` (a folder, or a table ``path, content``) supplies the bytes of rows that only name a file;
    of a folder only the named files are opened.
    ``extra`` may transform the annotated rows (for example with a row function
    through ``mapInPandas``) before they are routed.
    """
    indexed = identity.with_file_index(raw, index_keys(spec), base=base)
    indexed = indexed.select(
        *raw.columns, identity.utt_id(F.col("source"), F.col("split"), F.col("row_index")).alias("utt_id"))
    if audio_files is not None:
        spark, folder = raw.sparkSession, isinstance(audio_files, str)
        indexed = resolve_paths(indexed, binary_files(spark, audio_files, "*") if folder else audio_files, spec.audio_col,
                                (lambda paths: binary_content(spark, paths)) if folder else None)
    rows = annotate(indexed, spec, decoder=decoder)
    if extra is not None:
        rows = extra(rows)
    return rows.select(
        *unified_columns(spec.signal), "source", "split", "_file", "reason_code", "reason",
        F.when(F.col("reason_code").isNull(), "kept").otherwise("dropped").alias("_status"),
    )


def build(spark: SparkSession, spec: SourceSpec, raw_root: str, out_root: str, smoke: int = 0,
          decoder: Decoder | None = None, extra: Callable[[DataFrame], DataFrame] | None = None,
          audio_files: DataFrame | str | None = None, tolerant: bool = False, by_schema: bool = False) -> BuildPaths:
    """Build a source into ``out_root`` and return where its parts are.

    ``by_schema`` reads each file with its own schema, for sources whose files differ.
    """
    raw = scan_by_schema(spark, spec, raw_root, tolerant=tolerant) if by_schema else scan_source(spark, spec, raw_root, tolerant=tolerant)
    if smoke:
        raw = head_of_files(raw, smoke, ["split"])
    paths = BuildPaths(out_root.rstrip("/"))
    with audio_batches(spark):
        rows = staged_rows(raw, spec, decoder, extra=extra, audio_files=audio_files)
        write_shards(rows, paths.rows, spec.rows_per_file, ("_status", "source", "split"))
    write_drop_log(dropped_rows(spark, paths), paths.drop_log)
    return paths


def head_of_files(raw: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """First ``n`` rows of every split, from its first files alone; no row with audio is sorted or shuffled.

    Which files these are follows from counts of a scan that reads no data column.
    """
    counts = raw.groupBy(*keys, "_file").agg(F.count(F.lit(1)).alias("_rows"))
    first = identity.block_offsets(counts, keys, ["_file"], "_rows", "_before").filter(F.col("_before") < n)
    chosen = first.select("_file", (n - F.col("_before")).alias("_left")).collect()  # at most n files per split
    if not chosen:
        return raw.filter("false")
    # Naming the files lets the scan pass over all others.
    left = F.create_map(*[F.lit(v) for r in chosen for v in (r[0], r[1])])
    return raw.filter(F.col("_file").isin([r[0] for r in chosen])).filter(F.col("_pos") < F.element_at(left, F.col("_file")))


def staged(spark: SparkSession, paths: BuildPaths) -> DataFrame:
    return spark.read.schema(STAGED_SCHEMA).parquet(paths.rows)


def kept_rows(spark: SparkSession, paths: BuildPaths) -> DataFrame:
    """The corpus of a built source, pruned to the kept folder."""
    return staged(spark, paths).filter(F.col("_status") == "kept").drop("_status", "_file", "reason_code", "reason", "batch_id")


def dropped_rows(spark: SparkSession, paths: BuildPaths) -> DataFrame:
    return staged(spark, paths).filter(F.col("_status") == "dropped").select("source", "split", "utt_id", "reason_code", "reason")
