"""What a source holds: columns, audio field and kind, row and length statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import AUDIO_FIELDS


def audio_field(schema: T.StructType, names: Sequence[str] = AUDIO_FIELDS) -> str | None:
    return next((n for n in names if n in schema.fieldNames()), None)


def audio_kind(data_type: T.DataType | None) -> str:
    """How audio is represented, from its type alone."""
    if isinstance(data_type, T.StructType):
        fields = data_type.fieldNames()
        if "array" in fields:
            return "decoded struct"
        if "bytes" in fields:
            return "encoded struct"
        return "unknown"
    if isinstance(data_type, T.BinaryType):
        return "bytes"
    if isinstance(data_type, T.ArrayType):
        return "list of lists" if isinstance(data_type.elementType, T.ArrayType) else "list of floats"
    return "none" if data_type is None else "unknown"


def audio_length(df: DataFrame, field: str | None) -> Column:
    """Samples or bytes per row; null where there is no audio."""
    kind = audio_kind(df.schema[field].dataType) if field else "none"
    if kind == "decoded struct":
        return F.size(F.col(field)["array"])
    if kind == "encoded struct":
        return F.octet_length(F.col(field)["bytes"])
    if kind == "bytes":
        return F.octet_length(field)
    if kind.startswith("list"):
        return F.when(F.col(field).isNotNull(), F.size(field))
    return F.lit(None).cast("int")


def profile(df: DataFrame, name: str, text_col: str | None, audio_names: Sequence[str] = AUDIO_FIELDS) -> DataFrame:
    """One row about a source, from one aggregation over all its rows."""
    field = audio_field(df.schema, audio_names)
    has_text = text_col is not None and text_col in df.columns
    length = audio_length(df, field)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(F.col(text_col).isNotNull() & (F.col(text_col) != "")) if has_text else F.lit(0)).cast("long").alias("n_text"),
        F.count(length).alias("n_audio"),
        F.min(length).cast("long").alias("min_length"),
        F.max(length).cast("long").alias("max_length"),
    ).select(
        F.lit(name).alias("source"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.lit(field).cast("string").alias("audio_field"),
        F.lit(audio_kind(df.schema[field].dataType) if field else "none").alias("audio_kind"),
        F.lit(text_col if has_text else None).cast("string").alias("text_column"),
        "n_rows", "n_text", "n_audio", "min_length", "max_length",
    )
