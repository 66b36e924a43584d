"""Checks of a built corpus.  Failing on violations is the caller's decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_checks(target_sr: int = 16000) -> dict[str, Column]:
    """Check name -> condition that a good row meets; needs the unified columns."""
    return {
        "sampling_rate": F.col("audio.sampling_rate") == target_sr,
        "duration": F.col("duration") > 0,
        "text": F.col("text") != "",
        "speaker_id": F.col("speaker_id") != "",
        "n_samples": F.col("n_samples") == F.size("audio.array"),
    }


def verify_rows(df: DataFrame, checks: dict[str, Column], keys: Sequence[str] = ("source", "split")) -> DataFrame:
    """``(keys..., check, violations)`` from one aggregation over all rows."""
    counted = df.groupBy(*keys).agg(
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"_{name}") for name, ok in checks.items()]
    )
    # A short literal list per group turns the columns into rows after the aggregation.
    pairs = F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(f"_{name}").alias("violations")) for name in checks
    ])
    return counted.select(*keys, F.explode(pairs).alias("_c")).select(*keys, "_c.check", "_c.violations")


def verify_schema(df: DataFrame) -> list[tuple[str, bool]]:
    """Checks that need the schema only: no split column, no external audio path."""
    audio = df.schema["audio"].dataType if "audio" in df.columns else None
    fields = audio.fieldNames() if isinstance(audio, T.StructType) else []
    return [
        ("no_split_column", "split" not in df.columns),
        ("no_external_path", "path" not in fields),
        ("audio_is_struct", {"array", "sampling_rate"} <= set(fields)),
    ]


def external_paths(df: DataFrame) -> DataFrame:
    """Rows whose audio still points to a file."""
    return df.filter(F.trim(F.coalesce(F.col("audio.path"), F.lit(""))) != "")


def uniqueness(df: DataFrame, column: str = "utt_id") -> DataFrame:
    """One row ``(total, distinct_ids, repeated_ids, is_unique)``.

    Counts per id are combined before the shuffle, so one id with very many
    rows does not become one large task.
    """
    sizes = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
    ).withColumn("is_unique", F.col("repeated_ids") == 0)


def has_repeats(df: DataFrame, column: str = "utt_id") -> bool:
    return bool(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).take(1))
