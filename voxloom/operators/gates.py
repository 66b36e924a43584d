"""Row gates.  The order decides the reason: the first failure wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import prefix_before
from ..specs import SignalParams

# Reason codes in gate order.
NO_AUDIO, UNDECODABLE, TOO_SHORT, TOO_LONG, CLIPPING, EMPTY_TEXT = (
    "no_audio", "undecodable", "too_short", "too_long", "clipping", "empty_text")


def seconds(n_samples: Column, rate: Column | int) -> Column:
    return n_samples / (F.lit(rate) if isinstance(rate, int) else rate)


def reason_code(
    error: Column,
    n_samples: Column,
    max_clip_run: Column,
    text: Column,
    rate: Column,
    min_s: Column,
    max_s: Column,
    min_run: Column,
) -> Column:
    """Code of the first failed gate, null for a kept row."""
    dur = seconds(n_samples, rate)
    return (
        F.when((error == "no audio") | (error.isNull() & n_samples.isNull()), NO_AUDIO)
        .when(error.isNotNull(), UNDECODABLE)
        .when(dur < min_s, TOO_SHORT)
        .when(dur > max_s, TOO_LONG)
        .when(max_clip_run >= min_run, CLIPPING)
        .when(F.coalesce(text, F.lit("")) == "", EMPTY_TEXT)
    )


def reason_text(code: Column, error: Column, n_samples: Column, rate: Column, prefix: str = "audio: ") -> Column:
    """Readable reason; signal failures share ``prefix``."""
    dur = seconds(n_samples, rate)
    return (
        F.when(code.isin(NO_AUDIO, UNDECODABLE), F.concat(F.lit(prefix), F.coalesce(error, F.lit("no audio"))))
        .when(code == TOO_SHORT, F.format_string(prefix + "too short %.3fs", dur))
        .when(code == TOO_LONG, F.format_string(prefix + "too long %.1fs", dur))
        .when(code == CLIPPING, prefix + "clipping detected")
        .when(code == EMPTY_TEXT, "empty text")
    )


def reason_class(reason: Column) -> Column:
    """Histogram key: the reason up to its first colon."""
    return prefix_before(reason, ":")


def with_reason(df: DataFrame, params: SignalParams | None = None, prefix: str = "audio: ") -> DataFrame:
    """Add ``reason_code`` and ``reason``.

    Limits come from ``params``, or from the columns ``target_sr, min_s, max_s,
    min_run`` when every row brings its own.
    """
    if params is None:
        rate, low, high, run = F.col("target_sr"), F.col("min_s"), F.col("max_s"), F.col("min_run")
    else:
        rate, low, high, run = (F.lit(v) for v in (params.target_sr, params.min_s, params.max_s, params.min_run))
    code = reason_code(F.col("error"), F.col("n_samples"), F.col("max_clip_run"), F.col("text"), rate, low, high, run)
    return df.withColumn("reason_code", code).withColumn(
        "reason", reason_text(F.col("reason_code"), F.col("error"), F.col("n_samples"), rate, prefix)
    )


def kept(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason_code").isNull())


def dropped(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason_code").isNotNull())


def quality_subset(df: DataFrame, min_snr: float = 20.0, min_duration: float = 1.0) -> DataFrame:
    """Plain comparisons, so they reach a Parquet scan as pushed filters."""
    return df.filter((F.col("snr_db") > min_snr) & (F.col("duration") > min_duration))
