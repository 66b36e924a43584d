"""Waveform functions as higher-order Column expressions.

These keep short arrays inside the JVM.  For long waveforms use
:mod:`voxloom.functions.arrow_signal`, which computes the same values with
vectorised batches; the tests hold both to the same results.

All sums are taken in double; stored samples are float.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import rounded_ratio

POWER_FLOOR = 1e-10  # fixed value: smallest power used in the ratio
SILENT_DB = -120.0  # fixed value: level reported for an all-zero signal
QUIET_SHARE = 10  # fixed value: the quietest 1/10 of the samples estimates the noise


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once; a lambda would otherwise re-evaluate it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(x: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + term(v))


def _count(x: Column) -> Column:
    """Number of samples; null for none, so that means of nothing are null."""
    return F.nullif(F.size(x), F.lit(0))


def mean(x: Column) -> Column:
    return _total(x, lambda v: v.cast("double")) / _count(x)


def mean_power(x: Column) -> Column:
    return _total(x, lambda v: v.cast("double") * v.cast("double")) / _count(x)


def downmix(frames: Column, channel_axis: str = "last") -> Column:
    """Channel mean of a nested array.

    ``last``: frames x channels (one inner array per frame); ``first``: channels x frames.
    """
    if channel_axis == "last":
        return F.transform(frames, lambda f: mean(f).cast("float"))
    first = F.element_at(frames, 1)
    return F.transform(
        first,
        lambda _, i: (F.aggregate(frames, F.lit(0.0), lambda acc, ch: acc + F.get(ch, i)) / F.size(frames)).cast("float"),
    )


def downmix_interleaved(samples: Column, channels: Column | int) -> Column:
    """Channel mean of interleaved samples."""
    ch = F.lit(channels) if isinstance(channels, int) else channels
    frames = F.transform(
        F.sequence(F.lit(0), (F.size(samples) / ch).cast("int") - 1),
        lambda i: F.slice(samples, i * ch + 1, ch),
    )
    return downmix(frames)


def dc_remove(x: Column) -> Column:
    return let(mean(x), lambda m: F.transform(x, lambda v: (v - m).cast("float")))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, F.abs))


def peak_normalize(x: Column) -> Column:
    return let(
        peak(x),
        lambda p: F.when(p > 0, F.transform(x, lambda v: (v / p).cast("float"))).otherwise(x),
    )


def condition(x: Column) -> Column:
    """Centre, then scale to peak 1; ``x`` should be a plain column."""
    return let(dc_remove(x), peak_normalize)


def duration(n_samples: Column, rate: Column) -> Column:
    """Seconds, rounded to 4 digits in integer arithmetic."""
    return rounded_ratio(n_samples, rate)


def clip_mask(x: Column, clip_amp: float) -> Column:
    amp = F.lit(clip_amp).cast("float")
    return F.transform(x, lambda v: (F.abs(v) >= amp).cast("int"))


def max_clip_run(x: Column, clip_amp: float) -> Column:
    """Longest run of consecutive samples at or above ``clip_amp``."""
    amp = F.lit(clip_amp).cast("float")
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, v: Column) -> Column:
        run = F.when(F.abs(v) >= amp, acc["run"] + 1).otherwise(F.lit(0))
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(x, zero, step, lambda acc: acc["best"])


def quietest(x: Column) -> Column:
    """Absolute values of the quietest tenth, at least one sample."""
    n = F.greatest(F.lit(1), F.floor(F.size(x) / QUIET_SHARE).cast("int"))
    return F.slice(F.sort_array(F.transform(x, F.abs)), 1, n)


def snr_db(x: Column) -> Column:
    signal = F.greatest(mean_power(x), F.lit(POWER_FLOOR))
    noise = F.greatest(let(quietest(x), mean_power), F.lit(POWER_FLOOR))
    return F.round(10 * F.log10(signal / noise), 2)


def rms_db(x: Column) -> Column:
    return let(
        mean_power(x),
        lambda p: F.when(p > 0, F.round(20 * F.log10(F.sqrt(p)), 2)).otherwise(F.lit(SILENT_DB)),
    )


def source_rate(rate: Column | None, default: int = 16000) -> Column:
    """Rate given as a number or as text such as ``44100.0``; missing means ``default``.

    Text that is no number gives null, which the signal stage rejects.
    """
    if rate is None:
        return F.lit(default)
    return F.when(rate.isNull(), default).otherwise(rate.try_cast("double").try_cast("int"))
