"""Corpus reports from scalar columns; waveforms are never read.

Percentiles are exact.  Rounded values are integers of their last digit; one
narrow copy of them is counted in ranges that narrow around the wanted ranks, so
no task receives all values, however many differ.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import hours_label
from ..operators.gates import reason_class
from ..operators.ranks import values_at
from ..session import materialized
from ..specs import DEFAULT_CONFIG_SHORT

# Lower bounds of the report's buckets, [lower, next lower).
SNR_EDGES, SNR_LABELS = (10, 20, 30, 40), ("<10", "10-20", "20-30", "30-40", ">40")
DURATION_EDGES, DURATION_LABELS = (2, 5, 10, 20), ("<2", "2-5", "5-10", "10-20", ">20")
RATE_EDGES, RATE_LABELS = (5, 10, 15, 20), ("<5", "5-10", "10-15", "15-20", ">20")
SMALL_SPLIT = 100  # fixed value: splits below this many rows are marked, not removed


def ticks(value: Column, digits: int) -> Column:
    """An already rounded value as an integer count of its last digit.

    Integers add up exactly in any order and group faster than doubles; rounding
    by ``floor`` avoids the decimal arithmetic behind ``round``.
    """
    return F.floor(value.cast("double") * 10**digits + 0.5)


def duration_ticks(duration: Column) -> Column:
    """Duration in units of 0.1 ms."""
    return ticks(duration, 4)


def hours(duration: Column) -> Column:
    return F.round(F.coalesce(F.sum(duration_ticks(duration)), F.lit(0)) / 36_000_000.0, 4)


def build_report(rows: DataFrame, keys: Sequence[str] = ("source", "split")) -> DataFrame:
    """Rows in, kept, dropped, share dropped and kept hours per split."""
    ok = F.col("reason_code").isNull()
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(ok).alias("kept"),
        F.count_if(~ok).alias("dropped"),
        hours(F.when(ok, F.col("duration"))).alias("hours"),
    ).withColumn("drop_pct", F.round(100.0 * F.col("dropped") / F.greatest(F.lit(1), F.col("rows_in")), 1))


def reason_histogram(dropped: DataFrame, reason: str = "reason") -> DataFrame:
    return (
        dropped.groupBy(reason_class(F.col(reason)).alias("reason_class"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason_class")
    )


def code_histogram(dropped: DataFrame) -> DataFrame:
    """Dropped rows per gate, the same for all sources whatever their wording."""
    return dropped.groupBy("reason_code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason_code")


def split_hours(kept: DataFrame, keys: Sequence[str] = ("split",)) -> DataFrame:
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), hours(F.col("duration")).alias("hours"))


def progress_totals(progress: DataFrame, order: Sequence[str], keys: Sequence[str] = ("source",)) -> DataFrame:
    """Running totals over per-file (or per-batch) counters; one row per file enters."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return progress.select(
        "*",
        F.sum("kept").over(w).alias("total_kept"),
        F.sum("dropped").over(w).alias("total_dropped"),
        F.round(F.sum("ticks").over(w) / 36_000_000.0, 4).alias("total_hours"),
    )


def named_speaker(speaker: Column) -> Column:
    """Speaker label where the raw data names one, else null."""
    return F.when(speaker.startswith("ds:"), speaker)


def report_source(source: Column, split: Column, multi: str = "srezas") -> Column:
    """Name a multi-config source is reported under: its main configuration plainly, others with the short name."""
    short = F.substring_index(split, "_", 1)
    return F.when((source == multi) & (short != DEFAULT_CONFIG_SHORT), F.concat_ws("_", source, short)).otherwise(source)


def by_speaker(kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and ticks per keys and speaker: the only shuffle that all rows feed, combined before it."""
    return kept.groupBy(*keys, "speaker_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(duration_ticks(F.col("duration"))).alias("ticks"))


def _totals(named_only: bool) -> list[Column]:
    who = named_speaker(F.col("speaker_id")) if named_only else F.col("speaker_id")
    n_speakers = F.count_distinct(who)
    return [
        F.sum("n").cast("long").alias("utterances"),
        F.round(F.sum("ticks") / 36_000_000.0, 4).alias("hours"),
        F.when(n_speakers > 0, n_speakers).alias("speakers") if named_only else n_speakers.alias("speakers"),
    ]


def corpus_totals(kept: DataFrame) -> DataFrame:
    return by_speaker(kept, ["source", "split"]).agg(
        *_totals(named_only=False),
        F.count_distinct("source").alias("sources"),
        F.count_distinct("source", "split").alias("splits"),
    )


def source_summary(kept: DataFrame) -> DataFrame:
    grouped = kept.withColumn("report_source", report_source(F.col("source"), F.col("split")))
    return (
        by_speaker(grouped, ["report_source", "split"]).groupBy("report_source")
        .agg(*_totals(named_only=True), F.count_distinct("split").alias("splits"),
             hours_label(F.sum("ticks") / 10000).alias("duration"))
        .orderBy(F.desc("hours"), "report_source")
    )


def split_summary(kept: DataFrame) -> DataFrame:
    return (
        by_speaker(kept, ["source", "split"]).groupBy("source", "split")
        .agg(*_totals(named_only=True), hours_label(F.sum("ticks") / 10000).alias("duration"))
        .withColumn("small_split", F.col("utterances") < SMALL_SPLIT)
        .orderBy(F.desc("hours"), "source", "split")
    )


def corpus_rollup(kept: DataFrame) -> DataFrame:
    """Corpus, source and split level at once.

    The rollup expands the per-speaker counts, not the rows; each level then
    counts speakers with a plain count after one more grouping.
    """
    leaves = by_speaker(kept, ["source", "split"])
    per_speaker = leaves.rollup("source", "split").agg(
        F.grouping_id().alias("level"), F.sum("n").alias("utterances"), F.sum("ticks").alias("ticks"),
        F.count_distinct("speaker_id").alias("speakers"))
    return per_speaker.select(
        "level", "source", "split", F.col("utterances").cast("long").alias("utterances"),
        F.round(F.col("ticks") / 36_000_000.0, 4).alias("hours"), "speakers")


def speaker_count(kept: DataFrame) -> DataFrame:
    """Exact count of distinct labels and a sketch of it for very large corpora."""
    return kept.groupBy("speaker_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("speakers"),
        F.count_if(F.col("speaker_id").startswith("ds:")).alias("named_speakers"),
        F.sum("n").cast("long").alias("utterances"),
    )


def speaker_estimate(kept: DataFrame, error: float = 0.02) -> DataFrame:
    return kept.agg(F.approx_count_distinct("speaker_id", error).alias("speakers"))


def value_ticks(rows: DataFrame, value: Column, digits: int) -> DataFrame:
    """The values as integers ``t`` of their last digit, nulls left out: one narrow column."""
    return rows.filter(value.isNotNull()).select(ticks(value, digits).alias("t"))


def bucket_of(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    chain = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        chain = chain.when(value < edge, label)
    return chain.otherwise(labels[-1])


def histogram(rows: DataFrame, value: Column, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Count and share per bucket; a task passes on one row per bucket."""
    first = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("bucket"))
    return (
        rows.filter(value.isNotNull()).groupBy(bucket_of(value, edges, labels).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share_pct", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 1))
        .orderBy(first)
    )


def moments(values: DataFrame, digits: int, percentiles: Sequence[float] = (), extremes: bool = False, shown: int = 4) -> DataFrame:
    """One row: mean, population deviation, exact median and further percentiles of ``t`` in units of ``10**-digits``.

    Percentiles between two values are interpolated.  Sums are exact, whatever the order of the rows.
    """
    kept = materialized(values, "ticks")
    exact = F.col("t").cast("decimal(19,0)")
    n, low, high, total, squares = kept.agg(
        F.count("t"), F.min("t"), F.max("t"), F.sum(exact), F.sum((exact * exact).cast("decimal(38,0)"))).head()
    wanted = {"median": 0.5, **{f"p{round(p * 100)}": p for p in percentiles}}
    stats: dict[str, float | None] = dict.fromkeys(("mean", "median", "std", *list(wanted)[1:], *(["max"] if extremes else [])))
    if n:
        unit, total, squares = 10.0**digits, int(total), int(squares)
        places = {name: (n - 1) * p for name, p in wanted.items()}
        at = values_at(kept, [r for x in places.values() for r in (math.floor(x), math.ceil(x))], low, high)
        for name, x in places.items():
            a, b = at[math.floor(x)] / unit, at[math.ceil(x)] / unit
            stats[name] = a + (b - a) * (x - math.floor(x))
        stats["mean"] = total / n / unit
        stats["std"] = math.sqrt(max(0, n * squares - total * total)) / n / unit
        if extremes:
            stats["max"] = high / unit
    one = kept.sparkSession.createDataFrame([(n, *stats.values())], ", ".join(["n long", *(f"{c} double" for c in stats)]))
    return one.select("n", *[F.round(c, shown).alias(c) for c in stats])


def snr_histogram(kept: DataFrame) -> DataFrame:
    return histogram(kept, F.col("snr_db"), SNR_EDGES, SNR_LABELS)


def snr_stats(kept: DataFrame) -> DataFrame:
    return moments(value_ticks(kept, F.col("snr_db"), 2), 2)


def rms_stats(kept: DataFrame) -> DataFrame:
    return moments(value_ticks(kept, F.col("rms_db"), 2), 2, percentiles=(0.05, 0.95))


def duration_histogram(kept: DataFrame) -> DataFrame:
    return histogram(kept, F.col("duration"), DURATION_EDGES, DURATION_LABELS)


def duration_stats(kept: DataFrame) -> DataFrame:
    return moments(value_ticks(kept, F.col("duration"), 4), 4, extremes=True)


def rate_histogram(kept: DataFrame, rate: str = "speaking_rate") -> DataFrame:
    return histogram(kept, F.col(rate), RATE_EDGES, RATE_LABELS)


def rate_stats(kept: DataFrame, rate: str = "speaking_rate") -> DataFrame:
    return moments(value_ticks(kept, F.col(rate), 4), 4)
