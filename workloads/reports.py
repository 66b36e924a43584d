"""Corpus reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import gates
from voxloom.plans import report

from . import query
from .scans import config_of_lang
from .tables import SQL_ANNOTATED, annotated, kept, long

_TICKS = "sum(round(duration * 10000)::BIGINT)::BIGINT"
_HOURS = f"round(coalesce({_TICKS}, 0) / 36000000.0, 4)"
_LABEL = f"printf('%dh %02dm', ({_TICKS} // 10000) // 3600, (({_TICKS} // 10000) // 60) % 60)"
_NAMED = "nullif(count(DISTINCT speaker_id), 0)"


@query("build_report", f"""
WITH {SQL_ANNOTATED}
SELECT source, split, count(*)::BIGINT AS rows_in, count_if(reason IS NULL)::BIGINT AS kept, count_if(reason IS NOT NULL)::BIGINT AS dropped,
       round(coalesce((sum(round(duration * 10000)::BIGINT) FILTER (reason IS NULL))::BIGINT, 0) / 36000000.0, 4) AS hours,
       round(100.0::DOUBLE * count_if(reason IS NOT NULL) / count(*), 1) AS drop_pct
FROM annotated GROUP BY source, split""")
def build_report(spark, d):
    return report.build_report(annotated(spark, d))


@query("reason_histogram", f"""
WITH {SQL_ANNOTATED}
SELECT trim(split_part(reason, ':', 1)) AS reason_class, count(*)::BIGINT AS n FROM annotated WHERE reason IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1""")
def reason_histogram(spark, d):
    return report.reason_histogram(gates.dropped(annotated(spark, d)))


@query("split_hours", f"WITH {SQL_ANNOTATED} SELECT split, count(*)::BIGINT AS n_rows, {_HOURS} AS hours FROM kept GROUP BY split")
def split_hours(spark, d):
    return report.split_hours(kept(spark, d))


@query("progress_totals", f"""
WITH {SQL_ANNOTATED}, files AS (
    SELECT source, split AS file, count_if(reason IS NULL) AS kept, count_if(reason IS NOT NULL) AS dropped,
           coalesce(sum(round(duration * 10000)::BIGINT) FILTER (reason IS NULL), 0) AS ticks FROM annotated GROUP BY source, split)
SELECT source, file, (sum(kept) OVER w)::BIGINT AS total_kept, (sum(dropped) OVER w)::BIGINT AS total_dropped,
       round((sum(ticks) OVER w)::BIGINT / 36000000.0, 4) AS total_hours
FROM files WINDOW w AS (PARTITION BY source ORDER BY file ROWS UNBOUNDED PRECEDING)""")
def progress_totals(spark, d):
    """Running totals over the files of a source; here a split stands for a file."""
    ok = F.col("reason_code").isNull()
    files = annotated(spark, d).groupBy("source", F.col("split").alias("file")).agg(
        F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"),
        F.coalesce(F.sum(F.when(ok, report.duration_ticks(F.col("duration")))), F.lit(0)).alias("ticks"))
    return report.progress_totals(files, ["file"]).select("source", "file", "total_kept", "total_dropped", "total_hours")


@query("corpus_totals", f"""
WITH {SQL_ANNOTATED}
SELECT count(*)::BIGINT AS utterances, {_HOURS} AS hours, count(DISTINCT speaker_id)::BIGINT AS speakers,
       count(DISTINCT source)::BIGINT AS sources, count(DISTINCT (source, split))::BIGINT AS splits FROM kept""")
def corpus_totals(spark, d):
    return report.corpus_totals(kept(spark, d))


@query("source_summary", f"""
WITH {SQL_ANNOTATED}, named AS (
    SELECT *, 'srezas' || CASE split WHEN 'fr' THEN '_fleurs' WHEN 'de' THEN '_yazdi' WHEN 'es' THEN '_cv17' ELSE '' END AS report_source,
           source AS feed FROM kept)
SELECT CASE WHEN source IN ('src11') THEN report_source ELSE source END AS report_source, count(*)::BIGINT AS utterances, {_HOURS} AS hours,
       {_NAMED}::BIGINT AS speakers, count(DISTINCT split)::BIGINT AS splits, {_LABEL} AS duration
FROM named GROUP BY 1 ORDER BY hours DESC, 1""")
def source_summary(spark, d):
    """Per reported source; the configurations of the multi-config source are reported apart."""
    from voxloom.sources.scan import config_short
    from voxloom.specs import CONFIG_SHORT

    multi = F.col("source") == "src11"
    short = config_short(config_of_lang(F.col("split")), CONFIG_SHORT)
    rows = kept(spark, d).select(
        F.when(multi, "srezas").otherwise(F.col("source")).alias("source"),
        F.when(multi, F.concat_ws("_", short, F.lit("train"))).otherwise(F.col("split")).alias("split"),
        "speaker_id", "duration")
    return report.source_summary(rows)


@query("split_summary", f"""
WITH {SQL_ANNOTATED}
SELECT source, split, count(*)::BIGINT AS utterances, {_HOURS} AS hours, {_NAMED}::BIGINT AS speakers, {_LABEL} AS duration,
       count(*) < 100 AS small_split FROM kept GROUP BY source, split ORDER BY hours DESC, source, split""")
def split_summary(spark, d):
    return report.split_summary(kept(spark, d))


@query("corpus_rollup", f"""
WITH {SQL_ANNOTATED}
SELECT grouping(source, split)::BIGINT AS level, source, split, count(*)::BIGINT AS utterances, {_HOURS} AS hours,
       count(DISTINCT speaker_id)::BIGINT AS speakers FROM kept GROUP BY ROLLUP (source, split)""")
def corpus_rollup(spark, d):
    return report.corpus_rollup(kept(spark, d)).withColumn("level", long("level"))


def _sql_buckets(value: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {value} < {e} THEN '{x}'" for e, x in zip(edges, labels))
    return f"""
WITH {SQL_ANNOTATED}
SELECT CASE {whens} ELSE '{labels[-1]}' END AS bucket, count(*)::BIGINT AS n,
       round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM kept), 1) AS share_pct FROM kept GROUP BY 1"""


def _sql_moments(value: str, more: str = "") -> str:
    return f"""
WITH {SQL_ANNOTATED}
SELECT count(*)::BIGINT AS n, round(avg({value}), 4) AS mean, round(quantile_cont({value}, 0.5), 4) AS median,
       round(stddev_pop({value}), 4) AS std{more} FROM kept"""


@query("snr_histogram", _sql_buckets("snr_db", (10, 20, 30, 40), ("<10", "10-20", "20-30", "30-40", ">40")))
def snr_histogram(spark, d):
    return report.snr_histogram(kept(spark, d))


@query("snr_stats", _sql_moments("snr_db"))
def snr_stats(spark, d):
    return report.snr_stats(kept(spark, d))


@query("rms_stats", _sql_moments("rms_db", ", round(quantile_cont(rms_db, 0.05), 4) AS p5, round(quantile_cont(rms_db, 0.95), 4) AS p95"))
def rms_stats(spark, d):
    return report.rms_stats(kept(spark, d))


@query("duration_histogram", _sql_buckets("duration", (2, 5, 10, 20), ("<2", "2-5", "5-10", "10-20", ">20")))
def duration_histogram(spark, d):
    return report.duration_histogram(kept(spark, d))


@query("duration_stats", _sql_moments("duration", ", round(max(duration), 4) AS max"))
def duration_stats(spark, d):
    return report.duration_stats(kept(spark, d))


@query("rate_histogram", _sql_buckets("speaking_rate", (5, 10, 15, 20), ("<5", "5-10", "10-15", "15-20", ">20")))
def rate_histogram(spark, d):
    return report.rate_histogram(kept(spark, d))


@query("rate_stats", _sql_moments("speaking_rate"))
def rate_stats(spark, d):
    return report.rate_stats(kept(spark, d))


@query("char_rate_stats", _sql_moments("chars_per_sec"))
def char_rate_stats(spark, d):
    return report.rate_stats(kept(spark, d), "chars_per_sec")


@query("speaker_count", f"""
WITH {SQL_ANNOTATED}
SELECT count(DISTINCT speaker_id)::BIGINT AS speakers, count(DISTINCT speaker_id) FILTER (speaker_id LIKE 'ds:%')::BIGINT AS named_speakers,
       count(*)::BIGINT AS utterances FROM kept""")
def speaker_count(spark, d):
    return report.speaker_count(kept(spark, d))
