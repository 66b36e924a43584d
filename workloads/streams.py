"""Batch and incremental builds, streaming totals and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.plans import build as batch
from voxloom.session import hadoop_path, scratch_path, spread
from voxloom.sources.files import list_files
from voxloom.specs import SourceSpec
from voxloom.streaming import totals
from voxloom.streaming.incremental import IncrementalBuild
from voxloom.streaming.seen import SeenKeys

from . import query
from .tables import PARAMS, SQL_SIGNAL, sql_normal, sql_words, table

FEED = SourceSpec(
    "feed", "feed", ("text",), audio_kind="samples", rate_col="samplerate", speaker_rule="column", speaker="label",
    split_rule="constant", index_scope="source", rows_per_file=4096, signal=PARAMS)

_SQL_FEED = f"""
{SQL_SIGNAL},
feed AS (SELECT doc_id, length(t) AS num_chars, {sql_words('t')} AS num_words, g.*,
                CASE WHEN n IS NULL THEN 'audio: no audio' WHEN max_run >= 2 THEN 'audio: clipping detected' WHEN t = '' THEN 'empty text' END AS reason,
                CASE WHEN coalesce(label, 0) = 0 THEN 'ds:feed_unknown' ELSE 'ds:' || label END AS speaker_id
         FROM (SELECT doc_id, {sql_normal('text')} AS t FROM documents) LEFT JOIN signal g ON vec_id = doc_id)"""


def thirds(spark, path: str) -> int:
    """Files per micro-batch that make about three batches."""
    return max(1, -(-list_files(spark, path, recursive=True).count() // 3))


def raw_feed(spark, d, root: str | None = None, arriving=None) -> str:
    """Raw files of a source with text, samples and rate, made from the tables; as many as the data gives.

    ``arriving`` names the documents whose files are added to ``root`` now.
    """
    root = root or scratch_path(spark, "raw")
    docs = spread(table(spark, d, "documents").select("doc_id", "text", "lang"))
    docs = docs if arriving is None else docs.filter(arriving)
    audio = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("audio"), "label", F.lit("16.0").alias("samplerate"))
    docs.join(audio, "doc_id", "left").write.mode("append").partitionBy("lang").parquet(f"{root}/{FEED.path}")
    return root


@query("batch_build", f"""
WITH {_SQL_FEED}
SELECT speaker_id, count(*)::BIGINT AS n_rows, sum(num_chars)::BIGINT AS num_chars, sum(num_words)::BIGINT AS num_words,
       round(avg(snr_db), 3) AS snr_db, round(avg(rms_db), 3) AS rms_db, sum(n)::BIGINT AS n_samples
FROM feed WHERE reason IS NULL GROUP BY speaker_id""")
def batch_build(spark, d):
    """Raw files to a corpus in one decode, summarised by speaker."""
    paths = batch.build(spark, FEED, raw_feed(spark, d), scratch_path(spark, "built"))
    return _by_speaker(batch.kept_rows(spark, paths))


def _by_speaker(kept):
    return kept.groupBy("speaker_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("num_chars").alias("num_chars"), F.sum("num_words").alias("num_words"),
        F.round(F.avg(F.round(F.col("snr_db").cast("double"), 2)), 3).alias("snr_db"),
        F.round(F.avg(F.round(F.col("rms_db").cast("double"), 2)), 3).alias("rms_db"),
        F.sum(F.size("audio.array")).alias("n_samples"))


_SQL_BUILT = f"""
WITH {_SQL_FEED}
SELECT count(*)::BIGINT AS rows_in, count_if(reason IS NULL)::BIGINT AS kept, count_if(reason IS NOT NULL)::BIGINT AS dropped,
       (count_if(reason IS NULL) * 40000)::BIGINT AS ticks, count(*)::BIGINT AS next_index, true AS ids_unique FROM feed"""


@query("incremental_build", _SQL_BUILT)
def incremental_build(spark, d):
    """The same source file by file with a checkpoint; a second run finds nothing left to do."""
    raw = raw_feed(spark, d)
    job = IncrementalBuild(spark, FEED, raw, scratch_path(spark, "incremental"), files_per_batch=thirds(spark, raw))
    job.run()
    job.run()
    return _built(job)


def _built(job):
    ids = job.rows().select("utt_id").groupBy("utt_id").agg(F.count(F.lit(1)).alias("n")).agg(
        (F.max("n") == 1).alias("ids_unique"),
        (F.max(F.substring("utt_id", -8, 8).cast("long")) + 1).alias("next_index"))
    sums = job.progress().agg(*[F.sum(c).alias(c) for c in ("rows_in", "kept", "dropped", "ticks")])
    return sums.crossJoin(ids).select("rows_in", "kept", "dropped", "ticks", "next_index", "ids_unique")


@query("incremental_recover", _SQL_BUILT)
def incremental_recover(spark, d):
    """The checkpoint is lost half-way, then the other files arrive: no row is lost, built twice or given a used id."""
    late = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(True))
    raw, out = raw_feed(spark, d, arriving=~late), scratch_path(spark, "recovered")
    IncrementalBuild(spark, FEED, raw, out, files_per_batch=thirds(spark, raw)).run()
    fs, checkpoint = hadoop_path(spark, f"{out}/checkpoint")
    fs.delete(checkpoint, True)
    raw_feed(spark, d, raw, late)
    job = IncrementalBuild(spark, FEED, raw, out, files_per_batch=thirds(spark, raw))
    job.run()
    return _built(job)


@query("incremental_drop_log", f"WITH {_SQL_FEED} SELECT source, reason, count(*)::BIGINT AS n_rows FROM (SELECT 'feed' AS source, reason FROM feed) WHERE reason IS NOT NULL GROUP BY ALL")
def incremental_drop_log(spark, d):
    """What the batches of an incremental build logged as dropped, read back."""
    raw, out = raw_feed(spark, d), scratch_path(spark, "incremental")
    IncrementalBuild(spark, FEED, raw, out, files_per_batch=thirds(spark, raw)).run()
    log = spark.read.schema("source string, split string, utt_id string, reason string").json(f"{out}/drop_log")
    return log.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query("stream_read", "SELECT lang, count(*)::BIGINT AS n_rows FROM documents GROUP BY lang")
def stream_read(spark, d):
    """A table read as a file stream, written through and counted."""
    root = scratch_path(spark, "stream-read")
    docs = table(spark, d, "documents").select("doc_id", "lang")
    docs.write.parquet(f"{root}/in")
    totals.run_to_table(totals.file_stream(spark, f"{root}/in", docs.schema), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))


@query("stream_totals", "SELECT event_type, count(*)::BIGINT AS n_rows, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY event_type")
def stream_totals(spark, d):
    """Running totals per key over several micro-batches; the last update of each key counts."""
    root = scratch_path(spark, "stream-totals")
    events = table(spark, d, "events").select("event_type", "value", F.col("user_id").alias("user"), F.dayofweek("ts").alias("day"))
    events.write.partitionBy("day").parquet(f"{root}/in")
    stream = totals.file_stream(spark, f"{root}/in", events.schema, thirds(spark, f"{root}/in"))
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    running = totals.running_totals(stream, ["event_type"], n_rows=F.count(F.lit(1)), cents=cents)
    totals.run_to_table(running, f"{root}/out", f"{root}/checkpoint", "update")
    return totals.latest(spark, f"{root}/out", ["event_type"])


@query("stream_dedup", """
SELECT utt_id, true AS once FROM (SELECT DISTINCT md5(text) AS utt_id FROM documents)""")
def stream_dedup(spark, d):
    """One row per key over several micro-batches; equal texts stand for equal ids.

    Half of the files arrive after the keys were packed, and the checkpoint is lost before the last run.
    """
    root = scratch_path(spark, "stream-dedup")
    ids = table(spark, d, "documents").select("doc_id", F.md5("text").alias("utt_id"), "lang")
    seen = SeenKeys(spark, f"{root}/out", ["utt_id"], ids.schema)

    def arrive(some) -> None:
        ids.filter(some).write.mode("append").partitionBy("lang").parquet(f"{root}/in")
        seen.run(totals.file_stream(spark, f"{root}/in", ids.schema, thirds(spark, f"{root}/in")), f"{root}/checkpoint")

    late = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(True))
    arrive(~late)
    seen.pack()
    arrive(late)
    fs, checkpoint = hadoop_path(spark, f"{root}/checkpoint")
    fs.delete(checkpoint, True)
    arrive(F.lit(False))
    return seen.rows().groupBy("utt_id").agg((F.count(F.lit(1)) == 1).alias("once"))


@query("live_counters", "SELECT source, count(*)::BIGINT AS n_rows, (SELECT count(*) FROM documents)::BIGINT AS observed FROM documents GROUP BY source")
def live_counters(spark, d):
    """Counters observed while a table is written, without a second pass over it."""
    out = scratch_path(spark, "observed")
    docs = table(spark, d, "documents").select("doc_id", "source")
    watched, values = totals.observed_totals(docs, "rows written", n=F.count(F.lit(1)))
    watched.write.parquet(out)
    seen = values()["n"]
    return spark.read.parquet(out).groupBy("source").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("observed", F.lit(seen).cast("long"))

