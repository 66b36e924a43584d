"""Writers, merging and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import dedup, gates
from voxloom.operators.joins import without_existing
from voxloom.plans import merge
from voxloom.session import scratch_path
from voxloom.sinks import files
from voxloom.sources.scan import read_keyed
from voxloom.specs import spec_for

from . import query
from .signals import wav_bytes
from .tables import RATE, SQL_ANNOTATED, annotated, documents, long, table


_LIMIT = 8  # rows a file, so that the splits of the smallest tables exceed it too


@query("write_shards", f"""
SELECT source, lang AS split, count(*)::BIGINT AS n_rows, true AS within_limit, true AS enough_files, sum(length(text))::BIGINT AS n_chars
FROM documents GROUP BY source, lang""")
def write_shards(spark, d):
    """Row-limited files per split, read back."""
    out = scratch_path(spark, "shards")
    files.write_shards(documents(spark, d), out, _LIMIT, ("source", "split"))
    per_file = read_keyed(spark, out).groupBy("source", "split", F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text")).alias("chars"))
    return per_file.groupBy("source", "split").agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= _LIMIT).alias("within_limit"),
        (F.count(F.lit(1)) >= F.ceil(F.sum("n") / _LIMIT)).alias("enough_files"), F.sum("chars").alias("n_chars"))


@query("drop_log", f"WITH {SQL_ANNOTATED} SELECT source, split, utt_id, reason FROM annotated WHERE reason IS NOT NULL")
def drop_log(spark, d):
    """Dropped rows as JSON lines, read back."""
    out = scratch_path(spark, "drops")
    files.write_drop_log(gates.dropped(annotated(spark, d)), out)
    return spark.read.schema("source string, split string, utt_id string, reason string").json(out)


def _text_sources(spark, d):
    docs = documents(spark, d).select("source", "split", "text", F.lit(RATE).alias("sampling_rate"))
    talk = table(spark, d, "conversations").select(F.lit("conversations").alias("source"), F.col("role").alias("split"), "text")
    pages = table(spark, d, "pages").select(F.lit("pages").alias("source"), F.lit("train").alias("split"), F.col("html").alias("text"))
    return [docs, talk, pages]


_SQL_SOURCES = """
src AS (SELECT source, lang AS split, text FROM documents UNION ALL SELECT 'conversations', role, text FROM conversations
        UNION ALL SELECT 'pages', 'train', html FROM pages)"""


@query("merge_corpus", f"""
WITH {_SQL_SOURCES}, sounds AS (SELECT source, lang AS split, sum(len(embedding))::BIGINT AS n_samples,
    sum(list_sum(list_transform(embedding, lambda v: round(v::DOUBLE * 100000)::BIGINT)))::BIGINT AS digits
  FROM documents JOIN embeddings ON vec_id = doc_id GROUP BY ALL)
SELECT source, split, n_rows, n_chars, coalesce(n_samples, 0) AS n_samples, digits, 1::BIGINT AS n_files
FROM (SELECT source, split, count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS n_chars FROM src GROUP BY source, split) LEFT JOIN sounds USING (source, split)""")
def merge_corpus(spark, d):
    """Three sources, one with waveforms, merged into one partitioned table of one file a split, read back."""
    out = scratch_path(spark, "merged")
    docs, talk, pages = _text_sources(spark, d)
    sound = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("samples"))
    docs = documents(spark, d).join(sound, "doc_id", "left").drop("doc_id").withColumn("sampling_rate", F.lit(RATE))
    parts = [docs.withColumn("n_samples", F.coalesce(F.size("samples"), F.lit(0))), *[p.withColumn("n_samples", F.lit(0)) for p in (talk, pages)]]
    merge.merge_corpus(spark, parts, out, compact=True)
    digits = F.aggregate("samples", F.lit(0).cast("long"), lambda a, v: a + F.round(v.cast("double") * 100000).cast("long"))
    return read_keyed(spark, out).groupBy("source", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"), F.sum("n_samples").alias("n_samples"),
        F.sum(digits).alias("digits"), F.count_distinct(F.col("_metadata.file_path")).alias("n_files"))


@query("merge_skip_existing", f"""
WITH {_SQL_SOURCES}, saved AS (SELECT DISTINCT source, lang AS split FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT source, split, count(*)::BIGINT AS n_rows FROM src ANTI JOIN saved USING (source, split) GROUP BY source, split""")
def merge_skip_existing(spark, d):
    """Rows of splits that are not saved yet; here splits with a toxic label count as saved."""
    toxic = table(spark, d, "labels").filter(F.col("toxic") == 1).select("doc_id")
    saved = documents(spark, d).select("doc_id", "source", "split").join(toxic, "doc_id", "left_semi")
    rows = merge.union_sources(_text_sources(spark, d))
    return without_existing(rows, saved, merge.KEYS).groupBy("source", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("merge_resume", f"WITH {_SQL_SOURCES} SELECT source, split, count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS n_chars FROM src GROUP BY source, split")
def merge_resume(spark, d):
    """A second merge over a finished source and the half-written splits of a merge that broke off."""
    out = scratch_path(spark, "resumed")
    docs, talk, pages = (p.withColumn("n_samples", F.lit(0)) for p in _text_sources(spark, d))
    merge.merge_corpus(spark, [docs], out)
    files.write_shards(talk.filter(F.length("text") % 2 == 0).drop("sampling_rate"), out, 1000, merge.KEYS, mode="append")
    merge.merge_corpus(spark, [docs, talk, pages], out)
    return read_keyed(spark, out).groupBy("source", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"))


@query("manifest", f"""
WITH {_SQL_SOURCES}
SELECT '{{"splits":[' || string_agg('"' || k || '"', ',' ORDER BY k) || ']}}' AS manifest FROM (SELECT DISTINCT source || '_' || split AS k FROM src)""")
def manifest(spark, d):
    rows = merge.union_sources(_text_sources(spark, d))
    return files.manifest(rows, merge.split_key(rows))


@query("replace_atomic", """
SELECT count(*)::BIGINT AS n_rows, count(DISTINCT digest)::BIGINT AS n_texts, sum(doc_id)::BIGINT AS ids, true AS failed_check_kept_old
FROM (SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY 1)""")
def replace_atomic(spark, d):
    """A saved table de-duplicated in place: written beside, checked, swapped; first a run whose check fails."""
    path = scratch_path(spark, "replace")
    documents(spark, d).select("doc_id", F.md5("text").alias("digest")).write.parquet(path)
    rows = spark.read.parquet(path).count()

    def refuse(new):
        raise ValueError("not wanted")

    def unique(new):
        assert dedup.duplicate_counts(new, ["digest"]).head().removed == 0

    try:
        files.replace_in_place(spark, path, spark.read.parquet(path).limit(0), refuse)
    except ValueError:
        pass
    kept_old = spark.read.parquet(path).count() == rows
    files.replace_in_place(spark, path, dedup.keep_first(spark.read.parquet(path), ["digest"], ["doc_id"]), unique)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("digest").alias("n_texts"), F.sum("doc_id").alias("ids"), F.lit(kept_old).alias("failed_check_kept_old"))


@query("embed_audio", """
SELECT vec_id, (44 + 2 * len(embedding))::BIGINT AS n_bytes, true AS no_path,
       md5(array_to_string(list_transform(embedding, lambda v: printf('%02X%02X', ((round(v::DOUBLE * 32767)::BIGINT + 65536) % 65536) % 256,
                                          ((round(v::DOUBLE * 32767)::BIGINT + 65536) % 65536) // 256)), '')) AS body FROM embeddings""")
def embed_audio(spark, d):
    """Audio bytes inline in a saved table, read back."""
    out = scratch_path(spark, "embedded")
    content = table(spark, d, "embeddings").select("vec_id", wav_bytes(F.col("embedding"), RATE).alias("content"))
    files.write_shards(files.embed_bytes(content), out, 64)
    body = F.expr("substring(audio.bytes, 45)")
    return spark.read.parquet(out).select(
        "vec_id", long(F.octet_length("audio.bytes"), "n_bytes"), F.col("audio.path").isNull().alias("no_path"),
        F.md5(F.hex(body)).alias("body"))
