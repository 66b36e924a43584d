"""Projections, gates, joins, indices, de-duplication and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import signal as sig
from voxloom.functions import text as txt
from voxloom.operators import dedup, gates, identity, joins, quality
from voxloom.plans.build import unified_columns
from voxloom.session import scratch_path, text_session
from voxloom.sinks.files import write_shards

from . import query
from .scans import SQL_CONFIG_OF_LANG, config_of_lang
from .tables import (
    PARAMS, RATE, SQL_ANNOTATED, annotated, digits, documents, kept, long, measured, settings, speaker, table,
)

_SQL_SAMPLES = "array_to_string(list_transform(y, lambda v: round(v::DOUBLE * 100000)::BIGINT), ' ')"
_COUNTS = ("source", "split")


def _gate(spark, d, code: str):
    return annotated(spark, d).groupBy("source").agg(
        F.count_if(F.col("reason_code") == code).alias("rejected"), F.count(F.lit(1)).alias("n_rows"))


@query("unify_schema", f"""
WITH {SQL_ANNOTATED}
SELECT utt_id, {_SQL_SAMPLES} AS samples, sr::BIGINT AS sampling_rate, text, duration, n::BIGINT AS n_samples, speaker_id, snr_db, rms_db,
       num_chars::BIGINT AS num_chars, num_words::BIGINT AS num_words, speaking_rate
FROM kept""")
def unify_schema(spark, d):
    """The eleven columns of kept rows at their own rates; the audio struct is shown as digits."""
    rows = kept(spark, d, keep_samples=True, keep_text=True)
    unified = rows.select(*unified_columns(PARAMS, F.col("target_sr")))
    return unified.select(
        "utt_id", digits(F.col("audio.array")).alias("samples"), long("audio.sampling_rate", "sampling_rate"), "text",
        F.col("duration").cast("double").alias("duration"), long("n_samples"), "speaker_id",
        F.round(F.col("snr_db").cast("double"), 2).alias("snr_db"), F.round(F.col("rms_db").cast("double"), 2).alias("rms_db"),
        long("num_chars"), long("num_words"), F.round(F.col("speaking_rate").cast("double"), 2).alias("speaking_rate"))


@query("make_utt_id", "SELECT doc_id, printf('%s_%s_%08d', source, lang, doc_id) AS utt_id FROM documents")
def make_utt_id(spark, d):
    return documents(spark, d).select("doc_id", identity.utt_id(F.col("source"), F.col("split"), F.col("doc_id")).alias("utt_id"))


@query("speaker_id", f"""
SELECT doc_id, CASE WHEN coalesce(label, 0) = 0 THEN 'ds:' || source || '_unknown' ELSE 'ds:' || label END AS from_column,
       'gen:srezas_' || {SQL_CONFIG_OF_LANG} || '_spk0000' AS from_config, 'gen:mana_tts_spk0000' AS literal
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""")
def speaker_id(spark, d):
    """Labels from a column, from the configuration and fixed ones."""
    from voxloom.specs import spec_for

    labels = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    rows = documents(spark, d).drop("text").join(labels, "doc_id", "left").withColumn("config", config_of_lang(F.col("split")))
    return rows.select(
        "doc_id", speaker(F.col("label"), F.col("source")).alias("from_column"),
        identity.speaker_id(spec_for("srezas"), rows).alias("from_config"),
        identity.speaker_id(spec_for("mana_tts"), rows).alias("literal"))


@query("gate_duration", f"""
WITH {SQL_ANNOTATED}
SELECT source, (count(*) FILTER (reason LIKE 'audio: too short%'))::BIGINT AS too_short, (count(*) FILTER (reason LIKE 'audio: too long%'))::BIGINT AS too_long,
       count(*)::BIGINT AS n_rows FROM annotated GROUP BY source""")
def gate_duration(spark, d):
    return annotated(spark, d).groupBy("source").agg(
        F.count_if(F.col("reason_code") == gates.TOO_SHORT).alias("too_short"),
        F.count_if(F.col("reason_code") == gates.TOO_LONG).alias("too_long"), F.count(F.lit(1)).alias("n_rows"))


@query("gate_clipping", f"""
WITH {SQL_ANNOTATED}
SELECT source, (count(*) FILTER (reason = 'audio: clipping detected'))::BIGINT AS rejected, count(*)::BIGINT AS n_rows FROM annotated GROUP BY source""")
def gate_clipping(spark, d):
    return _gate(spark, d, gates.CLIPPING)


@query("gate_audio", f"""
WITH {SQL_ANNOTATED}
SELECT source, (count(*) FILTER (reason = 'audio: no audio'))::BIGINT AS rejected, count(*)::BIGINT AS n_rows FROM annotated GROUP BY source""")
def gate_audio(spark, d):
    return _gate(spark, d, gates.NO_AUDIO)


@query("gate_text", """
SELECT d.source, count_if(coalesce(trim(regexp_extract(p.html, '(?s)<title>(.*?)</title>', 1)), '') = '')::BIGINT AS rejected, count(*)::BIGINT AS n_rows
FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id GROUP BY d.source""")
def gate_text(spark, d):
    """Documents whose transcript is the title of the page with their id; most have none."""
    titles = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"))
    rows = documents(spark, d).select("doc_id", "source").join(titles, "doc_id", "left")
    rows = rows.withColumn("text", txt.normalize_text(F.col("title"))).select(
        "source", "text", F.lit(None).cast("string").alias("error"), F.lit(RATE).alias("n_samples"), F.lit(0).alias("max_clip_run"))
    return gates.with_reason(rows, PARAMS).groupBy("source").agg(
        F.count_if(F.col("reason_code") == gates.EMPTY_TEXT).alias("rejected"), F.count(F.lit(1)).alias("n_rows"))


@query("route_rows", f"WITH {SQL_ANNOTATED} SELECT utt_id, reason, reason IS NULL AS is_kept FROM annotated")
def route_rows(spark, d):
    """Every row with its first reason, or kept."""
    return annotated(spark, d).select("utt_id", "reason", F.col("reason_code").isNull().alias("is_kept"))


@query("quality_filter", f"WITH {SQL_ANNOTATED} SELECT utt_id, snr_db, duration FROM kept WHERE snr_db > 20 AND duration > 1.0")
def quality_filter(spark, d):
    """A built corpus filtered by a consumer: both comparisons reach the Parquet scan."""
    saved = scratch_path(spark, "built")
    write_shards(kept(spark, d).select("utt_id", "source", "split", "snr_db", "duration"), saved, 4096, _COUNTS)
    return gates.quality_subset(spark.read.parquet(saved)).select("utt_id", "snr_db", "duration")


@query("join_meta_audio", """
SELECT doc_id, source, len(embedding)::BIGINT AS n_samples, length(text)::BIGINT AS n_chars FROM documents JOIN embeddings ON vec_id = doc_id""")
def join_meta_audio(spark, d):
    meta = documents(spark, d).select("doc_id", "source", long(F.char_length("text"), "n_chars"))
    audio = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), long(F.size("embedding"), "n_samples"))
    return joins.pair_audio(meta, audio, "doc_id").select("doc_id", "source", "n_samples", "n_chars")


@query("missing_audio", """
SELECT source, count(*)::BIGINT AS missing FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) GROUP BY source""")
def missing_audio(spark, d):
    audio = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return joins.missing_audio(documents(spark, d).select("doc_id", "source"), audio, "doc_id").groupBy("source").agg(
        F.count(F.lit(1)).alias("missing"))


@query("remaining_files", f"""
SELECT DISTINCT {SQL_CONFIG_OF_LANG} AS config, source AS split FROM documents
EXCEPT SELECT {SQL_CONFIG_OF_LANG}, source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1""")
def remaining_files(spark, d):
    """Pairs of configuration and split without a finished entry (here: without a toxic label)."""
    work = table(spark, d, "documents").select("doc_id", config_of_lang(F.col("lang")).alias("config"), F.col("source").alias("split"))
    done = work.join(table(spark, d, "labels").filter(F.col("toxic") == 1).select("doc_id"), "doc_id", "left_semi")
    return joins.remaining(work.select("config", "split").distinct(), done, ["config", "split"])


@query("row_index", """
SELECT doc_id, source, lang AS split, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1 AS row_index FROM documents""")
def row_index(spark, d):
    narrow = documents(spark, d).select("doc_id", "source", "split")
    return identity.with_row_index(narrow, ["source", "split"], "doc_id").select("doc_id", "source", "split", "row_index")


@query("file_index", """
SELECT doc_id, doc_id AS row_index FROM documents
UNION ALL SELECT page_id, page_id + (SELECT count(*) FROM documents) FROM pages""")
def file_index(spark, d):
    """Index from file and position in the file, over two files; no row is shuffled."""
    both = spark.read.schema("doc_id long, page_id long").parquet(f"{d}/documents.parquet", f"{d}/pages.parquet")
    rows = both.select(
        F.coalesce("doc_id", "page_id").alias("doc_id"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"))
    return identity.with_file_index(rows, []).select("doc_id", "row_index")


@query("global_index", """
SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS row_index FROM documents""")
def global_index(spark, d):
    """One counter over all files, in file order; here a source stands for a file."""
    narrow = documents(spark, d).select("doc_id", "source")
    return identity.with_row_index(narrow, [], "doc_id", files=["source"]).select("doc_id", "source", "row_index")


@query("dedup_first", """
SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedup_first(spark, d):
    """First of all rows with the same text; equal texts stand for equal ids."""
    rows = documents(spark, d).select("doc_id", "source", F.md5("text").alias("key"))
    return dedup.keep_first(rows, ["key"], ["doc_id"]).select("doc_id", "source")


@query("dedup_counts", "SELECT count(*)::BIGINT AS rows_before, count(DISTINCT md5(text))::BIGINT AS rows_after, (count(*) - count(DISTINCT md5(text)))::BIGINT AS removed FROM documents")
def dedup_counts(spark, d):
    return dedup.duplicate_counts(documents(spark, d).select(F.md5("text").alias("key")), ["key"])


@query("check_sample", "SELECT doc_id, source, lang AS split FROM documents ORDER BY doc_id LIMIT 50")
def check_sample(spark, d):
    """Head of the corpus for a look; the checks themselves cover all rows."""
    return documents(spark, d).select("doc_id", "source", "split").orderBy("doc_id").limit(50)


@query("next_index", "SELECT source, lang AS split, max(doc_id) + 1 AS next_index FROM documents GROUP BY source, lang")
def next_index(spark, d):
    """First free index of every split, read back from ids."""
    ids = documents(spark, d).select("source", "split", identity.utt_id(F.col("source"), F.col("split"), F.col("doc_id")).alias("utt_id"))
    return identity.next_index(ids, F.concat_ws("_", "source", "split", F.lit("")), ["source", "split"])


@query("check_unique", """
SELECT sum(n)::BIGINT AS total, count(*)::BIGINT AS distinct_ids, count_if(n > 1)::BIGINT AS repeated_ids, count_if(n > 1) = 0 AS is_unique
FROM (SELECT count(*) AS n FROM documents GROUP BY md5(text))""")
def check_unique(spark, d):
    return quality.uniqueness(documents(spark, d).select(F.md5("text").alias("utt_id")))


@query("verify_all", f"""
WITH {SQL_ANNOTATED}, good AS (SELECT * FROM annotated WHERE n IS NOT NULL)
SELECT source, split, 'sampling_rate' AS "check", count_if(sr <> 16)::BIGINT AS violations FROM good GROUP BY source, split
UNION ALL SELECT source, split, 'duration', count_if(NOT duration > 0) FROM good GROUP BY source, split
UNION ALL SELECT source, split, 'text', count_if(text = '') FROM good GROUP BY source, split
UNION ALL SELECT source, split, 'speaker_id', count_if(speaker_id = '') FROM good GROUP BY source, split
UNION ALL SELECT source, split, 'n_samples', count_if(n <> len(y)) FROM good GROUP BY source, split""")
def verify_all(spark, d):
    """All rows with a waveform, before the gates, so that the rate check has violations."""
    rows = annotated(spark, d, keep_samples=True, keep_text=True).filter(F.col("n_samples").isNotNull())
    rows = rows.withColumn("audio", F.struct(F.col("samples").alias("array"), F.col("target_sr").alias("sampling_rate")))
    return quality.verify_rows(rows, quality.row_checks(RATE))


@query("verify_schema", """
SELECT c AS "check", true AS passed, (SELECT count(*) FROM embeddings)::BIGINT AS n_rows
FROM (VALUES ('no_split_column'), ('no_external_path'), ('audio_is_struct'), ('no_path_values')) t(c)""")
def verify_schema(spark, d):
    """Schema checks of an exported split, and the null test on rows that still have a path field."""
    flat = table(spark, d, "embeddings").select(
        "vec_id", F.struct(F.col("embedding").alias("array"), F.lit(RATE).alias("sampling_rate")).alias("audio"))
    with_path = table(spark, d, "embeddings").select(F.struct(F.lit(None).cast("string").alias("path")).alias("audio"))
    total = flat.agg(F.count(F.lit(1)).alias("n_rows"))
    checked = total.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit(ok).alias("passed")) for name, ok in quality.verify_schema(flat)
    ])).alias("c"), "n_rows").select("c.check", "c.passed", "n_rows")
    paths = quality.external_paths(with_path).agg((F.count(F.lit(1)) == 0).alias("passed")).select(F.lit("no_path_values").alias("check"), "passed")
    return checked.unionByName(paths.crossJoin(total).select("check", "passed", "n_rows"))


@query("custom_stage", """
SELECT source, count(*)::BIGINT AS n_rows, sum(length(text) - length(replace(text, chr(10), '')))::BIGINT AS line_breaks FROM documents GROUP BY source""")
def custom_stage(spark, d):
    """A user's row function, run in Arrow batches inside the plan."""

    def count_breaks(batches):
        for pdf in batches:
            # ``.str`` would tie each batch into a reference cycle that stays until Python happens to collect it.
            yield pdf[["source"]].assign(breaks=pdf["text"].map(lambda t: t.count("\n"), na_action="ignore"))

    rows = documents(text_session(spark), d).select("source", "text").mapInPandas(count_breaks, "source string, breaks long")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("breaks").alias("line_breaks"))
