"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import signal as sig
from voxloom.operators.joins import apply_registry, resolve_paths
from voxloom.session import materialized, scratch_path
from voxloom.sources import drift, files, metadata, profile, scan
from voxloom.specs import AUDIO_FIELDS, CONFIG_SHORT, REGISTRY, spec_for

from . import query
from .tables import FAST_RATE, SLOW_RATE, SQL_SETTINGS, documents, long, settings, table

TEXT_TABLES = ("documents", "conversations", "benchmark")


def _text_files(spark, d):
    return scan.scan_parquet(spark, [f"{d}/{t}.parquet" for t in TEXT_TABLES], "text string")


@query("scan_parquet", """
SELECT count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS n_chars
FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations UNION ALL SELECT text FROM benchmark)""")
def scan_parquet(spark, d):
    """Several files read as one table with a given schema."""
    return _text_files(spark, d).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"))


@query("scan_pruned", "SELECT lang, count(*)::BIGINT AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY lang")
def scan_pruned(spark, d):
    """Two of five columns; the text is not read."""
    return table(spark, d, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars"))


@query("split_from_filename", """
SELECT split, count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS n_chars
FROM (SELECT 'documents' AS split, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations
      UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY split""")
def split_from_filename(spark, d):
    return _text_files(spark, d).select(scan.split_from_file().alias("split"), "text").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("text")).alias("n_chars"))


# Language of a document -> configuration folder it is filed under.
CONFIG_OF_LANG = {"en": "youtube", "fr": "fleurs", "de": "yazdi_accent", "es": "common_voice_17"}


def config_of_lang(lang):
    pairs = F.create_map(*[F.lit(v) for pair in CONFIG_OF_LANG.items() for v in pair])
    return F.coalesce(F.element_at(pairs, lang), F.lit("other"))


SQL_CONFIG_OF_LANG = "CASE lang WHEN 'en' THEN 'youtube' WHEN 'fr' THEN 'fleurs' WHEN 'de' THEN 'yazdi_accent' WHEN 'es' THEN 'common_voice_17' ELSE 'other' END"


@query("scan_configs", f"""
SELECT config, CASE config WHEN 'common_voice_17' THEN 'cv17' WHEN 'yazdi_accent' THEN 'yazdi' ELSE config END || '_part' AS split,
       count(*)::BIGINT AS n_rows, sum(length(sentence))::BIGINT AS n_chars
FROM (SELECT {SQL_CONFIG_OF_LANG} AS config, text AS sentence FROM documents) GROUP BY config""")
def scan_configs(spark, d):
    """One scan over a folder per configuration; files and folders name split and configuration."""
    raw = f"{scratch_path(spark, 'configs')}/{spec_for('srezas').path}"
    (table(spark, d, "documents").select(config_of_lang(F.col("lang")).alias("config"), F.col("text").alias("sentence"))
     .write.partitionBy("config").parquet(raw))
    # Read with an explicit schema and folder pattern, so the folder name is not taken as a partition column.
    rows = scan.with_origin(scan.scan_parquet(spark, f"{raw}/*", "sentence string"), spec_for("srezas"))
    return rows.groupBy("config", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.char_length("sentence")).alias("n_chars"))


@query("constant_split", "SELECT 'train' AS split, source, count(*)::BIGINT AS n_rows FROM documents GROUP BY source")
def constant_split(spark, d):
    """Flat sources have one split by rule."""
    rows = table(spark, d, "documents").select(scan.split_for(spec_for("kiarash")).alias("split"), "source")
    return rows.groupBy("split", "source").agg(F.count(F.lit(1)).alias("n_rows"))


@query("binary_files", """
SELECT event_type AS id, sum(octet_length(encode(props)) + 1)::BIGINT AS n_bytes, sum(octet_length(encode(props)) + 1)::BIGINT AS length
FROM events GROUP BY event_type""")
def binary_files(spark, d):
    """Raw bytes of many files, one row per file; here text files cut to a bounded size."""
    raw = scratch_path(spark, "binary")
    (table(spark, d, "events").select("event_type", F.col("props").alias("value"))
     .write.partitionBy("event_type").option("maxRecordsPerFile", 100_000).text(raw))
    read = scan.binary_files(spark, raw, "*.txt")
    kind = F.regexp_extract("path", r"event_type=([^/]+)/", 1)
    return read.groupBy(kind.alias("id")).agg(
        F.sum(F.octet_length("content")).cast("long").alias("n_bytes"), F.sum("length").alias("length"))


@query("resolve_audio_paths", """
SELECT doc_id, CASE WHEN vec_id IS NULL THEN NULL WHEN doc_id % 3 = 0 THEN 'a' || doc_id WHEN doc_id % 3 = 2 THEN 'u' || doc_id END AS content
FROM documents LEFT JOIN (SELECT DISTINCT vec_id FROM embeddings) ON vec_id = doc_id""")
def resolve_audio_paths(spark, d):
    """Rows that name a file by path or by base name; a base name that lies in two folders is no match."""
    ids = table(spark, d, "embeddings").select("vec_id").distinct()
    kinds = F.array(*[F.struct(F.lit(a).alias("folder"), F.lit(b).alias("mark")) for a, b in (("a/", "a"), ("b/", "b"), ("c/u", "u"))])
    present = ids.select("vec_id", F.explode(kinds).alias("k")).select(
        F.concat(F.lit("/audio/"), "k.folder", "vec_id", F.lit(".wav")).alias("path"), F.concat("k.mark", "vec_id").cast("binary").alias("content"))
    lead = F.when(F.col("doc_id") % 3 == 0, "a/").when(F.col("doc_id") % 3 == 2, "u").otherwise("")
    rows = table(spark, d, "documents").select("doc_id", F.struct(
        F.lit(None).cast("binary").alias("bytes"), F.concat(lead, "doc_id", F.lit(".wav")).alias("path")).alias("audio"))
    return resolve_paths(rows, present).select("doc_id", F.col("audio.bytes").cast("string").alias("content"))


@query("parse_glued_records", """
SELECT conv_id, count(*)::BIGINT AS n_records, sum(length(text))::BIGINT AS n_chars,
       min(printf('conv%06d_%d', conv_id, turn)) AS first_id
FROM (SELECT conv_id, turn, replace(replace(replace(text, '|', ' '), chr(10), ' '), chr(13), ' ') AS text FROM conversations)
GROUP BY conv_id""")
def parse_glued_records(spark, d):
    """Lines that each hold the glued ``id|text`` records of two neighbouring turns."""
    clean = F.translate("text", "|\n\r", "   ")
    record = F.concat(F.format_string("conv%06d_%d", "conv_id", "turn"), F.lit("|"), clean)
    turns = table(spark, d, "conversations").select("conv_id", F.col("turn"), record.alias("record"))
    # A pair of turns is at most a few records; the odd one stays alone.
    lines = turns.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pair")).agg(
        F.max_by("record", F.when(F.col("turn") % 2 == 0, 1)).alias("even"),
        F.max_by("record", F.when(F.col("turn") % 2 == 1, 1)).alias("odd"),
    ).select("conv_id", F.concat(F.coalesce("even", F.lit("")), F.coalesce("odd", F.lit(""))).alias("value"))
    return metadata.parse_glued_records(lines).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.char_length("text")).alias("n_chars"), F.min("id").alias("first_id"))


@query("read_split", "SELECT doc_id, source, lang AS split, length(text)::BIGINT AS n_chars FROM documents WHERE source = 'src1' AND lang = 'en'")
def read_split(spark, d):
    """One split of a saved corpus: only its folder is listed and read."""
    saved = scratch_path(spark, "corpus")
    documents(spark, d).write.partitionBy("source", "split").parquet(saved)
    return scan.read_corpus(spark, saved, "src1", "en").select(
        "doc_id", "source", "split", long(F.char_length("text"), "n_chars"))


@query("source_registry", f"""
WITH {SQL_SETTINGS}
SELECT list_extract(['vhdm','asr_fa_v1','hezarai_cv13','seyedali','pourmand','m522t','mshojaei','kiarash','mana_tts',
                     'gpt_informal','thomcles','srezas','pertts'], substr(source, 4)::INT % 13 + 1) AS source,
       max(s.max_s) AS max_s, count(*)::BIGINT AS n_rows, count(DISTINCT source)::BIGINT AS n_feeds
FROM documents JOIN settings s USING (source) GROUP BY 1""")
def source_registry(spark, d):
    """Registry entries with the rows that the tables hold for each."""
    feeds = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    named = apply_registry(feeds, settings(spark, d).select("source", "registered")).groupBy(
        F.col("registered").alias("source")).agg(
        F.sum("n").cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_feeds"))
    return apply_registry(named, scan.registry_frame(spark)).select("source", "max_s", "n_rows", "n_feeds")


@query("profile_sources", """
SELECT 'documents' AS source, NULL::VARCHAR AS audio_field, 'none' AS audio_kind, 'text' AS text_column, count(*)::BIGINT AS n_rows,
       count_if(text <> '')::BIGINT AS n_text, 0::BIGINT AS n_audio, NULL::BIGINT AS min_length, NULL::BIGINT AS max_length FROM documents
UNION ALL SELECT 'embeddings', 'embedding', 'list of floats', NULL, count(*), 0, count(embedding), min(len(embedding)), max(len(embedding)) FROM embeddings
UNION ALL SELECT 'pages', NULL, 'none', 'html', count(*), count_if(html <> ''), 0, NULL, NULL FROM pages
UNION ALL SELECT 'conversations', NULL, 'none', 'text', count(*), count_if(text <> ''), 0, NULL, NULL FROM conversations""")
def profile_sources(spark, d):
    """What each table holds: audio field, representation, text column, lengths."""
    wanted = (("documents", "text"), ("embeddings", "text"), ("pages", "html"), ("conversations", "text"))
    parts = [profile.profile(table(spark, d, t), t, c, (*AUDIO_FIELDS, "embedding")) for t, c in wanted]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("columns")


@query("smoke_limit", """
SELECT source, split, doc_id FROM (SELECT source, lang AS split, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents)
WHERE rn <= 5""")
def smoke_limit(spark, d):
    """First five rows of every split."""
    return scan.head_per_split(documents(spark, d).select("source", "split", "doc_id"), 5, ["source", "split"], ["doc_id"])


@query("source_rate", f"""
WITH {SQL_SETTINGS}
SELECT doc_id, CASE s.sr WHEN 256 THEN 256 WHEN 1 THEN 16000 ELSE 16 END::BIGINT AS rate FROM documents JOIN settings s USING (source)""")
def source_rate(spark, d):
    """Rates given as numbers in text, with the default where there is none."""
    raw = F.when(F.col("target_sr") == FAST_RATE, "256.0").when(F.col("target_sr") == SLOW_RATE, F.lit(None)).otherwise("16")
    rows = apply_registry(documents(spark, d).select("doc_id", "source"), settings(spark, d))
    return rows.select("doc_id", long(sig.source_rate(raw), "rate"))


@query("config_short", f"""
SELECT CASE config WHEN 'common_voice_17' THEN 'cv17' WHEN 'yazdi_accent' THEN 'yazdi' ELSE config END AS short, count(*)::BIGINT AS n_rows
FROM (SELECT {SQL_CONFIG_OF_LANG} AS config FROM documents) GROUP BY 1""")
def config_short(spark, d):
    rows = table(spark, d, "documents").select(config_of_lang(F.col("lang")).alias("config"))
    return rows.groupBy(scan.config_short(F.col("config"), CONFIG_SHORT).alias("short")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("corrupt_files", """
SELECT 'readable' AS state, true AS some_files, (SELECT count(*) FROM documents)::BIGINT AS n_rows
UNION ALL SELECT 'corrupt', true, 0""")
def corrupt_files(spark, d):
    """Unreadable files are reported, the rows of the others are kept."""
    root = scratch_path(spark, "mixed")
    table(spark, d, "documents").select("doc_id", "text").write.parquet(f"{root}/good")
    table(spark, d, "events").select("props").write.text(f"{root}/bad")
    state = files.corrupt_files(spark, [f"{root}/good", f"{root}/bad"], "doc_id long, text string").filter("state <> 'empty'")
    return state.groupBy("state").agg(
        (F.count(F.lit(1)) > 0).alias("some_files"), F.sum("n_rows").cast("long").alias("n_rows"))


@query("checked_files", """
SELECT call, state, some_files, n_rows FROM (VALUES (1), (2), (3)) AS c(call), (
    SELECT 'readable' AS state, true AS some_files, (SELECT count(*) FROM documents)::BIGINT AS n_rows
    UNION ALL SELECT 'corrupt', true, 0) WHERE call < 3
UNION ALL SELECT 3, 'readable', true, (SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark)
UNION ALL SELECT 3, 'corrupt', true, 0""")
def checked_files(spark, d):
    """Verdicts on files, kept by path, length and time; the second call has nothing to open, the third only new files."""
    root = scratch_path(spark, "checked")
    table(spark, d, "documents").select("doc_id", "text").write.parquet(f"{root}/good")
    table(spark, d, "events").select("props").write.text(f"{root}/bad")
    out = None
    for call in (1, 2, 3):
        if call == 3:
            table(spark, d, "benchmark").select(F.lit(0).cast("long").alias("doc_id"), "text").write.mode("append").parquet(f"{root}/good")
        state = files.checked_files(spark, [f"{root}/good", f"{root}/bad"], "doc_id long, text string", f"{root}-verdicts").filter("state <> 'empty'")
        part = state.groupBy("state").agg((F.count(F.lit(1)) > 0).alias("some_files"), F.sum("n_rows").cast("long").alias("n_rows"))
        part = materialized(part.select(F.lit(call).alias("call"), "*"), "verdicts")
        out = part if out is None else out.unionByName(part)
    return out


def _drifting(spark, d):
    """A source whose files hold ids of two widths, lack a column, and hold waveforms as lists or structs."""
    root = scratch_path(spark, "drift")
    folder = f"{root}/{spec_for('m522t').path}"
    wave = F.col("embedding").cast("array<float>")
    rows = table(spark, d, "embeddings").select("vec_id", F.concat(F.lit("text "), "vec_id").alias("sentence"), wave.alias("audio"))
    part = rows.filter("vec_id % 3 = 0")
    part.write.mode("append").parquet(folder)
    part = rows.filter("vec_id % 3 = 1").withColumn("vec_id", F.col("vec_id").cast("int"))
    part.withColumn("audio", F.struct(F.col("audio").alias("array"), F.lit(16000).alias("sampling_rate"))).write.mode("append").parquet(folder)
    rows.filter("vec_id % 3 = 2").drop("sentence").write.mode("append").parquet(folder)
    return root, folder


@query("schema_groups", """
SELECT 'm522t' AS source, vec_id % 3 = 1 AS is_struct, vec_id % 3 <> 2 AS has_text, true AS some_files, count(*)::BIGINT AS n_rows
FROM embeddings GROUP BY ALL""")
def schema_groups(spark, d):
    """Files grouped by the schema in their footers."""
    _, folder = _drifting(spark, d)
    groups = drift.schema_groups(drift.footers(spark, folder).withColumn("source", F.lit("m522t")).filter("n_rows > 0"), "source")
    return groups.select("source", F.contains("schema", F.lit("sampling_rate")).alias("is_struct"),
                         F.contains("schema", F.lit("sentence")).alias("has_text"), (F.col("n_files") > 0).alias("some_files"), "n_rows")


@query("scan_by_schema", """
SELECT vec_id, CASE WHEN vec_id % 3 <> 2 THEN 'text ' || vec_id END AS sentence, 16000.0::DOUBLE AS rate, len(embedding)::BIGINT AS n_samples
FROM embeddings""")
def scan_by_schema(spark, d):
    """The same files read as one table, each with its own schema."""
    root, _ = _drifting(spark, d)
    rows = drift.scan_by_schema(spark, spec_for("m522t"), root, known=f"{root}-footers")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "sentence", F.col("audio.sampling_rate").alias("rate"),
                       long(F.size("audio.array"), "n_samples"))


@query("apply_registry", f"""
WITH {SQL_SETTINGS}
SELECT source, lang AS split, max(s.max_s) AS max_s, max(s.sr)::BIGINT AS target_sr, max(s.min_run)::BIGINT AS min_run, count(*)::BIGINT AS n_rows
FROM documents JOIN settings s USING (source) GROUP BY source, lang""")
def apply_registry_query(spark, d):
    """Settings of each row's source, by a broadcast of the registry."""
    rows = apply_registry(documents(spark, d).select("source", "split"), settings(spark, d))
    return rows.groupBy("source", "split").agg(
        F.max("max_s").alias("max_s"), long(F.max("target_sr"), "target_sr"), long(F.max("min_run"), "min_run"),
        F.count(F.lit(1)).alias("n_rows"))


assert len(REGISTRY) == 13
