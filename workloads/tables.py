"""The given tables seen as a speech corpus.

``documents`` are transcripts (source, language as split, doc_id as position),
``embeddings`` are short waveforms of the document with the same id, and the
numbered sources take their settings from the registry.  Waveforms of 64
samples are read at 16 samples per second (4 s).  So that every gate has rows
to reject, four sources are read at other rates (0.25 s and 64 s) and the
clipping amplitude is 0.8.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import signal as sig
from voxloom.functions import text as txt
from voxloom.functions.arrow_signal import samples_stage
from voxloom.operators import gates, identity
from voxloom.operators.joins import apply_registry
from voxloom.session import spread
from voxloom.specs import REGISTRY, SignalParams

RATE = 16
PARAMS = SignalParams(target_sr=RATE, clip_ms=125.0, clip_amp=0.8)
FAST_SOURCES, SLOW_SOURCES = (3, 13), (5, 15)  # read at 256 and at 1 sample per second
FAST_RATE, SLOW_RATE = 256, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source in ``documents``: its registry entry and limits, by the number in its name.

    A source of another form (or null) has the limits of number 2.
    """
    rows = []
    for k, spec in enumerate(REGISTRY):
        rows.append({"_k": k, "registered": spec.name, "min_s": PARAMS.min_s, "max_s": spec.signal.max_s,
                     "_runs": [SignalParams(target_sr=r, max_s=spec.signal.max_s, clip_ms=PARAMS.clip_ms, clip_amp=PARAMS.clip_amp).min_run
                               for r in (RATE, FAST_RATE, SLOW_RATE)]})
    specs = spark.createDataFrame(pa.Table.from_pylist(rows), "_k int, registered string, min_s double, max_s double, _runs array<int>")
    number = F.coalesce(F.regexp_extract("source", r"^src(\d{1,9})$", 1).try_cast("int"), F.lit(2))
    sources = table(spark, sf_dir, "documents").select("source").distinct().withColumn("_n", number).withColumn("_k", F.col("_n") % len(REGISTRY))
    fast, slow = F.col("_n").isin(*FAST_SOURCES), F.col("_n").isin(*SLOW_SOURCES)
    return sources.join(F.broadcast(specs), "_k").select(
        "source", "registered", F.when(fast, FAST_RATE).when(slow, SLOW_RATE).otherwise(RATE).alias("target_sr"), "min_s", "max_s",
        F.when(fast, F.get("_runs", F.lit(1))).when(slow, F.get("_runs", F.lit(2))).otherwise(F.get("_runs", F.lit(0))).alias("min_run"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.col("lang").alias("split"), "text")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents for work that is heavy per text."""
    return spread(documents(spark, sf_dir))


def waveforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, speaker label, conditioned signal y`` as columns."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "label", F.col("embedding").alias("x"),
        sig.condition(F.col("embedding")).alias("y"))


def measured(spark: SparkSession, sf_dir: str, keep_samples: bool = False) -> DataFrame:
    """``doc_id, label`` and metrics from the Arrow stage, computed where the waveform is read."""
    stage = samples_stage(PARAMS, keep_samples, gate=False)
    return (
        table(spark, sf_dir, "embeddings")
        .select(F.col("vec_id").alias("doc_id"), "label", stage(F.col("embedding"), F.lit(RATE)).alias("_s"))
        .select("doc_id", "label", "_s.*")
    )


def text_measures(spark: SparkSession, sf_dir: str, keep_text: bool = False) -> DataFrame:
    """Narrow facts about each transcript, computed where the text is read."""
    normal = texts(spark, sf_dir).withColumn("text", txt.normalize_text(F.col("text")))
    return normal.select(
        "doc_id", "source", "split", *([F.col("text")] if keep_text else []),
        (F.col("text") == "").alias("no_text"),
        txt.num_chars(F.col("text")).alias("num_chars"), txt.num_words(F.col("text")).alias("num_words"))


def speaker(label: Column, source: Column) -> Column:
    return identity.speaker_from_column(label, source, "integer")


def annotated(spark: SparkSession, sf_dir: str, keep_samples: bool = False, keep_text: bool = False) -> DataFrame:
    """Every transcript with its metrics, limits and reason.

    Text and waveform are reduced to scalars before the join, so the shuffle
    carries neither unless asked to.
    """
    texts = apply_registry(text_measures(spark, sf_dir, keep_text), settings(spark, sf_dir))
    rows = texts.join(measured(spark, sf_dir, keep_samples), "doc_id", "left")
    text = F.when(F.col("no_text"), "").otherwise("x")
    n, rate, error = F.col("n_samples"), F.col("target_sr"), F.col("error")
    code = gates.reason_code(error, n, F.col("max_clip_run"), text, rate, F.col("min_s"), F.col("max_s"), F.col("min_run"))
    rows = rows.withColumn("reason_code", code)
    return rows.select(
        "doc_id", "source", "split", "registered", "target_sr",
        *([F.col("text")] if keep_text else []), *([F.col("samples")] if keep_samples else []),
        identity.utt_id(F.col("source"), F.col("split"), F.col("doc_id")).alias("utt_id"),
        speaker(F.col("label"), F.col("source")).alias("speaker_id"),
        "n_samples", sig.duration(n, rate).alias("duration"), "snr_db", "rms_db", "max_clip_run",
        "num_chars", "num_words",
        txt.speaking_rate(F.col("num_words"), n, rate).alias("speaking_rate"),
        txt.chars_per_sec(F.col("num_chars"), n, rate).alias("chars_per_sec"),
        "reason_code", gates.reason_text(F.col("reason_code"), error, n, rate).alias("reason"),
    )


def kept(spark: SparkSession, sf_dir: str, **keep: bool) -> DataFrame:
    return gates.kept(annotated(spark, sf_dir, **keep))


def long(column: str | Column, name: str | None = None) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return col.cast("long").alias(name or column)


def digits(samples: Column) -> Column:
    """Samples as one string of integers in units of 1e-5, comparable without float rules."""
    return F.array_join(F.transform(samples, lambda v: F.round(v.cast("double") * 100000).cast("long").cast("string")), " ")


# ---------------------------------------------------------------- SQL side
# Written from the definitions, not generated from the Spark plans above.

_WS = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


def sql_normal(expr: str) -> str:
    """Normalised text; the tables hold no compatibility characters, so NFC equals NFKC on them."""
    return (
        f"regexp_replace(regexp_replace(translate(nfc_normalize({expr}), 'كيةىؤأإء', 'کیهیواا'), '[ \\t]+', ' ', 'g'), "
        f"'^[{_WS}]+|[{_WS}]+$', '', 'g')"
    )


def sql_words(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '[^{_WS}]+'))"


def sql_ratio(numerator: str, denominator: str) -> str:
    return f"((({numerator})::HUGEINT * 20000 + ({denominator})) // (2 * ({denominator})))::DOUBLE / 10000"


SQL_SIGNAL = """
sig0 AS (SELECT vec_id, label, embedding AS x, len(embedding) AS n,
                list_sum(list_transform(embedding, lambda v: v::DOUBLE)) / len(embedding) AS m FROM embeddings),
sig1 AS (SELECT *, list_transform(x, lambda v: (v::DOUBLE - m)::FLOAT) AS c FROM sig0),
sig2 AS (SELECT *, list_max(list_transform(c, lambda v: abs(v))) AS p FROM sig1),
sig3 AS (SELECT *, CASE WHEN p > 0 THEN list_transform(c, lambda v: (v::DOUBLE / p::DOUBLE)::FLOAT) ELSE c END AS y FROM sig2),
sig4 AS (SELECT *, list_transform(y, lambda v: abs(v)::DOUBLE) AS a FROM sig3),
sig5 AS (SELECT *, list_sum(list_transform(a, lambda v: v * v)) / n AS sp,
                list_sum(list_transform(list_sort(a)[1:greatest(1, n // 10)], lambda v: v * v)) / greatest(1, n // 10) AS np,
                list_max(list_transform(string_split(array_to_string(list_transform(a,
                    lambda v: CASE WHEN v::FLOAT >= 0.8::FLOAT THEN '1' ELSE '0' END), ''), '0'), lambda s: len(s))) AS max_run
         FROM sig4),
signal AS (SELECT vec_id, label, n, y, max_run,
                  round(10 * log10(greatest(sp, 1e-10) / greatest(np, 1e-10)), 2) AS snr_db,
                  CASE WHEN sp > 0 THEN round(20 * log10(sqrt(sp)), 2) ELSE -120.0 END AS rms_db FROM sig5)
"""

SQL_SETTINGS = """
settings AS (SELECT source, CASE WHEN k IN (3, 13) THEN 256 WHEN k IN (5, 15) THEN 1 ELSE 16 END AS sr,
                    CASE WHEN k % 13 IN (0, 1, 8) THEN 30.0 ELSE 40.0 END::DOUBLE AS max_s,
                    CASE WHEN k IN (3, 13) THEN 32 WHEN k IN (5, 15) THEN 1 ELSE 2 END AS min_run
             FROM (SELECT DISTINCT source, substr(source, 4)::INT AS k FROM documents))
"""

SQL_ANNOTATED = f"""
{SQL_SIGNAL},
{SQL_SETTINGS},
texts AS (SELECT doc_id, source, lang AS split, {sql_normal('text')} AS text FROM documents),
joined AS (SELECT t.doc_id, t.source, t.split, t.text, s.sr, s.max_s, s.min_run, g.n, g.y, g.label, g.max_run, g.snr_db, g.rms_db,
                  length(t.text) AS num_chars, {sql_words('t.text')} AS num_words
           FROM texts t JOIN settings s USING (source) LEFT JOIN signal g ON g.vec_id = t.doc_id),
annotated AS (SELECT *, printf('%s_%s_%08d', source, split, doc_id) AS utt_id,
                     CASE WHEN coalesce(label, 0) = 0 THEN 'ds:' || source || '_unknown' ELSE 'ds:' || label END AS speaker_id,
                     {sql_ratio('n', 'sr')} AS duration,
                     {sql_ratio('num_words * sr', 'n')} AS speaking_rate,
                     {sql_ratio('num_chars * sr', 'n')} AS chars_per_sec,
                     CASE WHEN n IS NULL THEN 'audio: no audio'
                          WHEN n / sr < 0.3 THEN printf('audio: too short %.3fs', n / sr)
                          WHEN n / sr > max_s THEN printf('audio: too long %.1fs', n / sr)
                          WHEN max_run >= min_run THEN 'audio: clipping detected'
                          WHEN text = '' THEN 'empty text' END AS reason
              FROM joined),
kept AS (SELECT * FROM annotated WHERE reason IS NULL)
"""
