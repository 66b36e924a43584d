"""Waveform functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import signal as sig
from voxloom.functions.arrow_signal import decode_stage, resample_column
from voxloom.operators.blocks import time_blocks
from voxloom.operators.joins import apply_registry
from voxloom.operators.runs import with_run_length
from voxloom.plans.build import rebuild_audio as rebuild

from . import query
from .tables import (
    PARAMS, RATE, SQL_ANNOTATED, SQL_SETTINGS, SQL_SIGNAL, digits, documents, long, measured, settings, table, waveforms,
)


def _sql_digits(samples: str) -> str:
    return f"array_to_string(list_transform({samples}, lambda v: round(v::DOUBLE * 100000)::BIGINT), ' ')"


@query("downmix", f"""
SELECT vec_id, {_sql_digits("list_transform(range(1, len(embedding) // 2 + 1), lambda i: ((embedding[2 * i - 1]::DOUBLE + embedding[2 * i]::DOUBLE) / 2)::FLOAT)")} AS samples
FROM embeddings""")
def downmix(spark, d):
    """Interleaved samples as two channels, averaged."""
    return table(spark, d, "embeddings").select(
        "vec_id", digits(sig.downmix_interleaved(F.col("embedding"), 2)).alias("samples"))


@query("dc_remove", f"WITH {SQL_SIGNAL} SELECT vec_id, {_sql_digits('c')} AS samples FROM sig1")
def dc_remove(spark, d):
    return table(spark, d, "embeddings").select("vec_id", digits(sig.dc_remove(F.col("embedding"))).alias("samples"))


@query("peak_normalize", f"WITH {SQL_SIGNAL} SELECT vec_id, round(p::DOUBLE, 6) AS peak_before, {_sql_digits('y')} AS samples FROM sig3")
def peak_normalize(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", sig.dc_remove(F.col("embedding")).alias("c"))
    return rows.select(
        "vec_id", F.round(sig.peak(F.col("c")).cast("double"), 6).alias("peak_before"),
        digits(sig.peak_normalize(F.col("c"))).alias("samples"))


@query("duration", f"WITH {SQL_ANNOTATED} SELECT doc_id, duration FROM annotated WHERE n IS NOT NULL")
def duration(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.size("embedding").alias("n"))
    rated = apply_registry(documents(spark, d).select("doc_id", "source"), settings(spark, d))
    return rated.join(rows, "doc_id").select("doc_id", sig.duration(F.col("n"), F.col("target_sr")).alias("duration"))


@query("max_clip_run", f"WITH {SQL_SIGNAL} SELECT vec_id, max_run::BIGINT AS max_clip_run FROM signal")
def max_clip_run(spark, d):
    return waveforms(spark, d).select(
        F.col("doc_id").alias("vec_id"), long(sig.max_clip_run(F.col("y"), PARAMS.clip_amp), "max_clip_run"))


@query("snr_db", f"WITH {SQL_SIGNAL} SELECT vec_id, snr_db FROM signal")
def snr_db(spark, d):
    return waveforms(spark, d).select(F.col("doc_id").alias("vec_id"), sig.snr_db(F.col("y")).alias("snr_db"))


@query("rms_db", f"WITH {SQL_SIGNAL} SELECT vec_id, rms_db FROM signal")
def rms_db(spark, d):
    return waveforms(spark, d).select(F.col("doc_id").alias("vec_id"), sig.rms_db(F.col("y")).alias("rms_db"))


@query("signal_stage", f"WITH {SQL_SIGNAL} SELECT vec_id, n::BIGINT AS n_samples, max_run::BIGINT AS max_clip_run, snr_db, rms_db FROM signal")
def signal_stage(spark, d):
    """The same metrics from the Arrow stage that long waveforms use."""
    return measured(spark, d).select(
        F.col("doc_id").alias("vec_id"), long("n_samples"), long("max_clip_run"), "snr_db", "rms_db")


CLIP_VALUE = 20.0  # events at or above this value count as clipped
CLIP_RUN = 2


@query("clip_window", f"""
WITH w AS (SELECT user_id, value >= {CLIP_VALUE} AS hot,
                  sum((value >= {CLIP_VALUE})::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {CLIP_RUN - 1} PRECEDING AND CURRENT ROW) AS run
           FROM events)
SELECT user_id, count(*)::BIGINT AS n, count_if(hot)::BIGINT AS n_clipped, count_if(run >= {CLIP_RUN})::BIGINT AS clipped_windows,
       max(run) >= {CLIP_RUN} AS clipping FROM w GROUP BY user_id""")
def clip_window(spark, d):
    """Windows of consecutive clipped values in long, uneven series, cut into spans of time."""
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    hot = F.col("value") >= CLIP_VALUE
    order = ["ts", "event_id"]
    runs = with_run_length(time_blocks(rows, ["user_id"], "ts", order), ["user_id"], order, hot)
    return runs.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(hot).alias("n_clipped"),
        F.count_if(F.col("run_length") >= CLIP_RUN).alias("clipped_windows"),
        (F.max("run_length") >= CLIP_RUN).alias("clipping"))


@query("rebuild_audio", f"SELECT vec_id, {RATE}::BIGINT AS sampling_rate, {_sql_digits('embedding')} AS samples FROM embeddings")
def rebuild_audio(spark, d):
    """Audio struct from the flat layout."""
    flat = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("audio_flat"), F.lit(RATE).alias("sampling_rate"))
    return rebuild(flat).select("vec_id", long("audio.sampling_rate", "sampling_rate"), digits(F.col("audio.array")).alias("samples"))


def le_hex(value, n_bytes: int):
    """Little-endian hex of a non-negative integer."""
    text = F.lpad(F.hex(value.cast("long")), 2 * n_bytes, "0")
    return F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(n_bytes))])


def pcm16(samples):
    return F.transform(samples, lambda v: F.round(v.cast("double") * 32767).cast("long"))


def wav_bytes(samples, rate: int):
    """WAVE bytes (16-bit mono) of float samples, as a Column expression for making inputs."""
    body = F.array_join(F.transform(pcm16(samples), lambda s: le_hex(F.pmod(s, F.lit(65536)), 2)), "")
    size = F.size(samples) * 2
    header = F.concat(
        F.lit("52494646"), le_hex(size + 36, 4), F.lit("57415645666D7420"), le_hex(F.lit(16), 4), le_hex(F.lit(1), 2),
        le_hex(F.lit(1), 2), le_hex(F.lit(rate), 4), le_hex(F.lit(rate * 2), 4), le_hex(F.lit(2), 2), le_hex(F.lit(16), 2),
        F.lit("64617461"), le_hex(size, 4))
    return F.unhex(F.concat(header, body))


def encoded(spark, d, rate: int = RATE):
    return table(spark, d, "embeddings").select(F.col("vec_id"), wav_bytes(F.col("embedding"), rate).alias("content"))


@query("decode_wav_job", f"""
SELECT vec_id, {RATE}::BIGINT AS sampling_rate, 1::BIGINT AS channels, len(embedding)::BIGINT AS n_samples,
       array_to_string(list_transform(embedding, lambda v: round(v::DOUBLE * 32767)::BIGINT), ' ') AS samples FROM embeddings""")
def decode_wav_job(spark, d):
    """WAVE bytes to samples in Arrow tasks."""
    rows = encoded(spark, d).select("vec_id", decode_stage()(F.col("content")).alias("a")).select("vec_id", "a.*")
    steps = F.transform("samples", lambda v: F.round(v.cast("double") * 32768).cast("long").cast("string"))
    return rows.select(
        "vec_id", long("sampling_rate"), long("channels"), long(F.size("samples"), "n_samples"),
        F.array_join(steps, " ").alias("samples"))


@query("resample_job", f"""
WITH {SQL_SETTINGS}
SELECT vec_id, (len(embedding) * {RATE} // s.sr)::BIGINT AS n_samples, CASE WHEN s.sr = {RATE} THEN {_sql_digits('embedding')} END AS unchanged
FROM embeddings JOIN documents ON doc_id = vec_id JOIN settings s USING (source)""")
def resample_job(spark, d):
    """Rate conversion where the rate differs; the other rows bypass the worker."""
    rated = apply_registry(documents(spark, d).select("doc_id", "source"), settings(spark, d)).select("doc_id", "target_sr")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding").join(rated, "doc_id")
    out = rows.select(F.col("doc_id").alias("vec_id"), "target_sr", resample_column(F.col("embedding"), F.col("target_sr"), RATE).alias("s"))
    return out.select("vec_id", long(F.size("s"), "n_samples"), F.when(F.col("target_sr") == RATE, digits(F.col("s"))).alias("unchanged"))


@query("audio_dispatch", f"""
SELECT vec_id, kind, len(embedding)::BIGINT AS n_samples, kind = 'none' AS failed
FROM (SELECT vec_id, CASE WHEN label IN (0, 1, 2) THEN 'array' WHEN label = 3 THEN 'none' ELSE 'bytes' END AS kind,
             CASE WHEN label = 3 THEN NULL ELSE embedding END AS embedding FROM embeddings)""")
def audio_dispatch(spark, d):
    """Audio structs that hold samples, encoded bytes or neither."""
    from voxloom.plans.build import signal_column
    from voxloom.specs import SourceSpec

    label = F.col("label")
    rows = table(spark, d, "embeddings").select(
        "vec_id",
        F.when(label < 3, "array").when(label == 3, "none").otherwise("bytes").alias("kind"),
        F.struct(
            F.when(label < 3, F.col("embedding")).alias("array"), F.lit(RATE).alias("sampling_rate"),
            F.when(label > 3, wav_bytes(F.col("embedding"), RATE)).alias("bytes"),
        ).alias("audio"))
    spec = SourceSpec("mixed", "mixed", ("text",), signal=PARAMS)
    return rows.select("vec_id", "kind", signal_column(rows, spec, keep_samples=False).alias("s")).select(
        "vec_id", "kind", long("s.n_samples", "n_samples"), F.col("s.error").isNotNull().alias("failed"))
