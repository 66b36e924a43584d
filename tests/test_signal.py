import numpy as np
import pytest
from pyspark.sql import functions as F

from signals import measures, tone, wav, with_run
from voxloom.functions import codec
from voxloom.functions import signal as sig
from voxloom.functions.arrow_signal import bytes_stage, longest_runs, resample_column, samples_stage
from voxloom.operators import gates
from voxloom.specs import SignalParams

PARAMS = SignalParams()


def frame(spark, signals, rate=16000, kind="array<float>"):
    rows = [(i, None if x is None else np.asarray(x).tolist(), rate) for i, x in enumerate(signals)]
    return spark.createDataFrame(rows, f"i int, x {kind}, rate int")


def staged(spark, signals, params=PARAMS, **kw):
    rows = frame(spark, signals).select("i", samples_stage(params, **kw)(F.col("x"), F.col("rate")).alias("s")).select("i", "s.*")
    return sorted(rows.collect(), key=lambda r: r.i)


def reasons(spark, signals, text="x", params=PARAMS):
    rows = frame(spark, signals).select("i", samples_stage(params)(F.col("x"), F.col("rate")).alias("s")).select("i", "s.*")
    out = gates.with_reason(rows.withColumn("text", F.lit(text)), params).select("i", "reason_code", "reason").collect()
    return [(r.reason_code, r.reason) for r in sorted(out, key=lambda r: r.i)]


def test_silence_is_kept(spark):
    (row,) = staged(spark, [np.zeros(16000)])
    assert (row.rms_db, row.snr_db, row.max_clip_run, row.n_samples) == (-120.0, 0.0, 0, 16000)
    assert reasons(spark, [np.zeros(16000)]) == [(None, None)]


def test_duration_limits(spark):
    got = reasons(spark, [tone(4799), tone(4800), tone(640000), tone(640001)])
    assert [g[0] for g in got] == [gates.TOO_SHORT, None, None, gates.TOO_LONG]
    assert got[0][1] == "audio: too short 0.300s" and got[3][1] == "audio: too long 40.0s"
    assert [g[0] for g in reasons(spark, [tone(480000), tone(480001)], params=SignalParams(max_s=30.0))] == [None, gates.TOO_LONG]


def test_clipping_needs_one_long_run(spark):
    got = reasons(spark, [with_run(6000, 159), with_run(6000, 160), with_run(6000, 80, 80)])
    assert [g[0] for g in got] == [None, gates.CLIPPING, None]


def test_gate_order(spark):
    assert reasons(spark, [None, []], text="") == [(gates.NO_AUDIO, "audio: no audio")] * 2
    assert reasons(spark, [tone(100)], text="")[0][0] == gates.TOO_SHORT
    assert reasons(spark, [tone(8000)], text="") == [(gates.EMPTY_TEXT, "empty text")]


def test_offset_does_not_matter(spark):
    a, b = staged(spark, [tone(8000), tone(8000) + np.float32(0.5)])
    assert abs(a.snr_db - b.snr_db) <= 0.02 and abs(a.rms_db - b.rms_db) <= 0.01
    assert np.allclose(a.samples, b.samples, atol=1e-5)


def test_peak_is_one(spark):
    rng = np.random.default_rng(1)
    for row in staged(spark, [rng.normal(0, s, 9000) for s in (1e-4, 1, 100)] + [np.zeros(9000)]):
        assert np.abs(row.samples).max() in (0.0, 1.0)


def test_forms_agree_with_plain_numpy(spark):
    rng = np.random.default_rng(7)
    lengths = [1, 2, 9, 10, 11, 64, 64, 333, 5000]
    signals = [rng.normal(0.1, 0.3, n).astype(np.float32) for n in lengths]
    params = SignalParams(clip_amp=0.6)
    arrow = staged(spark, signals, params, gate=False)
    y = frame(spark, signals).withColumn("y", sig.condition(F.col("x")))
    hof = sorted(y.select("i", sig.snr_db(F.col("y")).alias("snr_db"), sig.rms_db(F.col("y")).alias("rms_db"),
                          sig.max_clip_run(F.col("y"), 0.6).alias("run"), "y").collect(), key=lambda r: r.i)
    for x, a, h in zip(signals, arrow, hof):
        want = measures(x, 0.6)
        assert a.max_clip_run == h.run == want["max_clip_run"]
        assert a.snr_db == pytest.approx(want["snr_db"], abs=0.02) and h.snr_db == pytest.approx(a.snr_db, abs=0.011)
        assert a.rms_db == pytest.approx(want["rms_db"], abs=0.02) and h.rms_db == pytest.approx(a.rms_db, abs=0.011)
        assert a.samples == h.y


def test_downmix(spark):
    rows = spark.createDataFrame([([[1.0, 3.0], [2.0, 4.0], [0.0, 0.0]],)], "x array<array<float>>")
    assert rows.select(sig.downmix(F.col("x"))).head()[0] == [2.0, 3.0, 0.0]
    assert rows.select(sig.downmix(F.col("x"), "first")).head()[0] == [1.0, pytest.approx(7 / 3)]
    flat = spark.createDataFrame([([1.0, 3.0, 2.0, 4.0],)], "x array<float>")
    assert flat.select(sig.downmix_interleaved(F.col("x"), 2)).head()[0] == [2.0, 3.0]


def test_source_rate(spark):
    rows = spark.createDataFrame([(None,), ("44100.0",), ("8000",), ("fast",)], "r string")
    assert [r[0] for r in rows.select(sig.source_rate(F.col("r"))).collect()] == [16000, 44100, 8000, None]


def test_bad_rates_and_empty_arrays(spark):
    assert [r.error for r in staged(spark, [tone(8000)], gate=False)] == [None]
    bad = frame(spark, [tone(8000)]).select(samples_stage(PARAMS)(F.col("x"), F.lit(None).cast("int")).alias("s")).head()[0]
    assert bad.error == "bad rate None"
    empty = spark.createDataFrame([([],)], "x array<float>")
    got = empty.select(sig.mean(F.col("x")).alias("m"), sig.condition(F.col("x")).alias("y"), sig.max_clip_run(F.col("x"), 0.9).alias("r")).head()
    assert (got.m, got.y, got.r) == (None, [], 0)


@pytest.mark.parametrize("fmt, step", [("u8", 1 / 100), ("s16", 1 / 32000), ("s24", 1 / 8e6), ("s32", 1e-7), ("f32", 1e-7)])
def test_wav_formats(fmt, step):
    x = tone(500)
    got, rate = codec.decode_wav(wav(x, 22050, fmt))
    assert rate == 22050 and got.shape == (500, 1)
    assert np.abs(got[:, 0] - x).max() <= step


def test_bytes_stage(spark):
    x, stereo = tone(8000), np.stack([tone(8000), -0.5 * tone(8000)], axis=1)
    cells = [wav(x), wav(stereo), b"ID3 not a wave", b"", None, wav(x)[:20], wav(tone(16000, rate=32000), 32000)]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c binary")
    got = sorted(rows.select("i", bytes_stage(PARAMS)(F.col("c")).alias("s")).select("i", "s.*").collect(), key=lambda r: r.i)
    assert [r.error for r in got] == [None, None, "unsupported codec", "no audio", "no audio", "incomplete wav", None]
    assert np.allclose(got[0].samples, got[1].samples, atol=1e-3)
    assert got[6].n_samples == 8000


def test_user_decoder(spark):
    def decode(data):
        return np.frombuffer(data, "<f4"), 16000

    rows = spark.createDataFrame([(tone(8000).astype("<f4").tobytes(),)], "c binary")
    got = rows.select(bytes_stage(PARAMS, decoder=decode)(F.col("c")).alias("s")).head()[0]
    assert got.error is None and got.n_samples == 8000


@pytest.mark.parametrize("rate", [8000, 22050, 44100, 48000])
def test_resampled_sine(rate):
    got = codec.resample(tone(rate, 440.0, rate), rate, 16000)
    want = tone(16000, 440.0, 16000)
    assert len(got) == 16000
    assert np.abs(got[200:-200] - want[200:-200]).max() < 2e-3


@pytest.mark.parametrize("rate", [16001, 44101, 12345])
def test_odd_ratios(rate):
    got = codec.resample(tone(rate, 440.0, rate), rate, 16000)
    assert len(got) == 16000 and np.abs(got[200:-200] - tone(16000, 440.0)[200:-200]).max() < 2e-3


@pytest.mark.parametrize("rate, target", [(44100, 16000), (8000, 16000), (48000, 16000), (16, 1), (1, 16), (7, 16)])
def test_both_resampling_forms_agree(rate, target):
    rng = np.random.default_rng(rate)
    for n in (1, 5, 63, 1000, 20011):
        x = rng.normal(0, 0.2, n).astype(np.float32)
        common = np.gcd(rate, target)
        n_out = codec.resampled_length(n, rate, target)
        if n_out == 0:
            assert len(codec.resample(x, rate, target)) == 0
            continue
        plain = codec._resample_by_phase(x, target // common, rate // common, n_out, 32, 9.0)
        got = codec.resample(x, rate, target)
        assert got.shape == (n_out,) and np.allclose(got, plain, atol=2e-6)


def test_longest_runs():
    rng = np.random.default_rng(2)
    for share in (0.0, 0.2, 0.9, 1.0):
        mask = rng.random((40, 25)) < share
        want = [max((len(r) for r in "".join("x" if v else " " for v in row).split()), default=0) for row in mask]
        assert longest_runs(mask).tolist() == want


def test_resample_removes_what_does_not_fit():
    high = codec.resample(tone(48000, 12000.0, 48000), 48000, 16000)
    assert np.abs(high[200:-200]).max() < 1e-3


def test_resample_column_bypass(spark):
    rows = frame(spark, [tone(1600)], rate=16000).unionByName(frame(spark, [tone(800, rate=8000)], rate=8000))
    out = rows.select("rate", "x", resample_column(F.col("x"), F.col("rate"), 16000).alias("y")).collect()
    for r in out:
        assert len(r.y) == 1600
        if r.rate == 16000:
            assert r.y == r.x
