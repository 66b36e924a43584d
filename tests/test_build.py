import json
import shutil
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from signals import tone, wav, with_run
from voxloom.operators import joins, quality
from voxloom.plans import build as plan
from voxloom.plans import merge, pack, repair, report
from voxloom.sinks import files as sinks
from voxloom.sources import files, metadata, scan
from voxloom.specs import REGISTRY, SourceSpec, spec_for
from voxloom.streaming.incremental import IncrementalBuild

ENCODED = pa.struct([("bytes", pa.binary()), ("path", pa.string())])


def put(path: Path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


def encoded(*signals, **kw):
    return pa.array([None if s is None else {"bytes": s if isinstance(s, bytes) else wav(s, **kw), "path": "x.mp3"} for s in signals], ENCODED)


def kept(spark, paths):
    return sorted(plan.kept_rows(spark, paths).collect(), key=lambda r: r.utt_id)


def drops(spark, paths):
    return sorted((r.utt_id, r.reason) for r in spark.read.json(paths.drop_log).collect())


def test_prefix_splits_and_reasons(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw / "m522t/data/train-0.parquet", audio=encoded(tone(8000), tone(100), None), sentence=["سلام  دنيا", "b", "c"])
    put(raw / "m522t/data/train-1.parquet", audio=encoded(with_run(6000, 160), b"junk", tone(8000), tone(8000)), sentence=["d", "e", " ", "f g h"])
    put(raw / "m522t/data/test-0.parquet", audio=encoded(tone(16000)), sentence=["t"])
    paths = plan.build(spark, spec_for("m522t"), str(raw), out)
    rows = kept(spark, paths)
    assert [r.utt_id for r in rows] == ["m522t_test_00000000", "m522t_train_00000000", "m522t_train_00000006"]
    first = rows[1]
    assert (first.text, first.num_chars, first.num_words, first.n_samples) == ("سلام دنیا", 9, 2, 8000)
    assert first.duration == 0.5 and first.speaking_rate == 4.0 and first.speaker_id == "gen:m522t_spk0000"
    assert first.audio.sampling_rate == 16000 and len(first.audio.array) == 8000
    assert drops(spark, paths) == [
        ("m522t_train_00000001", "audio: too short 0.006s"), ("m522t_train_00000002", "audio: no audio"),
        ("m522t_train_00000003", "audio: clipping detected"), ("m522t_train_00000004", "audio: unsupported codec"),
        ("m522t_train_00000005", "empty text")]
    corpus = plan.kept_rows(spark, paths)
    assert [f.name for f in corpus.drop("source", "split").schema] == plan.UNIFIED_SCHEMA.fieldNames()
    assert all(corpus.schema[f.name].dataType.simpleString() == f.dataType.simpleString() for f in plan.UNIFIED_SCHEMA)
    assert quality.verify_rows(corpus, quality.row_checks()).agg(F.sum("violations")).head()[0] == 0
    counts = {(r.split): (r.rows_in, r.kept, r.dropped) for r in report.build_report(plan.staged(spark, paths)).collect()}
    assert counts == {"train": (7, 2, 5), "test": (1, 1, 0)}
    reasons = [(r.reason_class, r.n) for r in report.reason_histogram(plan.dropped_rows(spark, paths)).collect()]
    assert reasons == [("audio", 4), ("empty text", 1)]


def test_smoke_and_fallback_folder(spark, tmp_path):
    put(tmp_path / "raw/m522t/deep/er/train-0.parquet", audio=encoded(*[tone(8000)] * 6), sentence=list("abcdef"))
    paths = plan.build(spark, spec_for("m522t"), str(tmp_path / "raw"), str(tmp_path / "out"), smoke=2)
    assert [r.text for r in kept(spark, paths)] == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        scan.scan_source(spark, spec_for("vhdm"), str(tmp_path / "raw"))


def test_configs(spark, tmp_path):
    raw = tmp_path / "raw/srezas"
    put(raw / "common_voice_17/test-0.parquet", audio=encoded(tone(8000)), sentence=["a"])
    put(raw / "youtube/chan-0.parquet", audio=encoded(tone(8000), tone(8000)), sentence=["b", "c"])
    put(raw / "other/train-0.parquet", audio=encoded(tone(8000)), sentence=["d"])
    paths = plan.build(spark, spec_for("srezas"), str(tmp_path / "raw"), str(tmp_path / "out"))
    assert [(r.utt_id, r.speaker_id) for r in kept(spark, paths)] == [
        ("srezas_cv17_test_00000000", "gen:srezas_common_voice_17_spk0000"),
        ("srezas_other_train_00000000", "gen:srezas_other_spk0000"),
        ("srezas_youtube_chan_00000000", "gen:srezas_youtube_spk0000"), ("srezas_youtube_chan_00000001", "gen:srezas_youtube_spk0000")]


def test_lists_rates_and_limits(spark, tmp_path):
    signals = [tone(8000), tone(4000, rate=8000), [], None, tone(30 * 16000 + 1)]
    put(tmp_path / "raw/mana_tts/dataset/a.parquet", audio=pa.array([None if s is None else list(s) for s in signals], pa.list_(pa.float32())),
        samplerate=pa.array([None, "8000.0", "8000", None, "16000"]), transcript=list("abcde"), extra=list("zzzzz"))
    paths = plan.build(spark, spec_for("mana_tts"), str(tmp_path / "raw"), str(tmp_path / "out"))
    assert [(r.text, r.n_samples) for r in kept(spark, paths)] == [("a", 8000), ("b", 8000)]
    assert [d[1] for d in drops(spark, paths)] == ["no audio", "no audio", "too long 30.0s"]
    codes = {r.reason_code: r.n for r in report.code_histogram(plan.dropped_rows(spark, paths)).collect()}
    assert codes == {"no_audio": 2, "too_long": 1}
    assert [r.text for r in scan.iterate(plan.kept_rows(spark, paths).select("text").orderBy("text"))] == ["a", "b"]


def test_column_speaker_and_bytes(spark, tmp_path):
    put(tmp_path / "raw/hezarai_cv13/data/train-0.parquet", audio=encoded(tone(8000), tone(8000), tone(8000)), sentence=list("abc"), client_id=["u1", None, "  "])
    paths = plan.build(spark, spec_for("hezarai_cv13"), str(tmp_path / "raw"), str(tmp_path / "out"))
    assert [r.speaker_id for r in kept(spark, paths)] == ["ds:u1", "ds:hezarai_cv13_unknown", "ds:hezarai_cv13_unknown"]
    put(tmp_path / "raw/kiarash/x.parquet", audio=pa.array([wav(tone(8000)), b"", None], pa.binary()), text=list("abc"))
    paths = plan.build(spark, spec_for("kiarash"), str(tmp_path / "raw"), str(tmp_path / "out2"))
    assert [r.utt_id for r in kept(spark, paths)] == ["kiarash_train_00000000"]


def test_text_candidates_and_mixed_audio(spark, tmp_path):
    audio = pa.array([{"array": list(tone(8000)), "sampling_rate": 16000, "bytes": None}, {"array": None, "sampling_rate": None, "bytes": wav(tone(8000))},
                      {"array": None, "sampling_rate": None, "bytes": None}],
                     pa.struct([("array", pa.list_(pa.float32())), ("sampling_rate", pa.int32()), ("bytes", pa.binary())]))
    put(tmp_path / "raw/thomcles/x.parquet", audio=audio, sentence=[None, " ", "z"], transcript=["one", "two", "z"])
    paths = plan.build(spark, spec_for("thomcles"), str(tmp_path / "raw"), str(tmp_path / "out"))
    assert [(r.text, r.n_samples) for r in kept(spark, paths)] == [("one", 8000), ("two", 8000)]
    assert drops(spark, paths) == [("thomcles_train_00000002", "audio: no audio")]


def test_extra_stage(spark, tmp_path):
    put(tmp_path / "raw/m522t/data/train-0.parquet", audio=encoded(tone(8000), tone(8000)), sentence=["keep", "drop me"])

    def extra(df):
        reject = F.col("text").contains("drop")
        return df.withColumn("reason_code", F.when(reject, "user").otherwise(F.col("reason_code"))).withColumn(
            "reason", F.when(reject, "user: rule").otherwise(F.col("reason")))

    paths = plan.build(spark, spec_for("m522t"), str(tmp_path / "raw"), str(tmp_path / "out"), extra=extra)
    assert [r.text for r in kept(spark, paths)] == ["keep"]
    assert [d[1] for d in drops(spark, paths)] == ["user: rule"]


def test_self_contained_from_glued_metadata(spark, tmp_path):
    wavs = tmp_path / "wav"
    wavs.mkdir()
    for i in (1, 2, 4):
        (wavs / f"rec000{i}.wav").write_bytes(wav(tone(8000)))
    (tmp_path / "metadata.csv").write_text("rec0001|one\nrec0002|two rec0003|three\r\nrec0004|four\n", encoding="utf-8")
    meta = metadata.read_metadata(spark, str(tmp_path / "metadata.csv"))
    sounds = scan.binary_files(spark, str(wavs))
    joined = meta.join(sounds.select("id", "content"), "id").select("content", F.col("text").alias("sentence"))
    sinks.write_shards(sinks.embed_bytes(joined), str(tmp_path / "raw/pertts"), 1024)
    paths = plan.build(spark, spec_for("pertts"), str(tmp_path / "raw"), str(tmp_path / "out"))
    assert sorted(r.text for r in kept(spark, paths)) == ["four", "one", "two"]
    assert meta.join(sounds.select("id"), "id", "left_anti").count() == 1


FEED = SourceSpec("feed", "feed", ("text",), speaker="gen:feed_spk0000", split_rule="constant", index_scope="source")


def feed_file(root: Path, name: str, n: int, bad: int = 0):
    put(root / f"feed/{name}.parquet", audio=encoded(*[tone(8000)] * n, *[tone(10)] * bad), text=[f"{name} {i}" for i in range(n + bad)])


def state(job):
    return sorted((r.utt_id, r.text) for r in job.kept().collect())


def test_incremental_equals_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    for i, n in enumerate((3, 1, 4)):
        feed_file(raw, f"f{i}", n, bad=1)
    job = IncrementalBuild(spark, FEED, str(raw), str(tmp_path / "inc"), files_per_batch=1)
    job.run()
    paths = plan.build(spark, FEED, str(raw), str(tmp_path / "batch"))
    ids = [r.utt_id for r in kept(spark, paths)]
    assert len(state(job)) == len(ids) == 8
    everything = sorted(int(r.utt_id[-8:]) for r in job.rows().collect())
    assert everything == list(range(11))
    assert sorted(t for _, t in state(job)) == sorted(r.text for r in kept(spark, paths))
    totals = job.totals().orderBy("batch_id").collect()
    assert (totals[-1].total_kept, totals[-1].total_dropped) == (8, 3)
    assert job.remaining_files().count() == 0


def test_incremental_continues_and_survives_a_failure(spark, tmp_path):
    raw = tmp_path / "raw"
    feed_file(raw, "f0", 3)
    job = IncrementalBuild(spark, FEED, str(raw), str(tmp_path / "inc"), files_per_batch=1)
    job.run()
    before = state(job)
    feed_file(raw, "f1", 2)
    assert job.remaining_files().count() == 1

    class Broken(IncrementalBuild):
        def _write_progress(self, *_):
            raise RuntimeError("lost after the rows were written")

    broken = Broken(spark, FEED, str(raw), str(tmp_path / "inc"), files_per_batch=1)
    with pytest.raises(Exception, match="lost after"):
        broken.run()
    feed_file(raw, "f2", 2)
    again = IncrementalBuild(spark, FEED, str(raw), str(tmp_path / "inc"), files_per_batch=1)
    again.run()
    after = state(again)
    assert set(before) < set(after) and len(after) == 7
    assert [int(u[-8:]) for u, _ in after] == list(range(7))
    again.run(force=True)
    assert sorted(t for _, t in state(again)) == sorted(t for _, t in after)
    assert len(state(again)) == 7


def test_incremental_recovers_from_a_lost_checkpoint(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "inc"
    feed_file(raw, "f0", 3, bad=1)
    feed_file(raw, "f1", 2)
    job = IncrementalBuild(spark, FEED, str(raw), str(out), files_per_batch=1)
    job.run()
    before = state(job)

    class Lost(IncrementalBuild):
        """Finds no checkpoint where the first runs left theirs."""

        def _path(self, part, batch_id=None):
            return super()._path("another" if part == "checkpoint" else part, batch_id)

    # Rows of a batch that never finished.
    shutil.copytree(out / "rows/batch_id=1", out / "rows/batch_id=2")
    feed_file(raw, "f2", 2)
    for _ in range(2):
        Lost(spark, FEED, str(raw), str(out), files_per_batch=1).run()
    after = [r.utt_id for r in job.rows().collect()]
    assert len(after) == len(set(after)) == 8 and set(before) < set(state(job))
    assert spark.read.json(str(out / "drop_log")).count() == 1
    assert job.incomplete_files().count() == 0 and job.remaining_files().count() == 0


def test_incremental_file_names(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("a b", "c%20d", "e[1]", "f+g", "فارسی"):
        feed_file(raw, name, 1)
    job = IncrementalBuild(spark, FEED, str(raw), str(tmp_path / "inc"), files_per_batch=2)
    job.run()
    assert len(state(job)) == 5 and len({u for u, _ in state(job)}) == 5
    assert job.remaining_files().count() == 0


def test_splits_stay_text(spark, tmp_path):
    path = str(tmp_path / "corpus")
    rows = spark.createDataFrame([("a", s, "t", 4) for s in ("001", "01", "1")], "source string, split string, text string, n_samples int")
    out = merge.merge_corpus(spark, [rows], path).head()[0]
    assert json.loads(out) == {"splits": ["a_001", "a_01", "a_1"]}
    again = merge.merge_corpus(spark, [rows], path).head()[0]
    assert again == out and spark.read.parquet(path).count() == 3
    assert [r.split for r in scan.read_corpus(spark, path, split="001").collect()] == ["001"]


def test_corrupt_files(spark, tmp_path):
    root = tmp_path / "mixed"
    put(root / "good.parquet", doc=pa.array([1, 2, 3]))
    put(root / "empty.parquet", doc=pa.array([], pa.int64()))
    (root / "bad.parquet").write_bytes(b"PAR1 not really")
    got = {Path(r.file).name: (r.state, r.n_rows) for r in files.corrupt_files(spark, str(root), "doc long").collect()}
    assert got == {"good.parquet": ("readable", 3), "empty.parquet": ("empty", 0), "bad.parquet": ("corrupt", 0)}
    assert files.read_tolerant(spark, str(root), "doc long").count() == 3


def test_a_whole_footer_over_broken_pages(spark, tmp_path):
    import pyarrow.parquet as pq

    root = tmp_path / "my files [1] 100%"
    root.mkdir()
    for name, broken in (("half", (1, 2)), ("none", (0, 1, 2)), ("whole", ())):
        path = root / f"{name}.parquet"
        pq.write_table(pa.table({"doc": [f"text {i}" for i in range(3000)]}), path, row_group_size=1000, use_dictionary=False)
        raw = bytearray(path.read_bytes())
        for k in broken:
            at = pq.ParquetFile(path).metadata.row_group(k).column(0).data_page_offset
            raw[at:at + 200] = b"\xff" * 200
        path.write_bytes(raw)
    (root / "zero.parquet").write_bytes(b"")
    got = {Path(r.file).name: (r.state, r.n_rows) for r in files.corrupt_files(spark, scan.literal_path(str(root)), "doc string").collect()}
    assert got == {"half.parquet": ("partial", 1000), "none.parquet": ("corrupt", 0), "whole.parquet": ("readable", 3000)}


def test_merge_skips_saved_splits(spark, tmp_path):
    def part(source, split, n, **extra):
        rows = spark.range(n).select(F.lit(source).alias("source"), F.lit(split).alias("split"), F.lit("t").alias("text"), F.lit(4).alias("n_samples"))
        return rows.withColumns({k: F.lit(v) for k, v in extra.items()})

    path = str(tmp_path / "corpus")
    first = merge.merge_corpus(spark, [part("a", "train", 3, sampling_rate=1), part("a", "test", 2)], path).head()[0]
    assert json.loads(first) == {"splits": ["a_test", "a_train"]}
    second = merge.merge_corpus(spark, [part("a", "train", 30), part("b", "train", 5)], path, compact=True).head()[0]
    assert json.loads(second) == {"splits": ["a_test", "a_train", "b_train"]}
    got = {(r.source, r.split): r["count"] for r in spark.read.parquet(path).groupBy("source", "split").count().collect()}
    assert got == {("a", "train"): 3, ("a", "test"): 2, ("b", "train"): 5}
    assert "sampling_rate" not in spark.read.parquet(path).columns
    # A split whose merge broke off has a folder but no record: it is written again, whole.
    part("a", "001", 2).write.mode("append").partitionBy("source", "split").parquet(path)
    third = merge.merge_corpus(spark, [part("a", n, 7) for n in ("001", "01", "1", "x y%")], path).head()[0]
    assert json.loads(third) == {"splits": ["a_001", "a_01", "a_1", "a_test", "a_train", "a_x y%", "b_train"]}
    got = {(r.source, r.split): r["count"] for r in scan.read_corpus(spark, path).groupBy("source", "split").count().collect()}
    assert got == {("a", "train"): 3, ("a", "test"): 2, ("b", "train"): 5} | {("a", n): 7 for n in ("001", "01", "1", "x y%")}
    again = merge.merge_corpus(spark, [part("a", "001", 9)], path).head()[0]
    assert again == third and spark.read.parquet(path).count() == 38


def test_shards_stay_within_their_limits(spark, tmp_path):
    rows = spark.range(100).select("id", F.lit("x" * 1000).alias("text"), F.lit(250).alias("n_samples"))
    limit = sinks.rows_within(rows, max_bytes=9 * 2256)
    assert limit == 9
    sinks.write_shards(rows, str(tmp_path / "s"), limit)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) <= 9 and sum(sizes) == 100


def test_replace_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.replace_in_place(spark, path, spark.read.parquet(path).filter("id < 5"), refuse)
    assert spark.read.parquet(path).count() == 10
    sinks.replace_in_place(spark, path, spark.read.parquet(path).filter("id < 5"))
    assert spark.read.parquet(path).count() == 5


def test_registry():
    assert len(REGISTRY) == 13 and len({s.name for s in REGISTRY}) == 13
    assert {s.name for s in REGISTRY if s.signal.max_s == 30.0} == {"vhdm", "asr_fa_v1", "mana_tts"}
    assert all(s.signal.min_run == 160 for s in REGISTRY)
    assert np.isclose(spec_for("kiarash").signal.clip_amp, 0.999)


def test_incremental_configs(spark, tmp_path):
    raw = tmp_path / "raw/srezas"
    put(raw / "fleurs/test-0.parquet", audio=encoded(tone(8000)), sentence=["a"])
    put(raw / "youtube/chan-0.parquet", audio=encoded(tone(8000), tone(8)), sentence=["b", "c"])
    job = IncrementalBuild(spark, spec_for("srezas"), str(tmp_path / "raw"), str(tmp_path / "inc"), files_per_batch=1)
    job.run()
    put(raw / "youtube/chan-1.parquet", audio=encoded(tone(8000)), sentence=["d"])
    job.run()
    assert state(job) == [("srezas_fleurs_test_00000000", "a"), ("srezas_youtube_chan_00000000", "b"), ("srezas_youtube_chan_00000002", "d")]
    done = {(r.split): (r.rows_in, r.kept) for r in job.progress().groupBy("split").agg(F.sum("rows_in").alias("rows_in"), F.sum("kept").alias("kept")).collect()}
    assert done == {"fleurs_test": (1, 1), "youtube_chan": (3, 2)}


def test_dedup_table(spark, tmp_path):
    put(tmp_path / "raw/m522t/data/train-0.parquet", audio=encoded(*[tone(8000)] * 4), sentence=list("abcd"))
    paths = plan.build(spark, spec_for("m522t"), str(tmp_path / "raw"), str(tmp_path / "out"))
    corpus, good = str(tmp_path / "corpus"), plan.kept_rows(spark, paths)
    again = good.filter("text in ('a', 'b')").withColumn("text", F.lit("later"))
    good.coalesce(1).write.partitionBy("source", "split").parquet(corpus)
    again.coalesce(1).write.mode("append").partitionBy("source", "split").parquet(corpus)
    with pytest.raises(repair.CheckFailed, match="not unique"):
        repair.require_good(spark.read.parquet(corpus))
    counts = repair.dedup_table(spark, corpus)
    assert counts == {"rows_before": 6, "rows_after": 4, "removed": 2}
    assert spark.read.parquet(corpus).select("utt_id").distinct().count() == spark.read.parquet(corpus).count() == 4
    assert repair.failures(spark.read.parquet(corpus)) == []
    assert repair.dedup_table(spark, corpus)["removed"] == 0


def test_pack(spark, tmp_path):
    wavs = tmp_path / "wav"
    wavs.mkdir()
    (wavs / "rec0001.wav").write_bytes(wav(tone(8000)))
    (tmp_path / "metadata.csv").write_text("rec0001|one|more\nrec0002|two\n", encoding="utf-8")
    out = str(tmp_path / "raw/pertts/train")
    assert pack.pack(spark, str(tmp_path / "metadata.csv"), str(wavs), out) == 1
    assert pack.pack(spark, str(tmp_path / "metadata.csv"), str(wavs), out) is None
    (row,) = spark.read.parquet(out).collect()
    assert row.sentence == "one|more" and row.audio.path is None and row.audio.bytes[:4] == b"RIFF"


def test_resolve_paths(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"AAA")
    rows = spark.createDataFrame([(1, (b"x", "a.wav")), (2, (None, "deep/a.wav")), (3, (bytearray(), "b.wav")), (4, (None, None)), (5, None)],
                                 "i int, audio struct<bytes:binary,path:string>")
    got = {r.i: r.audio and r.audio.bytes and bytes(r.audio.bytes) for r in joins.resolve_paths(rows, scan.binary_files(spark, str(tmp_path))).collect()}
    assert got == {1: b"x", 2: b"AAA", 3: None, 4: None, 5: None}


def test_resolve_paths_with_equal_names(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.wav").write_bytes(folder.encode())
    rows = spark.createDataFrame([(1, (None, "x/a.wav")), (2, (None, "./y/a.wav")), (3, (None, "a.wav")), (4, (None, f"{tmp_path}/y/a.wav")), (5, (None, "z/a.wav"))],
                                 "i int, audio struct<bytes:binary,path:string>")
    got = [(r.i, r.audio.bytes and bytes(r.audio.bytes)) for r in joins.resolve_paths(rows, scan.binary_files(spark, str(tmp_path))).collect()]
    assert sorted(got) == [(1, b"x"), (2, b"y"), (3, None), (4, b"y"), (5, None)]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from voxloom.__main__ import main

    raw, out, corpus = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "corpus")
    put(tmp_path / "raw/m522t/data/train-0.parquet", audio=encoded(tone(8000), tone(8)), sentence=list("ab"))
    put(tmp_path / "raw/kiarash/x.parquet", audio=pa.array([wav(tone(8000))], pa.binary()), text=["c"])
    main(["profile", "--raw", raw])
    for source in ("m522t", "kiarash"):
        main(["build", source, "--raw", raw, "--out", out])
    main(["merge", "m522t", "kiarash", "--out", out, "--corpus", corpus])
    main(["report", "--corpus", corpus])
    main(["check", "--corpus", corpus])
    main(["dedup", "--corpus", corpus])
    text = capsys.readouterr().out
    assert '{"splits":["kiarash_train","m522t_train"]}' in text and "all checks passed" in text
    assert spark.read.parquet(corpus).count() == 2


def test_audio_in_outside_files(spark, tmp_path):
    (tmp_path / "wavs").mkdir()
    (tmp_path / "wavs/a.wav").write_bytes(wav(tone(8000)))
    audio = pa.array([{"bytes": wav(tone(16000)), "path": None}, {"bytes": None, "path": "x/a.wav"}, {"bytes": None, "path": "gone.wav"}], ENCODED)
    put(tmp_path / "raw/m522t/data/train-0.parquet", audio=audio, sentence=list("abc"))
    outside = scan.binary_files(spark, str(tmp_path / "wavs"))
    paths = plan.build(spark, spec_for("m522t"), str(tmp_path / "raw"), str(tmp_path / "out"), audio_files=outside)
    assert [(r.utt_id, r.n_samples) for r in kept(spark, paths)] == [("m522t_train_00000000", 16000), ("m522t_train_00000001", 8000)]
    assert drops(spark, paths) == [("m522t_train_00000002", "audio: no audio")]


def test_unreadable_raw_files(spark, tmp_path):
    raw = tmp_path / "raw"
    feed_file(raw, "f0", 2)
    feed_file(raw, "f2", 1)
    (raw / "feed/f1.parquet").write_bytes(b"PAR1 broken")
    with pytest.raises(Exception):
        plan.build(spark, FEED, str(raw), str(tmp_path / "strict"))
    paths = plan.build(spark, FEED, str(raw), str(tmp_path / "out"), tolerant=True)
    assert len(kept(spark, paths)) == 3
    job = IncrementalBuild(spark, FEED, str(raw), str(tmp_path / "inc"), files_per_batch=1, tolerant=True)
    job.run()
    assert len(state(job)) == 3
    assert [Path(r.file).name for r in job.remaining_files().collect()] == ["f1.parquet"]
