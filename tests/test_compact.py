"""Joining small files by stored bytes, without a shuffle."""

import pytest
from pyspark.sql import functions as F

from voxloom.plans import compact, merge
from voxloom.sources.scan import read_keyed


def test_bins():
    files = [("a", 9), ("b", 5), ("c", 4), ("d", 1), ("e", 12), ("f", 6)]
    assert compact.bins(files, 10) == [["a", "d"], ["f", "c"]]
    assert compact.bins(files, 1) == [] and compact.bins([], 10) == []
    assert sum(len(b) for b in compact.bins([(str(i), 1) for i in range(1000)], 30)) == 1000


@pytest.fixture
def rows(spark):
    return spark.range(400, numPartitions=8).select(
        F.format_string("%s", F.element_at(F.array(F.lit("001"), F.lit("01"), F.lit("1")), (F.col("id") % 3 + 1).cast("int"))).alias("split"),
        F.lit("s").alias("source"), F.col("id").cast("string").alias("text"), F.array_repeat(F.col("id").cast("float"), 50).alias("samples"), F.lit(50).alias("n_samples"))


def files_of(spark, path):
    return {k: len(compact.data_files(spark, f.toString())) for k, f in merge.split_folders(spark, path).items()}


def test_merge_joins_files_and_keeps_rows(spark, rows, tmp_path):
    path = str(tmp_path / "corpus")
    merge.merge_corpus(spark, [rows], path, compact=True)
    assert files_of(spark, path) == {("s", "001"): 1, ("s", "01"): 1, ("s", "1"): 1}
    back = read_keyed(spark, path).select(rows.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_target_bounds_the_files(spark, rows, tmp_path):
    loose, tight = str(tmp_path / "loose"), str(tmp_path / "tight")
    merge.merge_corpus(spark, [rows], loose)
    sizes = [n for f in merge.split_folders(spark, loose).values() for _, n in compact.data_files(spark, f.toString())]
    merge.merge_corpus(spark, [rows], tight, compact=True, target_bytes=3 * max(sizes))
    assert all(1 < n <= 5 for n in files_of(spark, tight).values()), (sizes, files_of(spark, tight))
    assert read_keyed(spark, tight).count() == 400


def test_no_exchange_above_the_audio_scan(spark, rows, tmp_path):
    rows.drop("source", "split").write.parquet(str(tmp_path / "f"))
    files = compact.data_files(spark, str(tmp_path / "f"))
    scan = compact.packed_scan(spark, rows.drop("source", "split").schema, compact.bins(files, 3 * files[0][1]))
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Coalesce 1" in text
    assert scan.rdd.getNumPartitions() == len(compact.bins(files, 3 * files[0][1])) > 1


def test_broken_merge_is_done_again(spark, rows, tmp_path, monkeypatch):
    """A run that broke off between new and old files left rows twice; the split isn't recorded, so it is written again."""
    path = str(tmp_path / "corpus")

    def breaks(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(merge, "compact_folder", breaks)
    with pytest.raises(OSError):
        merge.merge_corpus(spark, [rows], path, compact=True)
    monkeypatch.undo()
    folder = merge.split_folders(spark, path)["s", "001"].toString()
    spark.read.parquet(folder).write.mode("append").parquet(folder)
    merge.merge_corpus(spark, [rows], path, compact=True)
    assert read_keyed(spark, path).count() == 400


def test_split_names_stay_text_in_the_command_line(spark, tmp_path, capsys):
    from argparse import Namespace

    from voxloom import __main__ as cli

    path = str(tmp_path / "c")
    columns = {"utt_id": F.col("id").cast("string"), "source": F.lit("s"), "speaker_id": F.lit("ds:1"), "duration": F.lit(2.0), "snr_db": F.lit(30.0),
               "rms_db": F.lit(-20.0), "speaking_rate": F.lit(3.0), "text": F.lit("a"), "n_samples": F.lit(2).cast("int"),
               "audio": F.struct(F.array(F.lit(0.5).cast("float"), F.lit(0.1).cast("float")).alias("array"), F.lit(16000).alias("sampling_rate"))}
    split = F.element_at(F.array(F.lit("001"), F.lit("01"), F.lit("1")), (F.col("id") % 3 + 1).cast("int"))
    spark.range(9).select(*[c.alias(n) for n, c in columns.items()], split.alias("split")).write.partitionBy("source", "split").parquet(path)
    cli.cmd_report(spark, Namespace(corpus=path))
    shown = capsys.readouterr().out
    assert all(any(cell.strip() == name for line in shown.splitlines() for cell in line.split("|")) for name in ("001", "01", "1"))
    cli.cmd_check(spark, Namespace(corpus=path))
    assert "all checks passed" in capsys.readouterr().out
