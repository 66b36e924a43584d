"""Audio by path or id: contents are read in place, whatever the number of rows."""

import re

import pytest
from pyspark.sql import functions as F

from voxloom.operators import joins
from voxloom.plans import pack
from voxloom.sources import scan


@pytest.fixture
def sounds(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for i in range(60):
        (tmp_path / "s" / f"f{i} [{i % 3}].wav").write_bytes(f"sound {i}".encode())
    return tmp_path / "s"


def named(spark, n):
    """Half of the rows name one file."""
    i = F.when(F.col("id") < n // 2, F.lit(7)).otherwise(F.col("id") % 70)
    path = F.format_string("x/f%d [%d].wav", i, i % 3)
    return spark.range(n, numPartitions=4).select(
        F.col("id").alias("i"), F.repeat(F.lit("t"), 30).alias("text"),
        F.struct(F.when(F.col("id") % 10 == 1, F.lit(b"own")).alias("bytes"), path.alias("path")).alias("audio"))


def want(n):
    out = {}
    for i in range(n):
        f = 7 if i < n // 2 else i % 70
        out[i] = b"own" if i % 10 == 1 else f"sound {f}".encode() if f < 60 else None
    return out


@pytest.mark.parametrize("limits", [{}, {"max_rows": 50}, {"max_bytes": 12_000}])
@pytest.mark.parametrize("by_loader", [True, False])
def test_resolve_in_chunks(spark, sounds, monkeypatch, limits, by_loader):
    asked = []

    def load(paths):
        asked.append(len(paths))
        return scan.binary_content(spark, paths)

    files = scan.binary_files(spark, str(sounds))
    got = joins.resolve_paths(named(spark, 400), files, load=load if by_loader else None, **limits)
    assert got.columns == ["i", "text", "audio"]
    assert {r.i: r.audio.bytes and bytes(r.audio.bytes) for r in got.collect()} == want(400) and got.count() == 400
    if by_loader and limits:
        # Every file once, and the hot one at most once a chunk.
        assert len(asked) > 1 and sum(asked) <= 60 + len(asked)


def test_a_chunk_stays_within_its_bound(spark, sounds, monkeypatch):
    seen = []
    monkeypatch.setattr(joins.F, "broadcast", lambda df: seen.append(df) or df)
    list(joins.content_chunks(named(spark, 400).select("i", F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("i") % 2 + 1).cast("int")).alias("k")),
                              "k", scan.binary_files(spark, str(sounds)), max_rows=40))
    parts = [df.count() for df in seen if "i" in df.columns]
    assert sum(parts) == 400 and max(parts) <= 40


def no_content_in_exchanges(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Exchange" in line:
            assert "content" not in line and "audio" not in line
    assert not re.search(r"SortMergeJoin.*content|ShuffledHashJoin.*content", text) and "BroadcastHashJoin" in text


def test_no_exchange_carries_content(spark, sounds):
    files = scan.binary_files(spark, str(sounds))
    rows = named(spark, 40).select("i", F.concat(F.lit("f"), "i").alias("k"))
    (one,) = joins.content_chunks(rows, "k", files)
    no_content_in_exchanges(one)
    for part in joins.content_chunks(rows, "k", files, lambda p: scan.binary_content(spark, [str(sounds)]), max_rows=10):
        no_content_in_exchanges(part)


def test_pack_in_chunks(spark, sounds, tmp_path):
    lines = [f"f{i} [{i % 3}]|sentence {i}" for i in range(70)]
    (tmp_path / "metadata.csv").write_text("\n".join(lines), encoding="utf-8")
    out = str(tmp_path / "out")
    assert pack.pack(spark, str(tmp_path / "metadata.csv"), str(sounds), out, max_rows=15) == 10
    rows = spark.read.parquet(out).collect()
    assert sorted((r.sentence, bytes(r.audio.bytes)) for r in rows) == sorted((f"sentence {i}", f"sound {i}".encode()) for i in range(60))


def test_pack_that_broke_off_is_no_table(spark, sounds, tmp_path, monkeypatch):
    (tmp_path / "metadata.csv").write_text("f0 [0]|a\n", encoding="utf-8")
    out = str(tmp_path / "out")
    monkeypatch.setattr(pack, "write_shards", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pack.pack(spark, str(tmp_path / "metadata.csv"), str(sounds), out)
    monkeypatch.undo()
    assert pack.pack(spark, str(tmp_path / "metadata.csv"), str(sounds), out) == 0
    assert spark.read.parquet(out).count() == 1
