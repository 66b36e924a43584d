"""Files of unequal schema, and verdicts that are remembered."""

import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from signals import tone, wav
from voxloom.plans import build as plan
from voxloom.sources import drift, files
from voxloom.sources.scan import literal_path
from voxloom.specs import SourceSpec

SPEC = SourceSpec("shift", "shift", ("sentence",), speaker="gen:one")


def put(path: Path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "raw" / "shift" / "data"
    clip = tone(16000)
    put(folder / "train-0.parquet", sentence=["a", "b"], audio=pa.array([{"bytes": wav(clip), "path": "x"}] * 2))
    put(folder / "train-1.parquet", audio=pa.array([{"array": clip.tolist(), "sampling_rate": 16000}]), sentence=["c"], extra=[1])
    put(folder / "train-2.parquet", sentence=["d", "e"], audio=pa.array([clip.tolist(), None], pa.list_(pa.float64())))
    put(folder / "train-3.parquet", audio=pa.array([wav(clip)], pa.binary()), sentence=["f"])
    return tmp_path / "raw"


@pytest.mark.parametrize("by_ranges", [True, False])
def test_groups_do_not_depend_on_column_order(spark, tmp_path, monkeypatch, by_ranges):
    monkeypatch.setattr(drift, "ranges_readable", lambda *_: by_ranges)
    put(tmp_path / "s" / "a.parquet", x=[1, 2], y=["u", "v"])
    put(tmp_path / "s" / "b.parquet", y=["w"], x=[3])
    put(tmp_path / "s" / "c.parquet", y=["w"], x=pa.array([3], pa.int32()))
    put(tmp_path / "s" / "d.parquet", x=pa.array([], pa.int64()), y=pa.array([], pa.string()))
    (tmp_path / "s" / "e.parquet").write_bytes(b"PAR1 not really")
    got = drift.schema_groups(drift.footers(spark, str(tmp_path / "s"))).collect()
    assert sorted((g.n_files, g.n_rows, g.schema is None) for g in got) == [(1, 0, True), (1, 1, False), (3, 3, False)]


def test_known_footers_are_not_opened_again(spark, tmp_path, monkeypatch):
    folder, known = tmp_path / "s", str(tmp_path / "known")
    put(folder / "a.parquet", x=[1, 2])
    first = drift.footers(spark, str(folder), known=known).collect()
    # Same length and time, other content: a file that is opened again would say so.
    raw, at = (folder / "a.parquet").read_bytes(), (folder / "a.parquet").stat()
    (folder / "a.parquet").write_bytes(b"x" * len(raw))
    os.utime(folder / "a.parquet", ns=(at.st_atime_ns, at.st_mtime_ns))
    assert drift.footers(spark, str(folder), known=known).collect() == first
    put(folder / "b.parquet", x=[3])
    assert sorted(r.n_rows for r in drift.footers(spark, str(folder), known=known).collect()) == [1, 2]
    (folder / "a.parquet").unlink()  # what is gone is no longer told
    assert [r.n_rows for r in drift.footers(spark, str(folder), known=known).collect()] == [1]


def test_build_of_a_source_whose_files_differ(spark, root, tmp_path):
    paths = plan.build(spark, SPEC, str(root), str(tmp_path / "out"), by_schema=True)
    kept = sorted((r.text, r.n_samples, r.audio.sampling_rate) for r in plan.kept_rows(spark, paths).collect())
    assert kept == [(t, 16000, 16000) for t in "abcdf"]
    assert [r.reason for r in plan.dropped_rows(spark, paths).collect()] == ["audio: no audio"]
    ids = [r.utt_id for r in plan.staged(spark, paths).select("utt_id").collect()]
    assert sorted(ids) == [f"shift_train_{i:08d}" for i in range(6)]


def test_broken_files_and_too_many_schemas(spark, root, monkeypatch):
    (root / "shift" / "data" / "train-4.parquet").write_bytes(b"PAR1 not really")
    with pytest.raises(ValueError, match="train-4"):
        drift.scan_by_schema(spark, SPEC, str(root))
    rows = drift.scan_by_schema(spark, SPEC, str(root), tolerant=True)
    assert rows.count() == 6 and sorted(r[0] for r in rows.select("extra").collect() if r[0]) == [1]
    monkeypatch.setattr(drift, "MAX_SCHEMAS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        drift.scan_by_schema(spark, SPEC, str(root), tolerant=True)


def test_a_plan_without_shuffle(spark, root):
    plan_text = drift.scan_by_schema(spark, SPEC, str(root)).select("sentence")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan_text and "audio" not in plan_text


@pytest.mark.parametrize("by_ranges", [True, False])
def test_verdicts_are_remembered(spark, tmp_path, monkeypatch, by_ranges):
    monkeypatch.setattr(files, "ranges_readable", lambda *_: by_ranges)
    folder, known = tmp_path / "my [1] s", str(tmp_path / "known")
    put(folder / "good.parquet", doc=[1, 2, 3])
    put(folder / "empty.parquet", doc=pa.array([], pa.int64()))
    (folder / "bad.parquet").write_bytes(b"PAR1 not really")
    def told():
        return {Path(r.file).name: (r.state, r.n_rows) for r in files.checked_files(spark, literal_path(str(folder)), "doc long", known).collect()}

    want = {"good.parquet": ("readable", 3), "empty.parquet": ("empty", 0), "bad.parquet": ("corrupt", 0)}
    assert told() == want
    with monkeypatch.context() as m:
        m.setattr(files, "corrupt_files", lambda *_: pytest.fail("opened again"))
        assert told() == want
    put(folder / "new.parquet", doc=[4])
    opened = []
    check = files.corrupt_files
    monkeypatch.setattr(files, "corrupt_files", lambda s, names, *a: opened.extend(names) or check(s, names, *a))
    assert told() == want | {"new.parquet": ("readable", 1)}
    assert [Path(n).name for n in opened] == ["new.parquet"]
