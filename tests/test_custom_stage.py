"""The row function of ``custom_stage`` holds one small batch at a time."""

import gc
import weakref

import pandas as pd

from workloads import rows


def stage_of(spark, tmp_path, monkeypatch, texts):
    """The row function, and the settings it runs with."""
    data = [(k, f"src{k % 2}", "en", t) for k, t in enumerate(texts)]
    spark.createDataFrame(data, "doc_id long, source string, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    kind = type(spark.range(1))
    plain = kind.mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, fn, schema: seen.append((fn, self.sparkSession)) or plain(self, fn, schema))
    return rows.custom_stage(spark, str(tmp_path)), *seen[0]


def test_batches_are_freed_when_they_are_done(spark, tmp_path, monkeypatch):
    result, fn, session = stage_of(spark, tmp_path, monkeypatch, ["a\nb\n", None, "", "c", "\n", None])
    frames = []

    def batches():
        for _ in range(4):
            pdf = pd.DataFrame({"source": ["s"] * 3, "text": ["x\ny" * 10, None, "z"]})
            frames.append((weakref.ref(pdf), weakref.ref(pdf["text"])))
            yield pdf
            del pdf

    gc.collect()
    gc.disable()
    try:
        counts = [int(out["breaks"].sum()) for out in fn(batches())]
        alive = [r() is not None for pair in frames[:-1] for r in pair]
    finally:
        gc.enable()
    assert counts == [10] * 4 and not any(alive)
    assert int(session.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
    assert sorted(map(tuple, result.collect())) == [("src0", 3, 3), ("src1", 3, 0)]
