"""Tables that grow with the input are not broadcast by Spark's guess of their size."""

import numpy as np
import pytest

from voxloom.llm import common, components, neardup


def texts(n, seed=1):
    """Texts of 30 words; every third is a near copy of the one before."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = list(map(str, rng.integers(0, 100_000, 30)))
        if i % 3 == 2:
            words = [*out[-1].split()[:-1], "changed"]
        out.append(" ".join(words))
    return out


def broadcasts(plans, label):
    return [p for name, p in plans if name == label and "BroadcastExchange" in p]


@pytest.mark.parametrize("repeated", [False, True])
def test_exploded_bands_are_not_broadcast(spark, monkeypatch, repeated):
    plans, keep = [], neardup.saved

    def seen(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, label)

    monkeypatch.setattr(neardup, "saved", seen)
    rows = list(enumerate(texts(60)))
    rows += [(0, "some other words of the first id")] if repeated else []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = neardup.keep_one(docs, k=3, percent=80)
    assert sorted(map(tuple, kept.collect())) == [r for r in sorted(rows) if r[0] % 3 != 2]
    labels = [name for name, _ in plans]
    assert {"buckets", "members", "sets", "links"} <= set(labels) and ("representatives" in labels) == repeated
    for label in ("buckets", "members", "representatives"):
        assert not broadcasts(plans, label)
    # The pairs are not sent; the sets of the few classes that share a bucket may be.
    assert not any("BuildLeft" in p for name, p in plans if name == "links")


def test_many_links_meet_by_a_shuffle(spark, monkeypatch):
    plans, keep = [], components.saved

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(components, "saved", seen)
    monkeypatch.setattr(common, "FEW_ROWS", 10, raising=False)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.node: r.component for r in components.components(links).collect()} == {i: 0 for i in range(1, 41)}
    assert len(plans) > 2 and not any("BroadcastExchange" in p for p in plans)
