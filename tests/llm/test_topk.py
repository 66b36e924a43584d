"""Exact top-k search against brute force with Python's integers."""

import math
from collections import defaultdict

import numpy as np
import pytest

from voxloom.llm import topk
from voxloom.llm.common import prepared

SCHEMA = "vec_id long, embedding array<double>, tile long, Shard int, ids string, query_id long"


def plain(rows, asks, k):
    vectors = defaultdict(list)
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) or not math.isfinite(64 * x) for x in v):
            continue
        vectors[i].append([math.floor(64 * x) for x in v])
    out = []
    for q in vectors:
        if not asks(q):
            continue
        scores = {}
        for i, own in vectors.items():
            s = [sum(a * b for a, b in zip(x, y)) for x in vectors[q] for y in own if len(x) == len(y)]
            if i != q and s:
                scores[i] = max(max(-topk.LIMIT, min(topk.LIMIT, n)) for n in s)
        top = sorted(scores.items(), key=lambda e: (-e[1], e[0]))[:k]
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(top)]
    return sorted(out)


def found(spark, rows, k, **kw):
    prepared(spark)
    df = spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in topk.search(df, df.filter("vec_id % 3 = 0"), k, **kw).collect())


def hard_vectors():
    rng = np.random.default_rng(3)
    same = [0.5, -0.25, 1.0, 0.0]
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(i, same) for i in range(300, 450)]
    rows += [(i, (rng.normal(size=4) * 10.0 ** e).tolist()) for e in (3, 6, 9, 12, 25, 300) for i in range(1000 + e * 10, 1006 + e * 10)]
    rows += [(3, same), (3, same), (3, [9.0, 9.0, 9.0, 9.0]), (7, None), (None, same), (9, [0.0] * 4), (12, [None, 1.0, 1.0, 1.0]),
             (15, [math.nan, 1.0, 1.0, 1.0]), (18, [math.inf, 0.0, 0.0, 0.0]), (21, []), (24, [1.0, 2.0]), (25, [3.0, -2.0]), (-27, same),
             (5000, [1e300, 1e-300, -1e300, 2.0]), (5001, [1e300, 1.0, 1e300, 2.0]), (6000, [1e308, 1.0, 1.0, 1.0])]
    return rows


@pytest.mark.parametrize("k", [1, 5, 400])
def test_hard_vectors(spark, k):
    rows = hard_vectors()
    assert found(spark, rows, k) == plain(rows, lambda i: i % 3 == 0, k)


def test_many_blocks_and_levels(spark, monkeypatch):
    """Many small tiles, blocks and shards: several products a cell and several levels of merging."""
    for name, value in (("TILE_ROWS", 16), ("BLOCK_BYTES", 600), ("SHARD_BYTES", 1200), ("PRODUCT_ROWS", 7), ("PRODUCT_COLUMNS", 33), ("FAN_IN", 3), ("MERGED_QUERIES", 40)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (500, 3)) / 64)]
    assert found(spark, rows, 6) == plain(rows, lambda i: i % 3 == 0, 6)


def test_hot_vector_and_hot_id(spark):
    """A third of the rows is one vector, another third one id."""
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(1, 700)] + [(900, v.tolist()) for v in rng.normal(size=(700, 3))]
    rows += [(2000 + i, v.tolist()) for i, v in enumerate(rng.normal(size=(700, 3)))]
    assert found(spark, rows, 20) == plain(rows, lambda i: i % 3 == 0, 20)


def test_empty_and_few(spark):
    assert found(spark, [], 3) == []
    assert found(spark, [(None, None)], 3) == []
    assert found(spark, [(3, [1.0])], 3) == []
    assert found(spark, [(3, [1.0]), (4, [-1.0])], 3) == [(3, 1, 4, -4096)]


def test_products_are_exact():
    rng = np.random.default_rng(6)
    for top in (3, 100, 30_000, 2 ** 31 - 1):
        a, b = (rng.integers(-top, top + 1, (9, 50)) for _ in range(2))
        exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        got = topk.products(a.astype(float), b.astype(float))
        assert [[int(s) for s in row] for row in got] == [[max(-topk.LIMIT, min(topk.LIMIT, e)) for e in row] for row in exact]
