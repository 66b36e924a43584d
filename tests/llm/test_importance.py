"""Importance resampling against a plain version from the definitions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from voxloom.llm import importance
from voxloom.llm.common import prepared

SCHEMA = "doc_id long, text string, row long, Score string, rank int, down int, part int, w string"


def features(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", text)
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(rows, target, percent=5, min_words=20):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    big, small = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big + 10_000.0) / ((s[b] + 1.0) * (small + 10_000.0)))) for b in range(10_000)}
    out = []
    for i, text in rows:
        n, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[5] = place
    return sorted(map(tuple, out), key=repr)


def drawn(spark, rows, target, **kw):
    prepared(spark)
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3, 4, "y") for i, t in rows], SCHEMA).repartition(6)
    aims = spark.createDataFrame([(t, 1) for t in target], "text string, n long")
    return sorted((tuple(r) for r in importance.resample(docs, aims, **kw).collect()), key=repr)


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefÄß漢Z09"), 3)) for _ in range(60)]
    return [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(n)], words


def test_hard_rows(spark, monkeypatch):
    """Texts of many parts, nulls, ties, repeated rows; few pivots, so several rounds."""
    monkeypatch.setattr(importance, "PART_BYTES", 37)
    monkeypatch.setattr(importance, "PIVOTS", 2)
    body, words = texts(400)
    rows = list(enumerate(body)) + [(5, body[5]), (5, body[6]), (None, body[7]), (None, body[7]), (900, None), (901, ""), (902, " \n.,;"), (903, "ONE"),
                                    (904, "a\x1cb\x85c\x00d e"), (905, " ".join(words * 300)), (906, "x" * 5000)]
    target = [" ".join(words[:20]), None, "", words[3]]
    for percent in (5, 60, 100):
        assert drawn(spark, rows, target, percent=percent) == plain(rows, target, percent)


def test_a_third_of_all_rows_alike(spark):
    body, words = texts(300, 2)
    rows = list(enumerate(body)) + [(7, " ".join(words))] * 200
    assert drawn(spark, rows, [words[0]], percent=40) == plain(rows, [words[0]], 40)


@pytest.mark.parametrize("rows", [[], [(1, "too few words")], [(1, None)], [(i, "w " * 20) for i in range(19)]])
def test_nothing_to_draw(spark, rows):
    assert drawn(spark, rows, []) == plain(rows, [])


def test_cut_texts_give_the_same_runs(monkeypatch):
    text = "Ab céd 12, x y-z w " * 50
    whole = np.sort(np.concatenate([b for _, b in importance.run_buckets(text)]))
    assert whole.tolist() == sorted(features(text)[1])
    for size in (0, 1, 5, 64):
        monkeypatch.setattr(importance, "PART_BYTES", size)
        assert np.sort(np.concatenate([b for _, b in importance.run_buckets(text)])).tolist() == whole.tolist()


def test_kth_key(spark):
    rng = np.random.default_rng(8)
    rows = [(int(a), i) for i, a in enumerate(rng.integers(0, 5, 700))]
    keys = spark.createDataFrame(rows, "a long, b long").repartition(4).cache()
    order = sorted(rows)
    for k in (1, 2, 350, 699, 700):
        assert tuple(importance.kth_key(keys, k, ("a", "b"), pivots=5)) == order[k - 1]
