"""The order in which packing takes documents, against plain BM25."""

import math
from collections import Counter

import numpy as np
import pytest

from voxloom.llm import packing
from voxloom.llm.wordbpe import WordIds


def plain_order(docs, seed, used, k1=1.2, b=0.75):
    mean = sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d.tolist()))
    scores = {}
    for i, d in enumerate(docs):
        tf = Counter(d.tolist())
        shared = set(tf) & set(docs[seed].tolist())
        if shared and not used[i]:
            scores[i] = sum(math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(d) / mean)) for t in shared)
    return scores


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(4)
    out = [rng.zipf(1.4, rng.integers(1, 200)).clip(0, 5000) for _ in range(300)]
    return out + [out[3].copy() for _ in range(40)] + [np.array([9999])]


def test_neighbours_are_those_of_plain_bm25(docs):
    index, used = packing.Index(docs), np.zeros(len(docs), bool)
    rng = np.random.default_rng(5)
    for seed in (0, 3, 17, 299, 320):
        want = plain_order(docs, seed, used)
        got = index.neighbours(seed, used).tolist()
        assert set(got) == set(want)
        falling = [want[k] for k in got]
        assert all(a >= b - 1e-3 for a, b in zip(falling, falling[1:]))
        copies = [k for k in got if k == 3 or 300 <= k < 340]
        assert copies == sorted(copies)  # ties in order
        used[rng.choice(len(docs), 40, replace=False)] = True
        index.without(used)


def test_the_window_is_filled_best_first(docs):
    """Each seed's window takes its unused neighbours in the order of plain scores."""
    pieces = packing.pack_shard(docs, window=400)
    opened = {}
    for k, start, n, sequence, offset in pieces:
        opened.setdefault(sequence, []).append(k)
    first = opened[0]
    want = plain_order(docs, first[0], np.zeros(len(docs), bool))
    ranks = [want.get(k, 0) for k in first if k != first[0]]
    assert all(a >= b - 1e-3 for a, b in zip(ranks, ranks[1:]))
    left = [want[k] for k in want if k not in first]
    assert min(ranks) >= max(left) - 1e-3


def test_pieces_keep_their_ids_whatever_was_kept():
    words, fresh = WordIds(), WordIds()
    words.limit = 5
    for text in ["Word word, (word) it's WORD's 12a3 été ÉTÉ, x" * 3, "naïve don't can't O'Neil 'tis ''s .'s 's", "Ünïcode-Übung 東京 word", "a" * 200 + " b"]:
        for _ in range(2):
            assert words.encode(text).tolist() == fresh.tokenizer.encode(text, add_special_tokens=False).ids == fresh.encode(text).tolist()


def test_rows_alike_in_everything_are_dealt_out(spark):
    """Half of all rows have one id and one text; no shard gets more than a few times its share."""
    from pyspark.sql import functions as F

    from voxloom.llm.common import prepared

    prepared(spark)
    rows = [(1, "the same words again")] * 3000 + [(i, f"other words {i} here") for i in range(3000)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), shard_tokens=2000)
    shards = [r.n for r in packed.groupBy(F.shiftright("sequence_id", 32).alias("shard")).agg(F.sum("length").alias("n")).collect()]
    assert sum(shards) == packed.agg(F.sum("length")).first()[0] and max(shards) <= 5000
    assert packed.filter("start = 0").count() == 6000
