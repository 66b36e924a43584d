"""The prefix trie against a plain version from the definitions."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from voxloom.llm import trie
from voxloom.llm.common import prepared

SCHEMA = "conv_id long, turn long, role string, text string, seq string, first int, b int, Depth long"


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 * (1 if c >= 0 else -1))
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        tokens = (len(m) - 1) * len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += tokens
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if whole[c] == p).encode()).hexdigest()) for p, m in members.items()), key=repr)


def built(spark, rows):
    prepared(spark)
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in trie.trie(trie.rebuilt(df)).collect()), key=repr)


def hard_rows():
    """Shared starts, copies, ties, nulls in every column, repeated rows, absent donors, a long conversation and a long text."""
    rng = np.random.default_rng(2)
    rows = []
    for c in [*range(0, 130), -7, -40, -41]:
        kind = rng.integers(0, 4)
        if kind:
            rows += [(c, 0, "system", "be kind"), (c, 1, "user", f"say {rng.integers(0, 3)}")]
        rows += [(c, int(t) + 2, "user" if t % 2 else "assistant", " ".join("abc"[i] for i in rng.integers(0, 2, 2))) for t in range(rng.integers(0, 5))]
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 240) for t in range(6)]
    rows += [(301, t, "user", f"turn {t}") for t in range(300)] + [(302, t, "user", f"turn {min(t, 280)}") for t in range(300)]
    rows += [(400, None, "user", "no turn"), (400, 0, None, "x"), (400, 1, "user", None), (400, 2, None, None), (400, 2, None, None), (400, 2, "a", "b"),
             (400, 2, "ab", ""), (None, 1, "user", "no id"), (421, 5, "user", "w " * 20_000), (461, 0, "user", ""), (463, 0, "", "user")]
    return rows


@pytest.mark.parametrize("rows_limit, turns_limit", [(2048, 200_000), (3, 200_000), (50, 40)])
def test_hard_rows(spark, monkeypatch, rows_limit, turns_limit):
    for name, value in (("CONTAINER_ROWS", rows_limit), ("CONTAINER_TURNS", turns_limit), ("BLOCK_IDS", 7), ("BATCH_ROWS", 5)):
        monkeypatch.setattr(trie, name, value)
    assert built(spark, hard_rows()) == plain(hard_rows())


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(1, 0, "user", "given away")], [(20, None, None, None)], [(i, 0, "u", "t") for i in range(40)]])
def test_few(spark, rows):
    assert built(spark, rows) == plain(rows)
