"""The network of operator 9 learns from every text, whole, however the table is stored."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import secrets


def hexes(n):
    return [hashlib.sha256(str(k).encode()).hexdigest() for k in range(n)]


@pytest.fixture(scope="module")
def late(spark):
    """More texts than any sample held before, each with a finding far behind its start; one row twice, null and empty rows."""
    rows = [(k, "plain words here " * 300 + f"{h} end") for k, h in enumerate(hexes(600))]
    return spark.createDataFrame([*rows, rows[0], (None, rows[1][1]), (7000, None), (7001, "")], "doc_id long, text string")


def test_every_text_gives_its_findings(late):
    rows = secrets.examples(late).filter(F.col("label") == 1).filter(F.col("use") != secrets.SECRET).collect()
    shown = {bytes(r.windows) for r in rows}
    for h in hexes(600):
        text = "plain words here " * 300 + f"{h} end"
        assert secrets._seen(text, [(5100, 5164)]) in shown


def test_unreviewed_candidates_are_not_labelled():
    tokens = [f"ghp_{h[:20].upper()}xQ" for h in hexes(40)]
    for k, t in enumerate(tokens):
        text = f"call {t} and /usr/share/doc/page{k} now"
        got = {w: label for _, label, w in secrets.labelled(text, k, 0, 0)}
        assert got == {secrets._seen(text, [(6 + len(t) + 4, len(text) - 4)]): 0}


def test_held_out_secret_is_shown_as_the_scan_sees_it():
    net = secrets.Net()
    for h in hexes(30):
        text = f"a/b/{h}/c token = abcdef0123456789abcdef0123 end"
        for s, e in [(4, 68), (71, len(text) - 4)]:
            w = np.frombuffer(secrets._seen(text, secrets._Found(text).views_at(s, e)), np.uint8).reshape(-1, secrets.WIDTH)
            found = [c for c in secrets.candidates(text, secrets.base_spans(text)) if c[0] < e and s < c[1]]
            assert net.scores(w).max() == pytest.approx(secrets.best_scores(text, found, net).max())
    assert secrets._seen("none", secrets._Found("none").views_at(0, 4)) == b""


def test_training_does_not_depend_on_storage(late, monkeypatch):
    monkeypatch.setattr(secrets, "SHARE", 4000)
    one, two = secrets.train(late.coalesce(1)), secrets.train(late.repartition(7))
    assert np.array_equal(one.weights(), two.weights())
    assert (one.threshold, one.recall, one.slope, one.shift) == (two.threshold, two.recall, two.slope, two.shift)
    assert one.recall >= secrets.RECALL


def test_threshold_at_its_rank_in_the_table(spark):
    """The distributed threshold is the one that the sorted scores give, -1 for secrets without a candidate."""
    net, plain = secrets.Net(), secrets.Net()
    shown = [w for seed in range(300) for use, _, w in secrets.labelled("plain words and more of them", seed, 5, 1) if use == secrets.SECRET]
    for some in (shown, [b""] * 40 + shown):
        secrets._limited(net, spark.createDataFrame([(w,) for w in some], "windows binary").repartition(3))
        best = [net.scores(np.frombuffer(w, np.uint8).reshape(-1, secrets.WIDTH)).max() if w else -1.0 for w in some]
        plain.limit(np.array(best))
        assert net.threshold <= plain.threshold and net.threshold == pytest.approx(plain.threshold, rel=1e-6)
        assert net.recall == pytest.approx(plain.recall)
