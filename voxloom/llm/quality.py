"""Quality scores by Bradley-Terry pairwise ranking.

The chance that document a is preferred to b is ``sigmoid(w . (x_a - x_b))``.  ``w`` is learnt by
logistic loss on the feature differences of pairs (label 1, label 0).  The scores ``w . x`` of the
training rows give a quantile that separates the classes best; scores are mapped to 0..1 so that this
quantile lies at :data:`CUT`.

Features are taken from the text alone: shares of character classes and of their neighbours, and
shapes of words and lines.

Nulls: a null text counts as empty, an empty text has a score like any other; null ids are passed
through and count as held out from learning.  Rows of labels with a null id or label are ignored, a repeated
id counts once per row.  If one of the classes has no rows, every score is 1 (nothing is rejected).  Extra columns are ignored by
:func:`score_documents` and returned by :func:`keep_good`.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import bounded_sample, col, fresh, ids_and_texts, per_text

#: Score from which a document is predicted good.
CUT = 0.3
#: Bound of the labelled rows per class that are fitted (documented sample; all documents are scored).
MAX_ROWS = 8000
FOLDS, HELD_OUT = 5, 0

_CLASSES = 12
_TABLE = np.full(256, 11, np.uint8)  # 11: bytes beyond ASCII
for _b in range(128):
    _c = chr(_b)
    _TABLE[_b] = (0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == " " else 4 if _c == "\n"
                  else 5 if _c in ".!?" else 6 if _c in ",;:" else 7 if _c in "'\"()-" else 8 if _c in "#*$%&" else 9 if _c in "|<>=/\\"
                  else 10)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
N_FEATURES = _CLASSES + _CLASSES * _CLASSES + 10


def features(text: str) -> np.ndarray:
    """Shares, so texts of any length are comparable; zeros for an empty text."""
    x = np.zeros(N_FEATURES, np.float32)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return x
    kinds = _TABLE[raw]
    x[:_CLASSES] = np.sqrt(np.bincount(kinds, minlength=_CLASSES) / len(raw))
    x[_CLASSES:_CLASSES * (_CLASSES + 1)] = np.sqrt(
        np.bincount(kinds[:-1].astype(np.int16) * _CLASSES + kinds[1:], minlength=_CLASSES * _CLASSES) / len(raw))
    words = text.split()
    lines = [s for s in text.split("\n") if s.strip()]
    n = max(1, len(words))
    distinct = len(set(words))
    x[-10:] = (
        np.log1p(len(words)) / 10, distinct / n, len(raw) / n / 20, (len(set(lines)) if lines else 0) / max(1, len(lines)),
        n / max(1, len(lines)) / 100, sum(map(str.isupper, words)) / n, sum(map(str.isalpha, words)) / n,
        sum(len(w) > 12 for w in words) / n, sum(len(w) <= 3 for w in words) / n, sum(map(str.istitle, words)) / n)
    return x


def fit(x: np.ndarray, y: np.ndarray, steps: int = 300, l2: float = 1e-4) -> dict:
    """Bradley-Terry weights from pairs of a good and a bad row, and the mapping of scores."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"w": np.zeros(N_FEATURES), "mean": np.zeros(N_FEATURES), "cut": -np.inf, "scale": 1.0}
    mean, sd = x.mean(0), x.std(0)
    z = (x - mean) / np.where(sd > 1e-6, sd, np.inf)
    rng = np.random.default_rng(17)
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        pairs = 2048
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance given to the wrong order
        grad = l2 * w - d.T @ p / pairs
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    w = w / np.where(sd > 1e-6, sd, np.inf)
    s = (x - mean) @ w
    # The quantile with the fewest errors, both classes weighted alike; ties to the lower cut, which keeps more.
    order = np.argsort(s, kind="stable")
    wrong = (np.cumsum(y[order] == 1) / len(good)) + 1 - np.cumsum(y[order] == 0) / len(bad)
    k = int(np.argmin(wrong))
    upper = s[order[k + 1]] if k + 1 < len(s) else s[order[k]] + 1.0
    return {"w": w, "mean": mean, "cut": float((s[order[k]] + upper) / 2), "scale": float(max(np.std(s), 1e-6) / 4)}


def score_of(model: dict, x: np.ndarray) -> float:
    if model["cut"] == -np.inf:
        return 1.0
    s = (float(x.astype(np.float64) @ model["w"]) - float(model["mean"] @ model["w"]) - model["cut"]) / model["scale"]
    return 1 / (1 + float(np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -40, 40))))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict:
    """Fit on at most :data:`MAX_ROWS` labelled rows of each class outside the held-out fold.

    The sample is the rows with the smallest hash of their id; only their features reach the driver.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    usable = usable.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(~held_out(F.col("doc_id")))
    chosen = bounded_sample(usable.filter("y = 0"), "doc_id", MAX_ROWS).union(bounded_sample(usable.filter("y = 1"), "doc_id", MAX_ROWS))
    vector = per_text(lambda: lambda t: (features(t).tolist(),), "x array<float>")
    # The chosen rows are bounded, so they may be sent to every task.
    rows = (ids_and_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "y", vector(F.col("text"))["x"].alias("x")).orderBy("doc_id").toArrow())
    x = np.asarray(rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float32).reshape(-1, N_FEATURES)
    return fit(x, rows["y"].to_numpy())


def scorer(model: dict):
    return per_text(lambda: lambda t: (score_of(model, features(t)),), "score double")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = train(docs, labels, id_col, text_col)
    d = ids_and_texts(docs, id_col, text_col)
    return d.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(True)).alias("held_out"),
                    scorer(model)(F.col("text"))["score"].alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", train_on: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns."""
    score, columns = fresh(docs, "_row_score"), docs.columns
    model = train(docs if train_on is None else train_on, labels, text_col=text_col)
    d = docs.withColumn(score, scorer(model)(col(docs, text_col))["score"])
    return d.filter(F.col(score) >= CUT).select(*[col(docs, c) for c in columns])
