"""Secret scan: rules find the plain cases, a character network judges every candidate in its context.

Base findings come from three patterns.  Candidates are the base findings and all runs of 16 or more
key characters that mix letters and digits or hold a capital.  A small convolutional network in numpy reads the candidate
and its surroundings; candidates it accepts that no base finding touches are added as kind ``net``.

A candidate of more than 40 characters is shown whole (its ends) and in overlapping parts; its best score counts.

The network is trained here, on labelled findings of every text: all its base findings and plain words,
and at least one secret or harmless look-alike that a generator, seeded by the row, sets into it.  Candidates
that no base finding touches are harmless examples only if they are words and short numbers joined by
separators; all others are left out.  Training starts from examples in a fixed text and makes :data:`ROUNDS`
rounds over the examples of the table: tasks of about :data:`SHARE` examples go over theirs from the same
weights, and the weights are averaged.  Which task gets an example depends on its row only, so the result
does not depend on how the table is stored.  Every fifth example is held out.  Scores are calibrated by a logistic map on
all held-out findings, and the threshold is the highest that keeps :data:`RECALL` of all held-out secrets,
each scored as the scan finds it: by its best candidate, or as missed if it has none.

Nulls: a null text counts as empty and has no findings; ids are passed through, repeated rows give
repeated results, texts of any length are read whole, an empty table gives an empty result.  Extra
columns are ignored by :func:`scan`; :func:`masked` returns all columns.
"""

from __future__ import annotations

import re
import string
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import col, fresh, ids_and_texts, per_text, saved
from voxloom.operators.ranks import values_at

# The contract's patterns (fixed values); (?a) keeps "either case" to ASCII letters.
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "net")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Words and short numbers joined by separators: clearly no secret.
HARMLESS = re.compile(r"[/_=-]*(?:[A-Z]?[a-z]{1,14}[0-9]{0,3}|[0-9]{1,4})(?:[/_=-]+(?:[A-Z]?[a-z]{1,14}[0-9]{0,3}|[0-9]{1,4}))+[/_=-]*")

BEFORE, INSIDE, AFTER = 24, 40, 8
#: A longer candidate is also read in steps of this many characters.
STRIDE = 20
WIDTH = BEFORE + INSIDE + AFTER
SYMBOLS, EMBED, FILTERS, TAPS = 100, 8, 24, 5
RECALL = 0.995
#: Generated examples: at least one for every text, at least so many in all; and runs with parts, one for so many others.
LEAST, RUNS = 6000, 6
#: Rounds over the examples, and about how many of them a task goes over.
ROUNDS, SHARE = 2, 8192
#: Examples that are in memory together.
BLOCK = 8192
#: Where training starts, and the context of an empty table.
PLAIN = "a text with a few plain words"
TRAINED, HELD, SECRET = range(3)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Findings of the three patterns, leftmost and non-overlapping per kind; offsets in code points."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Base findings and every long run of key characters with letters, and digits or capitals among them."""
    runs = [(m.start(), m.end()) for m in CANDIDATE.finditer(text)
            if any(c in string.ascii_letters for c in m[0]) and any(c in string.digits or c in string.ascii_uppercase for c in m[0])]
    return sorted({(s, e) for _, s, e in base} | set(runs))


def window(text: str, start: int, end: int) -> np.ndarray:
    """Symbols of the surroundings; a long candidate shows its first 28 and last 12 characters."""
    inner = text[start:end] if end - start <= INSIDE else text[start:start + 28] + text[end - 12:end]
    s = text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + inner.ljust(INSIDE, "\0") + text[end:end + AFTER].ljust(AFTER, "\0")
    codes = np.array([ord(c) for c in s])
    return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 30, np.where(codes < 127, 97, 98))).astype(np.int64)


def views(start: int, end: int) -> list[tuple[int, int]]:
    """The candidate, and if it is long its overlapping parts, so that every character is shown."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(start, end), *((a, a + INSIDE) for a in range(start, end - INSIDE, STRIDE)), (end - INSIDE, end)]


class Net:
    """Embedding, one convolution with position bias for inside and outside, max and mean pooling, one unit."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {"e": r.normal(0, 0.3, (SYMBOLS, EMBED)), "k": r.normal(0, 0.25, (TAPS * (EMBED + 1), FILTERS)), "kb": np.zeros(FILTERS),
                  "o": r.normal(0, 0.1, 2 * FILTERS), "ob": np.zeros(1)}
        self.slope, self.shift, self.threshold, self.recall = 1.0, 0.0, 0.5, 0.0
        self.inside = np.zeros((WIDTH, 1))
        self.inside[BEFORE:BEFORE + INSIDE] = 1

    def _forward(self, x: np.ndarray):
        p = self.p
        e = np.concatenate([p["e"][x], np.broadcast_to(self.inside, (len(x), WIDTH, 1))], axis=2)
        n = WIDTH - TAPS + 1
        cols = np.concatenate([e[:, t:t + n] for t in range(TAPS)], axis=2)
        h = np.maximum(cols @ p["k"] + p["kb"], 0)
        top = h.argmax(axis=1)
        pooled = np.concatenate([h.max(axis=1), h.mean(axis=1)], axis=1)
        return cols, h, top, pooled, pooled @ p["o"] + p["ob"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = [self._forward(x[i:i + 256])[-1] for i in range(0, len(x), 256)]
        return np.concatenate(out) if out else np.zeros(0)

    def _mover(self, rate: float) -> Callable[[np.ndarray, np.ndarray, np.ndarray | float], None]:
        """One step of Adam on a batch ``(x, y, weight)``; the moments live as long as the function."""
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        t = 0

        def move(xb: np.ndarray, yb: np.ndarray, weight: np.ndarray | float = 1.0) -> None:
            nonlocal t
            t += 1
            batch = len(yb)
            cols, h, top, pooled, z = self._forward(xb)
            dz = (1 / (1 + np.exp(-z)) - yb) * weight / batch
            g = {"o": pooled.T @ dz, "ob": np.array([dz.sum()])}
            dp = np.outer(dz, self.p["o"])
            dh = np.repeat(dp[:, None, FILTERS:] / h.shape[1], h.shape[1], axis=1)
            np.add.at(dh, (np.arange(batch)[:, None], top, np.arange(FILTERS)), dp[:, :FILTERS])
            dh *= h > 0
            g["kb"] = dh.sum(axis=(0, 1))
            g["k"] = np.einsum("bnc,bnf->cf", cols, dh, optimize=True)
            dcols = dh @ self.p["k"].T
            de = np.zeros((batch, WIDTH, EMBED))
            for tap in range(TAPS):
                de[:, tap:tap + h.shape[1]] += dcols[:, :, tap * (EMBED + 1):tap * (EMBED + 1) + EMBED]
            g["e"] = np.zeros_like(self.p["e"])
            np.add.at(g["e"], xb, de)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)

        return move

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 64) -> None:
        r, move = np.random.default_rng(6), self._mover(0.01)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        for _ in range(steps):
            pick = np.concatenate([r.choice(good, batch // 2), r.choice(bad, batch // 2)])
            move(x[pick], y[pick])

    def go_over(self, blocks: Iterator[tuple[np.ndarray, np.ndarray]], batch: int = 64) -> int:
        """Every example of the blocks once, both labels of a block with the same weight; returns their number."""
        r, move, n = np.random.default_rng(7), self._mover(0.003), 0
        for x, y in blocks:
            share = np.bincount(y, minlength=2)
            weight = len(y) / (2 * np.maximum(share, 1))[y] if share.all() else np.ones(len(y))
            order = r.permutation(len(y))
            for lo in range(0, len(y), batch):
                pick = order[lo:lo + batch]
                move(x[pick], y[pick], weight[pick])
            n += len(y)
        return n

    def weights(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def set_weights(self, flat: np.ndarray) -> None:
        for k in sorted(self.p):
            self.p[k], flat = flat[:self.p[k].size].reshape(self.p[k].shape).copy(), flat[self.p[k].size:]

    def calibrate(self, z: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        """Logistic map of held-out logits by gradient steps; ``n`` counts the findings with logit ``z`` and label ``y``."""
        a, b, n = 1.0, 0.0, n / max(1, n.sum())
        for _ in range(500):
            q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            a -= 0.05 * np.sum(n * (q - y) * z) / max(1.0, np.sum(n * z * z))
            b -= 0.05 * np.sum(n * (q - y))
        self.slope, self.shift = a, b

    def limit(self, secret: np.ndarray) -> None:
        """The recall-constrained threshold from the scores of held-out secrets, -1 where the scan has no candidate."""
        secret = np.sort(secret)
        at = limit_rank(len(secret), int((secret < 0).sum()))
        if at < len(secret):
            self.threshold = float(secret[at])
            self.recall = float((secret >= self.threshold).mean())

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(x) + self.shift, -30, 30)))


def limit_rank(n: int, missing: int) -> int:
    """Place of the threshold among ``n`` sorted scores, those without a candidate first.

    At most this many may fall below.  If more have no candidate, every one that has is kept.
    """
    return max(int(n * (1 - RECALL)), missing)


def _generated(r: np.random.Generator, contexts: list[str], n: int, odd: int = 0) -> tuple[list[tuple[str, int, int]], list[int]]:
    """Labelled findings ``(text, start, end)``: half secrets, half look-alikes, each inside a context; ``odd`` 1 begins with a look-alike."""
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits,
                 "0123456789abcdef", string.ascii_letters + string.digits + "_-")
    leads = ("", "", "token = \"", "key: ", "secret=", "auth ", "password=", "Bearer ", "api_key: '", "sk_live_", "ghp_", "xoxb-", "AKIA")

    def pick(chars: str, k: int) -> str:
        return "".join(chars[i] for i in r.integers(0, len(chars), k))

    def word() -> str:
        c = contexts[r.integers(len(contexts))].split()
        return re.sub(r"[^A-Za-z]", "", c[r.integers(len(c))]) if c else "word"

    def harmless() -> str:
        kind = r.integers(7)
        a, b = word() or "a", word() or "b"
        return (f"{a}{r.integers(100)}_{b}_{word()}{r.integers(10)}", f"20{r.integers(10, 30)}-{r.integers(10, 13)}-{r.integers(10, 29)}T{pick(string.digits, 6)}",
                f"/{a}/{b}/{word()}/v{r.integers(10)}/index{r.integers(99)}", f"{a}-{b}-{word()}-{r.integers(1, 2000)}", pick(string.digits, int(r.integers(15, 20))) + "km",
                f"{a}{b}{word()}{r.integers(100)}", "=" * int(r.integers(16, 40)) + "v1")[kind]

    items, labels = [], []
    for k in range(n):
        c = contexts[r.integers(len(contexts))]
        cut = int(r.integers(0, len(c) + 1))
        secret = (k + odd) % 2 == 0
        lead = leads[r.integers(len(leads))] if secret else ("", "", "see ", "id: ", "http:/", "file ")[r.integers(6)]
        value = pick(alphabets[r.integers(len(alphabets))], int(r.integers(18, 64))) if secret else harmless()
        head = c[max(0, cut - 60):cut] + (" " if r.random() < 0.9 else "\n")
        joined = lead[-1:] in "_-A" and lead != ""
        start = len(head) + (0 if joined else len(lead))
        text = head + lead + value + ("\" " if lead.endswith("\"") else " ") + c[cut:cut + 20]
        items.append((text, start, len(head) + len(lead) + len(value)))
        labels.append(int(secret))
    return items, labels


def _long_runs(r: np.random.Generator, contexts: list[str], n: int, odd: int = 0) -> list[tuple[str, int, int, tuple[int, int] | None]]:
    """``(text, start, end, secret)``: paths and slugs of words and numbers; every second one holds a secret."""
    chars = string.ascii_letters + string.digits
    out = []
    for j in range(n):
        c = contexts[r.integers(len(contexts))]
        known = re.findall(r"[A-Za-z]{2,12}", c) or ["word"]
        between = "/-_"[r.integers(3)]
        parts = [known[r.integers(len(known))] if r.random() < 0.8 else str(r.integers(0, 2100)) for _ in range(r.integers(10, 24))]
        at = int(r.integers(0, len(parts) + 1))
        secret = "".join(chars[i] for i in r.integers(0, len(chars), int(r.integers(24, 48)))) if (j + odd) % 2 == 0 else ""
        head = c[:40] + " "
        first = head + "".join(p + between for p in parts[:at])
        run = first + secret + "".join(between + p for p in parts[at:])
        out.append((run + " " + c[40:60], len(head), len(run), (len(first), len(first) + len(secret)) if secret else None))
    return out


def best_scores(text: str, found: list[tuple[int, int]], net: Net) -> np.ndarray:
    """Best score over the views of each candidate, in bounded steps: a long text may hold any number of them."""
    best = np.zeros(len(found))
    shown = ((k, v) for k, c in enumerate(found) for v in views(*c))
    while block := list(islice(shown, 512)):
        np.maximum.at(best, [k for k, _ in block], net.scores(np.stack([window(text, *v) for _, v in block])))
    return best


class _Found:
    """The base findings and candidates of a text, asked for by place."""

    def __init__(self, text: str):
        base = base_spans(text)
        self.candidates = candidates(text, base)
        known = {(s, e) for _, s, e in base}
        # In each list sorted and without overlaps.
        self.base = [[(s, e) for k, s, e in base if k == kind] for kind in KINDS[:3]]
        self.runs = [c for c in self.candidates if c not in known]

    @staticmethod
    def _in(lists: list[list[tuple[int, int]]], start: int, end: int) -> Iterator[tuple[int, int]]:
        for own in lists:
            yield from own[bisect_right(own, start, key=lambda c: c[1]):bisect_left(own, end, key=lambda c: c[0])]

    def is_known(self, start: int, end: int) -> bool:
        return next(self._in(self.base, start, end), None) is not None

    def views_at(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        """The views of all candidates that the scan has in ``start:end``."""
        for c in dict.fromkeys(self._in([*self.base, self.runs], start, end)):
            yield from views(*c)


def _seen(text: str, spans: Iterator[tuple[int, int]] | list[tuple[int, int]]) -> bytes:
    return b"".join(window(text, s, e).astype(np.uint8).tobytes() for s, e in spans)


def _is_held(shown: bytes) -> bool:
    return zlib.crc32(shown) % 5 == 0


def labelled(text: str, seed: int, short: float, runs: float) -> Iterator[tuple[int, int, bytes]]:
    """``(use, label, windows)`` of a text: its own findings, and ``short`` generated ones and ``runs`` runs with parts (on average).

    Trained and held-out examples show one window; a held-out secret comes again with all that the scan sees of it.
    """
    r = np.random.default_rng(seed % (1 << 64))

    def number(mean: float) -> int:
        return int(mean) + int(r.random() < mean % 1)

    def one(text: str, found: _Found | None, start: int, end: int, label: int) -> Iterator[tuple[int, int, bytes]]:
        shown = _seen(text, [(start, end)])
        held = _is_held(shown)
        yield HELD if held else TRAINED, label, shown
        if held and label:
            yield SECRET, label, _seen(text, (found or _Found(text)).views_at(start, end))

    own = _Found(text)
    for s, e in own.candidates:
        known = own.is_known(s, e)
        # Nobody has looked at the others; they may be secrets outside the patterns.
        if known or HARMLESS.fullmatch(text, s, e):
            yield from one(text, own, s, e, int(known))
    for item, label in zip(*_generated(r, [text], number(short), int(r.integers(2)))):
        yield from one(item[0], None, *item[1:], label)
    for t, s, e, secret in _long_runs(r, [text], number(runs), int(r.integers(2))):
        held = _is_held(t.encode())
        for a, b in views(s, e)[1:]:
            seen = 0 if secret is None else min(b, secret[1]) - max(a, secret[0])
            # Views of harmless runs, and those that show most of a secret; the others are not labelled.
            if secret is None or seen >= STRIDE:
                yield HELD if held else TRAINED, int(secret is not None), _seen(t, [(a, b)])
        if held and secret:
            yield SECRET, 1, _seen(t, _Found(t).views_at(*secret))


def examples(docs: DataFrame) -> DataFrame:
    """``deal, use, label, windows`` of all texts of ``doc_id, text``; ``deal`` depends on the row only."""
    texts = docs.filter(F.length("text") > 0)
    n = texts.count()
    if not n:
        n, texts = 1, docs.sparkSession.createDataFrame([(0, PLAIN)], "doc_id long, text string")
    short = max(1.0, LEAST / n)
    schema = pa.schema([("deal", pa.int64()), ("use", pa.int32()), ("label", pa.int32()), ("windows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for seed, text in zip(batch.column("seed"), batch.column("text")):
                    seed = seed.as_py()
                    for k, row in enumerate(labelled(text.as_py(), seed, short, short / RUNS)):
                        # A fixed odd number spreads the examples of a row over all tasks.
                        yield ((seed + k * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63), *row)

        block, size = [], 0
        for row in rows():
            block.append(row)
            size += len(row[-1])
            if size >= BLOCK * WIDTH:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*block), schema)], schema=schema)
                block, size = [], 0
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*block), schema)], schema=schema)

    seeded = texts.select(F.xxhash64("doc_id", "text").alias("seed"), "text")
    return seeded.mapInArrow(run, "deal long, use int, label int, windows binary")


def _windows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Examples in blocks of one size, however the session cuts its batches."""
    x, y = np.empty((0, WIDTH), np.uint8), np.empty(0, np.int64)
    for batch in batches:
        x = np.concatenate([x, _windows(batch.column("windows"))])
        y = np.concatenate([y, batch.column("label").to_numpy().astype(np.int64)])
        while len(y) >= BLOCK:
            yield x[:BLOCK], y[:BLOCK]
            x, y = x[BLOCK:], y[BLOCK:]
    if len(y):
        yield x, y


def _round(net: Net, dealt: DataFrame) -> None:
    """Each task goes over its examples from the same weights; their mean, by number of examples, is the outcome."""
    unit = 1 << 24  # sums of integers do not depend on the order of the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Net()
        own.set_weights(net.weights())
        n = own.go_over(_blocks(batches))
        if n:
            total = [int(w) * n for w in np.rint(own.weights() * unit)]
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(total)), pa.int32()), "total": pa.array(total, pa.int64()), "n": pa.array([n] * len(total), pa.int64())})

    sums = dealt.mapInArrow(run, "k int, total long, n long").groupBy("k").agg(
        F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))
    rows = sorted(sums.collect())  # one row per weight
    if rows:
        net.set_weights(np.array([int(r.total) / (r.n * unit) for r in rows]))


def _calibrated(net: Net, held: DataFrame) -> None:
    """Held-out logits are counted in cells of 1/64, at most 40 from zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = net.logits(_windows(batch.column("windows")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.rint(np.clip(z, -40, 40) * 64).astype(np.int32)), batch.column("label")], names=["z", "label"])

    rows = held.mapInArrow(run, "z int, label int").groupBy("z", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("z", "label").collect()
    z, y, n = np.array([[r.z, r.label, r.n] for r in rows], float).reshape(-1, 3).T
    net.calibrate(z / 64, y, n)


def _limited(net: Net, secret: DataFrame) -> None:
    """The threshold at its exact rank among the scores of all held-out secrets.

    A score is cut to 32 bits, whose order is that of an integer; so no secret falls below by rounding.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown = [len(w) // WIDTH for w in batch.column("windows").to_pylist()]
            best = np.full(len(shown), -1.0)
            np.maximum.at(best, np.repeat(np.arange(len(shown)), shown), net.scores(_windows(batch.column("windows"))))
            low = best.astype(np.float32)
            low = np.where(low > best, np.nextafter(low, np.float32(-1)), low)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(best < 0, -1, low.view(np.int32).astype(np.int64)))], names=["t"])

    scores = saved(secret.mapInArrow(run, "t long"), "secret-scores")
    n, missing = scores.agg(F.count(F.lit(1)), F.count_if(F.col("t") < 0)).head()
    at = limit_rank(n, missing)
    if at < n:
        bits = values_at(scores, [at], -1, int(np.float32(1).view(np.int32)))[at]
        net.threshold = float(np.int32(bits).view(np.float32))
        net.recall = scores.filter(F.col("t") >= bits).count() / n


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Net:
    """Train on the findings of all texts and on generated ones set into them."""
    start = [e for seed in range(200) for e in labelled(PLAIN, seed, LEAST / 200, LEAST / RUNS / 200) if e[0] == TRAINED]
    net = Net()
    net.train(np.frombuffer(b"".join(e[2] for e in start), np.uint8).reshape(-1, WIDTH), np.array([e[1] for e in start]))
    found = saved(examples(ids_and_texts(docs, id_col, text_col)), "secret-examples")
    trained = found.filter(F.col("use") == TRAINED).select("deal", "label", "windows")
    tasks = max(1, -(-trained.count() // SHARE))
    for _ in range(ROUNDS):
        _round(net, trained.repartition(tasks, "deal").sortWithinPartitions("deal", "label", "windows").select("label", "windows"))
    _calibrated(net, found.filter(F.col("use") == HELD).select("label", "windows"))
    _limited(net, found.filter(F.col("use") == SECRET).select("windows"))
    return net


def spans(text: str, net: Net) -> list[Span]:
    """All findings: the base ones, and candidates the network accepts that no base finding touches."""
    base = base_spans(text)
    found = candidates(text, base)
    if not found:
        return []
    score = best_scores(text, found, net)
    taken = sorted((s, e) for _, s, e in base)
    added, k, reach = [], 0, -1
    for (s, e), p in zip(found, score):
        while k < len(taken) and taken[k][0] < e:
            reach = max(reach, taken[k][1])
            k += 1
        if p >= net.threshold and reach <= s:
            added.append(("net", s, e))
    return sorted(base + added, key=lambda f: (f[1], KINDS.index(f[0])))


def _listed(found: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def scan(docs: DataFrame, net: Net | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_net, base, spans`` for every row; lists are ``kind:start:end``."""
    net = net or train(docs, id_col, text_col)

    def row():
        def one(text: str):
            found = spans(text, net)
            counts = [sum(f[0] == k for f in found) for k in KINDS]
            return (*counts, _listed([f for f in found if f[0] != "net"]), _listed(found))
        return one

    scanned = per_text(row, "n_assign long, n_access long, n_hex long, n_net long, base string, spans string")
    d = ids_and_texts(docs, id_col, text_col)
    return d.select("doc_id", scanned(F.col("text")).alias("s")).select("doc_id", "s.*")


def masked(docs: DataFrame, net: Net | None = None, text_col: str = "text", id_col: str = "doc_id", mask: str = "<secret>",
           length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every finding replaced by ``mask``; the length column of changed rows follows. Nulls stay null."""
    net = net or train(docs, id_col, text_col)

    def row():
        def one(text: str):
            parts, at = [], 0
            for _, s, e in spans(text, net):
                if e > at:
                    parts += [text[at:s], mask] if s >= at else []
                    at = e
            return ("".join(parts) + text[at:] if parts else None,)
        return one

    key = fresh(docs, "_row_masked")
    d = docs.withColumn(key, per_text(row, "masked string")(col(docs, text_col))["masked"])
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.coalesce(F.col(key), col(docs, c)).alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            out.append(F.when(F.col(key).isNotNull(), F.length(F.col(key)).cast(kind)).otherwise(col(docs, c)).alias(c))
        else:
            out.append(col(docs, c))
    return d.select(*out)
