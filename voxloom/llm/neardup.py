"""MinHash near-duplicates with sequential Bayesian verification and exact confirmation.

1. Each text becomes its set of word shingles (64-bit hashes), a MinHash signature and band hashes.
2. Texts with equal sets are one class; only its first document goes on, so copies are not expanded.
   A class is named by its first document or, where ids repeat, by a number of its own.
3. Round one compares each class of a band bucket with the first class of the bucket.
4. Round two opens only the buckets whose classes are not yet one component, and compares members of
   different components inside one task, in blocks of bounded size: pairs are never emitted, only links.
5. Every comparison goes through signature batches: it ends as soon as the posterior chance of reaching
   the threshold falls under :data:`MISS`.  Survivors are confirmed on the full sets.
6. Tables that grow with the input (classes, buckets, pairs, labels) meet by a shuffle: by their stored size
   Spark would broadcast them, exploded bands as well.

Nulls, ties, empties: a null or wordless text has an empty set and is linked with nothing; rows with a
null id take no part, have a null component and are kept; rows that repeat an id are one document (their
texts' links are joined) and each row is returned.  A text of any length is one row.  An empty table
gives an empty result.  Extra columns are ignored by :func:`near_duplicates`; :func:`keep_one` returns them
and judges each text of such an id by its own links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import Kept, by_shuffle, col, fresh, ids_and_texts, per_text, saved, text_spread
from voxloom.llm.components import components
from voxloom.session import small_side

#: A pair at similarity 0.85 misses all bands with a chance of (1 - 0.85^5)^22, about 2.5e-6.
BANDS, ROWS = 22, 5
HASHES = BANDS * ROWS
#: Signatures are compared in batches of this many values.
BATCH = 22
#: Chance that the posterior gives to similarity >= threshold below which a pair is pruned.
MISS = 1e-6
#: A block of a bucket holds about this many shingles and at most this many classes.
BLOCK_SHINGLES, BLOCK_CLASSES = 400_000, 2000
#: Ids of classes that share a bucket are broadcast up to this many, beyond that joined by a shuffle.
MAX_SENT = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_RNG = np.random.default_rng(20240)
_A = (_RNG.integers(0, 2 ** 32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 2 ** 32, HASHES, np.uint64).astype(np.uint32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class _Words(Kept):
    """64-bit hashes of words."""

    limit = 200_000

    def make(self, word: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingle_set(text: str | None, k: int, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; ``bytes.split`` cuts at just the contract's blanks."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    k = min(k, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        s = _mix(s * _MIX + h[j:len(h) - k + 1 + j])
    return np.unique(s)


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of :data:`HASHES` 32-bit hashes, in bounded steps."""
    low = (s ^ (s >> np.uint64(32))).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        block = low[i:i + 1024, None] * _A + _B
        block ^= block >> np.uint32(15)
        out = np.minimum(out, (block * np.uint32(0x2C1B3C6D)).min(axis=0))
    return out


def band_hashes(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    for j in range(ROWS):
        h = _mix(h ^ (rows[:, j] + np.uint64((j + 1) << 32)))
    return h.view(np.int64)


def least_matches(threshold: float) -> list[tuple[int, int]]:
    """``(values compared, matches needed)`` per batch under a uniform prior.

    One byte of a value is compared, so different values agree by chance in 1 of 256.  The posterior of
    the agreement rate is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if tail >= MISS:
                break
            m += 1
        out.append((n, m))
    return out


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on the full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _survivors(sig: np.ndarray, others: np.ndarray, needed: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``others`` the signature batches leave."""
    alive = np.arange(len(others))
    matches, done = np.zeros(len(others), np.int32), 0
    for n, m in needed:
        matches = matches + (others[alive, done:n] == sig[done:n]).sum(axis=1)
        left = matches >= m
        alive, matches, done = alive[left], matches[left], n
        if not len(alive):
            break
    return alive


SKETCH = "doc_id long, n_shingles long, set_hash binary, sig binary, bands array<long>, shingles binary"


def sketches(docs: DataFrame, k: int, with_sets: bool = False) -> DataFrame:
    """One row per input row; ``shingles`` holds the sorted hashes as little-endian 64-bit values, if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            n, sets, sigs, bands, hashes = [], [], [], [], []
            for t in batch["text"]:
                s = shingle_set(t.as_py(), k, words)
                sig = signature(s) if len(s) else None
                n.append(len(s))
                sets.append(s.tobytes() if with_sets else None)
                hashes.append(hashlib.blake2b(s, digest_size=16).digest())
                sigs.append(None if sig is None else sig.astype(np.uint8).tobytes())
                bands.append([] if sig is None else band_hashes(sig))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(sigs, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                ["doc_id", "n_shingles", "set_hash", "sig", "bands", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, SKETCH)


def _confirm_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs that are links; input ``a, b, sig_a, sig_b, set_a, set_b``."""
    needed = least_matches(percent / 100)

    def run(batches):
        for batch in batches:
            keep = []
            for sa, sb, xa, xb in zip(*(batch[c] for c in ("sig_a", "sig_b", "set_a", "set_b"))):
                sig = np.frombuffer(sa.as_buffer(), np.uint8)
                if len(_survivors(sig, np.frombuffer(sb.as_buffer(), np.uint8)[None], needed)):
                    keep.append(_linked(np.frombuffer(xa.as_buffer(), np.uint64), np.frombuffer(xb.as_buffer(), np.uint64), percent))
                else:
                    keep.append(False)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sig_a", "sig_b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _links_in_bucket(percent: int):
    """Links between different components of one bucket (or of two of its blocks), as a forest."""
    needed = least_matches(percent / 100)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, start, block = (table[c].to_numpy() for c in ("id", "component", "block"))
        m = len(ids)
        sigs = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(m, HASHES)
        bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(m, BANDS)
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["shingles"]]
        band = int(table["band"][0].as_py())
        lo, hi = block.min(), block.max()
        _, root = np.unique(start, return_inverse=True)  # component by number; merged by relabelling
        size = np.array([len(s) for s in sets])
        links = []
        for i in range(m - 1):
            rest = slice(i + 1, m)
            # Pairs inside one block belong to that block's own task; pairs that share an earlier band to that band's.
            other = (root[rest] != root[i]) & (100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i]))
            if lo != hi:
                other &= block[rest] != block[i]
            j = np.flatnonzero(other) + i + 1
            if band and len(j):
                j = j[~(bands[j, :band] == bands[i, :band]).any(axis=1)]
            if not len(j):
                continue
            for x in j[_survivors(sigs[i], sigs[j], needed)]:
                if root[x] != root[i] and _linked(sets[i], sets[x], percent):
                    links.append((ids[i], ids[x]))
                    root[root == root[x]] = root[i]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    def grouped(table: pa.Table) -> pa.Table:
        return run(table)

    return grouped


def _labelled(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """``doc_id, n_shingles, set_hash, component`` of each id and set, and whether no id repeats.

    Components are of texts, not yet joined through ids.  They are named by their smallest document if no
    id repeats, else by a number (null where the set is empty).
    """
    base = ids_and_texts(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    rows = saved(sketches(text_spread(base), k), "sketches")
    unique = not _repeats(rows)
    # Equal sets: one class, represented by its smallest document.
    same = rows.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("doc_id").alias("first_doc"))
    if unique:
        same = same.withColumn("rep", F.col("first_doc"))
    else:  # an id may be the smallest of several classes; written once, so that the numbers stay
        same = saved(same.withColumn("rep", F.monotonically_increasing_id()), "names")
    member = rows.select("doc_id", "n_shingles", "set_hash").distinct().join(by_shuffle(same.drop("first_doc")), "set_hash", "left")
    member = saved(member.withColumn("rep", F.coalesce("rep", "doc_id")) if unique else member, "members")
    banded = rows.filter("n_shingles > 0").join(by_shuffle(same.withColumnRenamed("first_doc", "doc_id")), ["doc_id", "set_hash"])
    if not unique:
        banded = saved(banded.dropDuplicates(["rep"]), "representatives")
    buckets = banded.select(F.col("rep").alias("id"), "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    first = buckets.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    shared = saved(by_shuffle(buckets).join(first.filter("n > 1"), "bucket"), "buckets")

    # Round one: every class against the first of its bucket.
    pairs = shared.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    # Few classes share a bucket: only their sets are made, from the texts once more, so the sets of all texts are
    # never written.  No shuffle, where the ids are few enough to send.
    sharing = shared.select("id").distinct()
    if unique:
        data = sketches(base.join(small_side(sharing.withColumnRenamed("id", "doc_id"), MAX_SENT), "doc_id", "left_semi"), k, with_sets=True)
        data = data.withColumnRenamed("doc_id", "id")
    else:
        named = banded.select("doc_id", "set_hash", F.col("rep").alias("id")).join(by_shuffle(sharing), "id", "left_semi")
        data = sketches(base.join(small_side(named.select("doc_id").distinct(), MAX_SENT), "doc_id", "left_semi"), k, with_sets=True)
        data = data.join(named, ["doc_id", "set_hash"]).dropDuplicates(["id"])
    data = saved(data.select("id", "sig", "bands", "shingles"), "sets")
    left = data.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"), F.col("shingles").alias("set_a"))
    right = data.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"), F.col("shingles").alias("set_b"))
    one = saved(_confirm_pairs(by_shuffle(pairs).join(right, "b").join(left, "a"), percent), "links")
    known = saved(components(one), "components")

    # Round two: buckets that still hold several components.
    labelled = shared.join(by_shuffle(known.withColumnRenamed("node", "id"), known.count()), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    n_blocks = F.greatest(F.ceil(F.col("size") / BLOCK_SHINGLES), F.ceil(F.col("n") / BLOCK_CLASSES)).cast("int")
    open_rows = (labelled.join(mixed, "bucket", "left_semi").withColumn("n_blocks", n_blocks)
                 .withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int")))
    # A bucket of several blocks: one task for each pair of blocks, and one for each block.
    open_rows = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    full = by_shuffle(open_rows).join(data, "id").select(
        "bucket", "band", "id", "component", "block", "sig", "bands", "shingles",
        F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    two = full.groupBy("bucket", "b1", "b2").applyInArrow(_links_in_bucket(percent), "a long, b long")
    final = components(one.union(two))

    return member.join(by_shuffle(final.withColumnRenamed("node", "rep"), final.count()), "rep", "left").select(
        "doc_id", "n_shingles", "set_hash", F.coalesce("component", "rep").alias("component")), unique


def classes(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` per id and text with an id."""
    labels, unique = _labelled(docs, k, percent, id_col, text_col)
    labels = labels.drop("set_hash")
    return _joined_ids(labels) if not unique else labels.withColumnRenamed("component", "component_id")


def _repeats(rows: DataFrame) -> bool:
    """Whether an id has several rows (a count per id, combined before the shuffle)."""
    return not rows.groupBy("doc_id").count().filter("count > 1").isEmpty()


def _joined_ids(labels: DataFrame) -> DataFrame:
    """Rows that repeat an id with other texts: their components are joined through the id."""
    labels = saved(labels, "labels")
    least = labels.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("b"))
    joined = components(labels.join(least, "component").select(F.col("doc_id").alias("a"), "b"))
    return labels.join(joined.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "c"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row."""
    out = classes(docs, k, percent, id_col, text_col)
    if _repeats(ids_and_texts(docs, id_col, text_col).filter("doc_id IS NOT NULL")):
        counts = ids_and_texts(docs, id_col, text_col).filter("doc_id IS NOT NULL")
        out = _per_row(counts, out, k)
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    unnamed = ids_and_texts(docs, id_col, text_col).filter("doc_id IS NULL")
    return out.unionByName(sketches(unnamed, k).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def _per_row(base: DataFrame, out: DataFrame, k: int) -> DataFrame:
    """One result row per input row where ids repeat."""
    ids = out.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sketches(base, k).select("doc_id", "n_shingles").join(ids, "doc_id")


def keep_one(docs: DataFrame, k: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their group, with all columns; rows without id stay.

    Only the ids that go are joined against the texts.  Where ids repeat, each text of an id is judged by its
    own links: of each group of texts the one with the smallest id stays (ties: the smallest hash of its
    set), and of rows that repeat an id and a set, one.  Wordless texts stay, one row of each id and text.
    """
    gone, key = fresh(docs, "_gone"), col(docs, id_col).cast("long")
    labels, unique = _labelled(docs, k, percent, id_col, text_col)
    if unique:
        leaving = labels.filter("doc_id <> component").select(F.col("doc_id").alias(gone)).distinct()
        return docs.join(leaving, key == F.col(gone), "left_anti")
    labels = saved(labels.filter("component IS NOT NULL"), "labels")
    stays = labels.groupBy("component").agg(F.min(F.struct("doc_id", "set_hash")).alias("stays"))
    gone_set, own, blank = (fresh(docs, c) for c in ("_gone_set", "_set", "_blank"))
    leaving = labels.join(by_shuffle(stays), "component").filter(F.struct("doc_id", "set_hash") != F.col("stays")).select(
        F.col("doc_id").alias(gone), F.col("set_hash").alias(gone_set))

    def row():
        words = _Words()

        def one(text: str):
            s = shingle_set(text, k, words)
            return (hashlib.blake2b(s, digest_size=16).digest() if len(s) else None,)
        return one

    named = docs.filter(key.isNotNull()).withColumn(own, per_text(row, "set_hash binary")(col(docs, text_col))["set_hash"])
    named = named.withColumn(blank, F.when(F.col(own).isNull(), col(docs, text_col)))
    named = named.join(leaving, (key == F.col(gone)) & (F.col(own) == F.col(gone_set)), "left_anti")
    return named.dropDuplicates([id_col, own, blank]).drop(own, blank).unionByName(docs.filter(key.isNull()))
