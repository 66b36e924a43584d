"""Packing by lexical retrieval: windows are filled with what BM25 finds near their seed.

1. Each text becomes token ids, with an end id, and a lexical key (the least hash of its id pairs), so
   texts that share passages tend to share a key.
2. Keys are dealt to buckets, buckets to shards of about :data:`SHARD_TOKENS`; a bucket larger than a
   shard is split over several.  Only the sums per bucket (at most :data:`MAX_BUCKETS`) reach the driver.
3. Document frequencies and the mean length are those of all documents (at most one number per token id).
4. Each shard builds an inverted index of BM25 impacts.  The first unused document seeds a window; its
   terms retrieve unused neighbours of the shard, best first, which fill the window.  Where none is left,
   unused documents follow in order.  The document that meets the end is cut, its rest opens the next window.

So only the last window of a shard is padded.  Nulls: a null text is empty and has the end id only; null
ids are passed through (last in order); repeated rows are packed each.  A text of any length is cut as
often as needed.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import ids_and_texts, saved, text_spread
from voxloom.llm.wordbpe import word_ids

WINDOW, END_ID = 4096, 2
SHARD_TOKENS = 3_000_000
MAX_BUCKETS = 65_536
K1, B = 1.2, 0.75
#: Neighbours sorted at once; postings are cut when fewer than this share of their documents are unused.
FIRST, LISTED = 64, 0.85
#: Terms that one in so many documents of a shard has are kept densely.
DENSE = 10


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n, key, wide, ids``: ids as little-endian unsigned numbers of 32 bits if ``wide``, else 16, end id included.

    The last row of a task has ``df`` alone: in how many of its documents each id occurs, by id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, df = word_ids(path), END_ID.to_bytes(4, "little"), np.zeros(1 << 16, np.int64)
        names = ["doc_id", "n", "key", "wide", "ids", "df"]
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = [words.packed_ids(t or "") for t in batch["text"].to_pylist()]
            n = np.array([len(x) for x in packed]) // 4 + 1
            flat = np.frombuffer(b"".join([x for own in packed for x in (own, end)]), "<u4")
            ends = np.cumsum(n)
            starts = ends - n
            pairs = flat * np.uint32(0x9E3779B1)
            pairs[:-1] ^= flat[1:] * np.uint32(0x85EBCA6B)
            pairs ^= pairs >> np.uint32(15)
            pairs[ends - 1] = 0xFFFFFFFF  # the last id has no pair
            keys = np.where(n > 1, np.minimum.reduceat(pairs, starts), 0)
            top = np.maximum.reduceat(flat, starts)
            wide = top >= 65536
            if wide.any():
                ids = pa.array([flat[i:j].astype("<u4" if w else "<u2").tobytes() for i, j, w in zip(starts, ends, wide)], pa.binary())
            else:
                offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(flat.astype("<u2"))])
            found = distinct(flat, n)[1]
            here = np.bincount(found, minlength=len(df))
            here[:len(df)] += df
            df = here
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(wide), ids,
                                              pa.nulls(len(n), pa.binary())], names)
        if df.any():
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([df.astype("<i8").tobytes()], pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, key long, wide boolean, ids binary, df binary")


def with_shard(tokens: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Add ``shard``: neighbouring buckets of keys together, up to ``shard_tokens`` each."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    buckets = int(min(MAX_BUCKETS, max(64, 4 * total // shard_tokens)))
    bucketed = tokens.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    sums = bucketed.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect()  # at most `buckets` rows
    first, parts, shard, filled = {}, {}, 0, 0
    for r in sums:
        if filled and filled + r.n > 1.1 * shard_tokens:
            shard, filled = shard + 1, 0
        first[r.bucket], parts[r.bucket] = shard, max(1, round(r.n / shard_tokens))
        filled += r.n
        if parts[r.bucket] > 1:
            shard, filled = shard + parts[r.bucket], 0
    plan = tokens.sparkSession.createDataFrame([(b, first[b], parts[b]) for b in first], "bucket int, first long, parts int")
    # By the row's place, so that rows alike in everything are dealt out too.
    salt = F.pmod(F.xxhash64("doc_id", "n", "key", F.monotonically_increasing_id()), F.col("parts"))
    # Bounded by the number of buckets.
    return bucketed.join(F.broadcast(plan), "bucket").withColumn("shard", F.col("first") + salt).drop("bucket", "first", "parts")


def _ids(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), "<u4" if w.as_py() else "<u2") for b, w in zip(table["ids"], table["wide"]) if b.is_valid]


def distinct(flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, id, times)`` of the distinct ids of each document, in order; ``flat`` holds them one after the other."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    if len(lengths) <= 1 << 16 and flat.max(initial=0) < 1 << 16:
        shift, keys = 16, owner.astype(np.uint32) << np.uint32(16) | flat.astype(np.uint32)
    else:
        shift, keys = 32, owner.astype(np.uint64) << np.uint64(32) | flat.astype(np.uint64)
    keys.sort()
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    own, times = keys[at], np.diff(np.r_[at, len(keys)])
    return (own >> own.dtype.type(shift)).astype(np.int64), (own & own.dtype.type((1 << shift) - 1)).astype(np.int64), times


#: Number of documents, their mean length, and the document frequency by token id.
Stats = tuple[int, float, np.ndarray]


def statistics(tokens: DataFrame) -> Stats:
    """Over all rows of :func:`tokenized`, from the frequencies of each task; no ids are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch["df"]:
                df = np.frombuffer(counts.as_buffer(), "<i8")
                t = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(df[t])], ["term", "df"])

    total = tokens.agg(F.count("n").alias("docs"), F.avg("n").alias("mean")).first()
    # At most one row for each id of the vocabulary.
    sums = tokens.filter("df IS NOT NULL").select("df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    term = sums["term"].to_numpy()
    df = np.zeros(int(term.max(initial=0)) + 1, np.int64)
    df[term] = sums["df"].to_numpy()
    return total.docs, float(total.mean or 1), df


class Index:
    """BM25 impacts of a shard's documents, as an inverted index; statistics of these documents unless given.

    Terms that many of the documents have are rows of a dense matrix, of a size bounded by their postings;
    the others have posting lists.  Scores are rounded, so equal documents tie whatever the order of the sums.
    """

    def __init__(self, docs: list[np.ndarray], stats: Stats | None = None):
        self.n, lengths = len(docs), np.array([len(d) for d in docs])
        doc, raw, times = distinct(np.concatenate(docs), lengths)
        tf, size = times.astype(np.float32), lengths.astype(np.float32)
        self.edges = np.searchsorted(doc, np.arange(self.n + 1))
        mark = np.zeros(int(raw.max()) + 1, bool)
        mark[raw] = True
        names = np.flatnonzero(mark)
        place = np.cumsum(mark) - 1
        self.term = place[raw]
        here = np.bincount(self.term, minlength=len(names))
        n, mean, df = (self.n, size.mean(), here) if stats is None else (stats[0], np.float32(stats[1]), stats[2][names])
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5)).astype(np.float32)
        self.impact = weight = (idf[self.term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / mean))).astype(float)
        often = here * DENSE >= self.n
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        in_row = often[self.term]
        self.dense = np.zeros((int(often.sum()), self.n))
        self.dense[self.row[self.term[in_row]], doc[in_row]] = weight[in_row]
        rare = np.flatnonzero(~in_row)
        rare = rare[np.argsort(self.term[rare], kind="stable")]
        self.posted, self.doc, self.weight = self.term[rare], doc[rare], weight[rare]
        self.names = len(names)
        self.at = np.searchsorted(self.posted, np.arange(self.names + 1))
        self.left = np.arange(self.n)  # documents that the columns and postings stand for

    def without(self, used: np.ndarray) -> None:
        """Take used documents out of the index; scores of the others stay as they are."""
        stay = ~used[self.left]
        keep, column = stay[self.doc], np.cumsum(stay) - 1
        self.doc, self.weight, self.posted = column[self.doc[keep]], self.weight[keep], self.posted[keep]
        self.at = np.searchsorted(self.posted, np.arange(self.names + 1))
        self.dense, self.left = np.ascontiguousarray(self.dense[:, stay]), self.left[stay]

    def best_first(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents that share terms with the seed, best first, ties in order; sorted as far as they are asked for."""
        t = self.term[self.edges[seed]:self.edges[seed + 1]]
        rows = self.row[t]
        asked = np.zeros(len(self.dense))
        asked[rows[rows >= 0]] = 1
        rare = t[rows < 0]
        start, times = self.at[rare], self.at[rare + 1] - self.at[rare]
        which = np.repeat(start - (np.cumsum(times) - times), times) + np.arange(times.sum())
        score = np.round(asked @ self.dense + np.bincount(self.doc[which], self.weight[which], len(self.left)), 6)
        found = np.flatnonzero((score > 0) & ~used[self.left])
        while len(found):
            falling = -score[found]
            near = falling <= np.partition(falling, FIRST)[FIRST] if len(found) > 2 * FIRST else np.ones(len(found), bool)
            yield from self.left[found[near][np.argsort(falling[near], kind="stable")]]
            found = found[~near]

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        return np.array(list(self.best_first(seed, used)), np.int64)


def pack_shard(docs: list[np.ndarray], window: int = WINDOW, stats: Stats | None = None) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece, in order."""
    index = Index(docs, stats)
    used, pieces = np.zeros(len(docs), bool), []
    sequence, room, following = 0, window, 0
    queue: Iterator[int] = iter(())
    remaining = listed = len(docs)
    while remaining:
        k = next(queue, None)
        if k is None:
            while used[following]:
                following += 1
            k = following
            # A window that is open already takes the next document alone.
            queue = index.best_first(k, used) if room == window else iter(())
        if used[k]:
            continue
        used[k] = True
        remaining -= 1
        start, n = 0, len(docs[k])
        cut = False
        while start < n:
            take = min(room, n - start)
            pieces.append((k, start, take, sequence, window - room))
            start, room = start + take, room - take
            if not room:
                sequence, room, cut = sequence + 1, window, True
        if cut:
            if remaining < LISTED * listed:
                index.without(used)
                listed = remaining
            # The rest of a cut document seeds the next window; a window that ended evenly waits for the next seed.
            queue = index.best_first(k, used) if room < window else iter(())
    return pieces


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: which ids of which document lie where.  ``ids`` are little-endian unsigned 32-bit numbers."""
    tokens = saved(tokenized(text_spread(ids_and_texts(docs, id_col, text_col)), path), "tokens")
    stats = statistics(tokens)
    tokens = tokens.filter("n IS NOT NULL").drop("df")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("key", "ascending"), ("n", "ascending")])
        ids = _ids(table)
        pieces = pack_shard(ids, window, stats)
        doc, start, length, sequence, offset = (np.array(v, np.int64) for v in zip(*pieces))
        cut = pa.array([ids[k][s:s + n].astype("<u4").tobytes() for k, s, n, _, _ in pieces], pa.binary())
        return pa.table({
            "doc_id": table["doc_id"].combine_chunks().take(pa.array(doc)), "start": start, "length": length, "ids": cut,
            "doc_tokens": np.array([len(i) for i in ids], np.int64)[doc], "sequence_id": (int(table["shard"][0].as_py()) << 32) + sequence,
            "offset": offset})

    return with_shard(tokens, shard_tokens).groupBy("shard").applyInArrow(run, PIECES)
