"""Target-distribution importance resampling.

1. Features are runs of one to three words, hashed to a fixed number of buckets.  Each task counts its
   buckets in one array; the sums over the corpus and over the target texts give every bucket a gain, the
   scaled logarithm of how much likelier the target has it.
2. The weight of a document is the sum of its features' gains, looked up in that array.  A number drawn
   from the hash of its id (Gumbel noise) is added, so the highest scores are a draw without replacement
   with chances in proportion to the exponentials of the weights.
3. The k-th composite key (score down, id up, then feature count and place of the row, so no two are
   equal) is found by distributed quickselect: random keys still open are pivots, one pass counts what lies
   below, at and above each, and the part that holds the k-th stays open.
4. Rows up to that key are drawn; only they are sorted, in ranges, and ranked.

Nulls and odd values: a null text has no words; such documents, and those with fewer words than
``min_words``, are scored but never drawn.  The hash of a null id is that of an empty one; among equal
scores null ids come first.  Rows that repeat an id each count, and are drawn as rows of their own.  With
an empty target all gains are those of its zero counts; an empty corpus gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.llm.common import col, ids_and_texts, per_text, saved, text_spread

BUCKETS, LONGEST_RUN = 10_000, 3
#: Bytes of a text that are cut into words at once; random keys per round; rows sorted in one task.
PART_BYTES, PIVOTS, RANGE_ROWS = 1 << 20, 16, 1_000_000
#: Digits and letters stay, lower-cased, as do all bytes of other characters; the rest parts words.
_WORD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
ORDER = ("down", "known", "id", "n_features", "row")


def run_buckets(text: str, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """``(words, bucket of each run of words)`` of a text, a bounded part at a time.

    The checksum of a run goes on from that of the run without its last word.
    """
    clean, start = text.encode().translate(_WORD), 0
    carried: list[list[int]] = [[] for _ in range(LONGEST_RUN)]
    while start < len(clean):
        end = clean.find(b" ", start + 1 + PART_BYTES)
        end = len(clean) if end < 0 else end
        words = clean[start:end].split()
        start = end
        if not words:
            continue
        spaced = [b" " + w for w in words]
        sums = [list(map(crc32, words))]
        for n in range(1, LONGEST_RUN):
            before = carried[n - 1] + sums[-1][:-1]
            sums.append(list(map(crc32, spaced[len(spaced) - len(before):], before)))
        carried = [s[-1:] for s in sums]
        yield len(words), np.fromiter(chain.from_iterable(sums), np.uint32) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts (column ``text``) in each bucket."""
    def counted(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch["text"]:
                for _, found in run_buckets(t.as_py() or "", buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    sums = text_spread(texts.select("text")).mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # one row a bucket at most
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled logarithm of the smoothed share in the target over that in the source, for each bucket."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(gain: np.ndarray):
    """Arrow UDF: ``n_words, n_features, weight`` of a text."""
    def row():
        def weigh(text: str) -> tuple[int, int, int]:
            words = features = weight = 0
            for n, found in run_buckets(text, len(gain)):
                words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
            return words, features, weight

        return weigh

    return per_text(row, "n_words long, n_features long, weight long")


def gumbel(ids: Column, seed: int) -> Column:
    """Scaled Gumbel noise from the hash of ``seed:id``, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def kth_key(keys: DataFrame, k: int, order: Sequence[str], pivots: int = PIVOTS) -> Row:
    """The k-th (from 1) of the unique keys ``order``, all of them longs, ascending."""
    key = F.struct(*order)

    def lit(r: Row) -> Column:
        return F.struct(*[F.lit(r[c]).cast("long").alias(c) for c in order])

    low = high = None
    passed, rounds = 0, 0  # keys up to and with low
    while True:
        rest = keys
        if low is not None:
            rest = rest.filter((F.col(order[0]) >= low[order[0]]) & (key > lit(low)))
        if high is not None:
            rest = rest.filter((F.col(order[0]) <= high[order[0]]) & (key < lit(high)))
        chosen = sorted(rest.select(*order).orderBy(F.xxhash64(F.lit(rounds), *order)).limit(pivots).collect())
        marks = F.array(*[lit(r) for r in chosen])
        # 2i: between pivots i-1 and i; 2i + 1: pivot i itself.
        cell = 2 * F.size(F.filter(marks, lambda m: m < key)) + F.array_contains(marks, key).cast("int")
        counts = {r.cell: r["count"] for r in rest.select(cell.alias("cell")).groupBy("cell").count().collect()}
        for i in range(2 * len(chosen) + 1):
            if passed + counts.get(i, 0) >= k:
                break
            passed += counts.get(i, 0)
        if i % 2:
            return chosen[i // 2]
        low, high, rounds = (chosen[i // 2 - 1] if i else low), (chosen[i // 2] if i // 2 < len(chosen) else high), rounds + 1


def ranked(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """``rows`` with ``rank`` from 1: sorted in ranges, each by one task, plus the rows of the ranges before."""
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // RANGE_ROWS))
    cut = saved(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy("part").count()  # at most one row a range
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return cut.withColumn("place", place).join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("place"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank``: every document; ``rank`` is null where it isn't drawn.

    ``percent`` of the documents with ``min_words`` words or more are drawn, rounded down.
    """
    own = ids_and_texts(docs, id_col, text_col)
    gain = gains(bucket_counts(own, buckets), bucket_counts(target.select(col(target, target_col).alias("text")), buckets))
    scored = text_spread(own).select("doc_id", weights(gain)(F.col("text")).alias("w")).select("doc_id", "w.*")
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    keyed = saved(scored.select("*", (-F.col("score")).alias("down"), F.col("doc_id").isNotNull().cast("long").alias("known"),
                                F.coalesce("doc_id", F.lit(0)).alias("id"), F.monotonically_increasing_id().alias("row")), "scores")
    out = ("doc_id", "n_words", "n_features", "weight", "score")
    enough = F.col("n_words") >= min_words
    k = percent * keyed.filter(enough).count() // 100
    if not k:
        return keyed.select(*out, F.lit(None).cast("long").alias("rank"))
    last = kth_key(keyed.filter(enough), k, ORDER)
    drawn = enough & (F.struct(*ORDER) <= F.struct(*[F.lit(last[c]).cast("long").alias(c) for c in ORDER]))
    winners = ranked(keyed.filter(drawn), ORDER, k)
    return keyed.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank")).unionAll(winners.select(*out, F.col("rank").cast("long")))
