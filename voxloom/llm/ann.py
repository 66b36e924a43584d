"""Approximate nearest neighbours with balanced posting lists.

1. A bounded sample is halved again and again at the median between two centres, and the means of the parts
   are moved to the middle of their nearest vectors, those of large parts reaching less far.  These centroids
   and their neighbour graph stay in memory (bounded in number and bytes).
2. Every distinct vector goes to its nearest list, found by a beam search over the graph, and near a boundary,
   within :data:`COPY_RATIO` of that distance, to the next lists too.  :func:`index` returns these postings, so copies can be counted.
3. A query finds lists by the graph and reads those whose centroid is at most ``1 + ratio`` times as far as its
   nearest; its beam is doubled until the ratio, not the beam, ends the choice.  The :data:`LEAST_LISTS`
   nearest are read in any case.  The ratio is the least one that finds the share :data:`RECALL` of the nearest
   neighbours of some sampled vectors within the sample, which lie farther off than those in the table.  With ``exact`` it reads every list that the triangle inequality does not exclude.
4. Lists lie in shards.  A query goes once to each shard that holds lists of it, and leaves with its best few of
   all of them, so what is emitted does not grow with the lists read.

Equal vectors are searched once; as ties go to smaller ids, the first ids of each are enough.

Numbers are divided by the largest in the table while lists are found and near ones chosen, in doubles;
scores are distances of the original vectors, scaled where squares would leave the range of a double.

Nulls and odd values: rows with a null id, or a vector that is null, zero, of another length than most
(ties: the shorter), or holds nulls or non-finite values take no part.  Rows that repeat an id are one
candidate with the smaller distance, and one query.  With too few candidates all are returned; an empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import bounded_sample, col, saved
from voxloom.session import small_side

SAMPLE_ROWS, MAX_CENTROIDS, MEMORY_BYTES = 20_000, 8192, 64 << 20
TARGET_ROWS, LIST_ROWS, SHARD_BYTES = 256, 4096, 32 << 20
GRAPH_DEGREE, ENTRIES, BEAM = 24, 16, 64
COPIES, COPY_RATIO = 3, 0.05
RECALL, TRIALS, LEAST_LISTS = 0.97, 256, 16
ROUNDS, BALANCE = 6, 0.1
#: Relative slack of the bounds, far above rounding.
SLACK = 1e-6


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0), np.float32)


def halved(x: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of ``lists`` parts of near equal size."""
    rng = np.random.default_rng(9)
    parts, out = [(np.arange(len(x)), lists)], []
    while parts:
        rows, k = parts.pop()
        if k <= 1 or len(rows) < 4:
            out.append(x[rows].mean(axis=0))
            continue
        y = x[rows]
        a, b = y[rng.choice(len(y), 2, replace=False)]
        for _ in range(6):
            side = y @ (a - b)
            near = side > np.median(side)
            if near.all() or not near.any():
                break
            a, b = y[near].mean(axis=0), y[~near].mean(axis=0)
        order = np.argsort(-(y @ (a - b)), kind="stable")
        left = k // 2
        cut = len(rows) * left // k
        parts += [(rows[order[:cut]], left), (rows[order[cut:]], k - left)]
    return np.array(out)


def centred(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids moved to the means of their nearest vectors, a few times; large parts count as farther away."""
    c, size = centroids, np.full(len(centroids), len(x) / len(centroids))
    for _ in range(ROUNDS if len(c) > 1 else 0):
        near = np.empty(len(x), int)
        weight = np.maximum(size * len(c) / len(x), 0.1) ** BALANCE
        for i in range(0, len(x), 1024):
            near[i:i + 1024] = (_squares(x[i:i + 1024], c) * weight).argmin(axis=1)
        size = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
    return c


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all rows of ``y``."""
    return np.maximum((x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1) - 2 * x @ y.T, 0)


class Graph:
    """Neighbour graph over centroids with a beam search for many vectors at once."""

    def __init__(self, centroids: np.ndarray):
        self.c = np.asarray(centroids, float)
        n = len(self.c)
        self.square = (self.c ** 2).sum(axis=1)
        degree = min(GRAPH_DEGREE, max(0, n - 1))
        near = []
        for i in range(0, n, 512):
            d = self.square - 2 * self.c[i:i + 512] @ self.c.T
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            near.append(np.argpartition(d, degree - 1, axis=1)[:, :degree] if degree else np.zeros((len(d), 0), int))
        self.near = np.concatenate(near)
        self.entries = np.unique(np.linspace(0, n - 1, min(ENTRIES, n)).astype(int))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """``(lists, distances)`` of the nearest centroids found, nearest first; unused places are -1, infinite."""
        ids, dist = [], []
        for i in range(0, len(x), 512):
            a, b = self._search(np.asarray(x[i:i + 512], float), beam)
            ids.append(a)
            dist.append(b)
        return np.concatenate(ids), np.concatenate(dist)

    def _search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        m, rows = len(x), np.arange(len(x))
        base = (x ** 2).sum(axis=1)

        def distances(lists):
            d = base[:, None] + self.square[lists] - 2 * np.einsum("mkd,md->mk", self.c[lists], x)
            return np.sqrt(np.maximum(d, 0))

        width = max(beam, len(self.entries))
        ids, dist = np.full((m, width), -1), np.full((m, width), np.inf)
        done = np.ones((m, width), bool)
        k = len(self.entries)
        ids[:, :k], dist[:, :k], done[:, :k] = self.entries, distances(np.broadcast_to(self.entries, (m, k))), False
        seen = np.zeros((m, len(self.c)), bool)
        seen[:, self.entries] = True
        while True:
            best = np.where(done, np.inf, dist).argmin(axis=1)
            open_rows = ~done[rows, best]
            if not open_rows.any():
                break
            done[rows, best] = True
            new = self.near[np.where(ids[rows, best] < 0, 0, ids[rows, best])]
            d = np.where(seen[rows[:, None], new] | ~open_rows[:, None], np.inf, distances(new))
            seen[rows[open_rows, None], new[open_rows]] = True
            ids, dist = np.concatenate([ids, new], axis=1), np.concatenate([dist, d], axis=1)
            done = np.concatenate([done, np.isinf(d)], axis=1)
            order = np.argsort(dist, axis=1, kind="stable")[:, :width]
            ids, dist, done = (np.take_along_axis(v, order, axis=1) for v in (ids, dist, done))
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist = np.take_along_axis(ids, order, axis=1), np.take_along_axis(dist, order, axis=1)
        return np.where(np.isinf(dist), -1, ids), dist

    def homes(self, x: np.ndarray) -> np.ndarray:
        """Lists of each vector, the nearest first, up to :data:`COPIES`, -1 where unused."""
        ids, dist = self.search(x, BEAM)
        ids, dist = ids[:, :COPIES], dist[:, :COPIES]
        return np.where(dist <= (1 + COPY_RATIO) * dist[:, :1], ids, -1)

    def within(self, x: np.ndarray, ratio: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """``(row, list)`` of the lists within ``ratio`` of the nearest found, and of the ``least`` nearest; beams grow until they hold all."""
        rows, lists, todo, beam = [], [], np.arange(len(x)), max(BEAM, least)
        while len(todo):
            ids, dist = self.search(x[todo], min(beam, len(self.c)))
            fits = (ids >= 0) & ((dist <= (1 + ratio) * dist[:, :1]) | (np.arange(ids.shape[1]) < least))
            # Done where the worst of the beam lies beyond the ratio, or the beam holds all lists.
            done = ~fits[:, -1] | (beam >= len(self.c))
            r, k = np.nonzero(fits & done[:, None])
            rows.append(todo[r])
            lists.append(ids[r, k])
            todo, beam = todo[~done], beam * 2
        return (np.concatenate(rows), np.concatenate(lists)) if rows else (np.zeros(0, int), np.zeros(0, int))


def probe_ratio(graph: Graph, x: np.ndarray, k: int) -> float:
    """The least ratio by which :data:`TRIALS` rows of ``x`` find the lists of the share :data:`RECALL` of their ``k`` nearest in ``x``."""
    trials = np.unique(np.linspace(0, len(x) - 1, min(TRIALS, len(x))).astype(int))
    k = min(k, len(x) - 1)
    if k < 1 or len(graph.c) <= LEAST_LISTS:
        return 0.0
    d = _squares(x[trials], x)
    d[np.arange(len(trials)), trials] = np.inf
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    gaps = np.sqrt(_squares(x[trials], graph.c))
    gaps = np.where(gaps <= np.partition(gaps, LEAST_LISTS - 1, axis=1)[:, LEAST_LISTS - 1:LEAST_LISTS], 0, gaps / np.maximum(gaps.min(axis=1, keepdims=True), 1e-300))
    homes = graph.homes(x[near.ravel()]).reshape(len(trials), k, -1)
    ratios = np.where(homes >= 0, gaps[np.arange(len(trials))[:, None, None], homes], np.inf).min(axis=2)
    return float(np.clip(np.quantile(ratios, RECALL, method="higher") - 1, 0, 1e9))


def needed(x: np.ndarray, centroids: np.ndarray, radius: np.ndarray, sample: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, list)`` of the lists that may hold one of the ``n`` nearest of each row; an empty list has radius -inf."""
    rows, lists = [], []
    top = np.sqrt(max((sample ** 2).sum(axis=1).max(), (centroids ** 2).sum(axis=1).max()))
    for i in range(0, len(x), 256):
        y = x[i:i + 256]
        bound = np.sqrt(np.partition(_squares(y, sample), n - 1, axis=1)[:, n - 1]) if len(sample) >= n else np.full(len(y), np.inf)
        slack = SLACK * (np.sqrt((y ** 2).sum(axis=1)) + top)
        r, k = np.nonzero(~(np.sqrt(_squares(y, centroids)) - radius > (bound + slack)[:, None]) & (radius >= 0))
        rows.append(r + i)
        lists.append(k)
    return (np.concatenate(rows), np.concatenate(lists)) if rows else (np.zeros(0, int), np.zeros(0, int))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of equal rows, summed component by component; scaled where squares overflow or vanish."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        gap = a - b
        total = np.zeros(len(gap))
        for j in range(gap.shape[1]):
            total += gap[:, j] * gap[:, j]
        out = np.sqrt(total)
        odd = np.flatnonzero(~np.isfinite(total) | (total < 1e-290))
        if len(odd):
            gap = a[odd] / 2 - b[odd] / 2
            top = np.abs(gap).max(axis=1)
            safe = np.where(top > 0, top, 1)
            out[odd] = np.sqrt(((gap / safe[:, None]) ** 2).sum(axis=1)) * top * 2
    return out


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the rows with an id and a finite vector other than zero."""
    v = col(vectors, vector_col).cast("array<double>")
    d = vectors.select(col(vectors, id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND size(v) > 0")
    return d.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))


def shape(rows: DataFrame) -> tuple[int, float]:
    """The commonest length, and the largest absolute component among vectors of it."""
    top = F.max(F.array_max(F.transform("v", F.abs)))
    found = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), top.alias("top")).orderBy(F.desc("rows"), "n").first()
    return (found.n, found.top) if found else (0, 1.0)


def index(points: DataFrame, graph: Graph, scale: float) -> DataFrame:
    """``list, far, ids, v``: a row for each vector and each of its lists; ``far`` is 0 for copies."""
    def assigned(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b["v"]) / scale
            homes = graph.homes(v)
            r, c = np.nonzero(homes >= 0)
            # Copies do not widen a list: each vector is found in its first one.
            far = np.where(c == 0, np.sqrt(((v[r] - graph.c[homes[r, c]]) ** 2).sum(axis=1)), 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(homes[r, c].astype(np.int32)), pa.array(far), b["ids"].take(pa.array(r)), b["v"].take(pa.array(r))],
                                             ["list", "far", "ids", "v"])

    return points.select("ids", "v").mapInArrow(assigned, "list int, far double, ids array<long>, v array<double>")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", exact: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query, Euclidean, its own id left out."""
    spark, n_keep = vectors.sparkSession, k + 1  # one may be the query itself
    rows = valid(vectors, id_col, vector_col)
    dims, scale = shape(rows)
    rows = rows.filter(F.size("v") == dims)
    # The first ids of each distinct vector; the limit is applied before the shuffle as well.
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    firsts = rows.distinct().withColumn("r", place).filter(F.col("r") <= n_keep)
    points = saved(firsts.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("point", F.element_at("ids", 1)), "points")
    asked = saved(valid(queries, id_col, vector_col).filter(F.size("v") == dims).distinct(), "asked")
    # Combined before the shuffle, so a vector that many queries have is no hot key.
    targets = saved(asked.groupBy("v").agg(F.min("vec_id").alias("target")), "targets")

    n, cores = points.count(), spark.sparkContext.defaultParallelism
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    held = max(1, MEMORY_BYTES // (8 * dims))
    sample = bounded_sample(points.select("point", "v"), "point", min(SAMPLE_ROWS, held)).orderBy("point").toArrow()
    x = _matrix(sample["v"]) / scale
    graph = Graph(centred(x, halved(x, int(min(MAX_CENTROIDS, held, max(1, -(-n // TARGET_ROWS)), max(1, len(x) // 4))))))

    postings = saved(index(points, graph, scale), "postings")
    # At most MAX_CENTROIDS rows.
    sums = postings.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).cast("int").alias("parts"), F.max("far").alias("far"), F.count("*").alias("n")).collect()
    parts, radius = np.zeros(len(graph.c), int), np.full(len(graph.c), -np.inf)
    parts[[r.list for r in sums]], radius[[r.list for r in sums]] = [r.parts for r in sums], [r.far for r in sums]
    shards = int(max(1, -(-sum(r.n for r in sums) * dims * 8 // SHARD_BYTES), min(2 * cores, len(sums))))
    spread = 7919  # parts of a list lie in different shards
    sizes = F.broadcast(spark.createDataFrame([(r.list, r.parts) for r in sums], "list int, parts int"))
    part = F.pmod(F.xxhash64("v"), F.col("parts"))
    dealt = postings.join(sizes, "list").withColumn("shard", F.pmod(F.col("list") + part * spread, F.lit(shards)).cast("int"))
    bounds, ratio = (x, 0.0) if exact else (None, probe_ratio(graph, x, k))

    def probed(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b["v"]) / scale
            r, c = needed(v, graph.c, radius, bounds, n_keep) if exact else graph.within(v, ratio, LEAST_LISTS)
            times = parts[c]
            p = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            r, c = np.repeat(r, times), np.repeat(c, times)
            # A list once for each query and shard.
            key = np.unique(np.stack([r, (c + p * spread) % shards, c]), axis=1)
            head = np.flatnonzero(np.r_[True, (key[:2, 1:] != key[:2, :-1]).any(axis=0)]) if key.shape[1] else np.zeros(0, int)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[head, key.shape[1]].astype(np.int32)), pa.array(key[2].astype(np.int32)))
            at = pa.array(key[0, head])
            yield pa.RecordBatch.from_arrays([pa.array(key[1, head].astype(np.int32)), lists, b["target"].take(at), b["v"].take(at)], ["shard", "lists", "target", "v"])

    probes = targets.mapInArrow(probed, "shard int, lists array<int>, target long, v array<double>")

    def nearest(shard: pa.Table, wanted: pa.Table) -> pa.Table:
        best_t, best_i, best_d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if shard.num_rows and wanted.num_rows:
            own = shard["list"].to_numpy()
            order = np.argsort(own, kind="stable")
            own, a = own[order], _matrix(shard["v"])[order]
            ids = shard["ids"].combine_chunks().take(pa.array(order))
            counts = pa.compute.list_value_length(ids).to_numpy()
            ends, flat = np.cumsum(counts), ids.flatten().to_numpy()
            q, target = _matrix(wanted["v"]), wanted["target"].to_numpy()
            small_a, small_q = a / scale, q / scale
            asks = wanted["lists"].combine_chunks()
            who = np.repeat(np.arange(len(asks)), pa.compute.list_value_length(asks).to_numpy())
            which = asks.flatten().to_numpy()
            by_list = np.argsort(which, kind="stable")
            who, which = who[by_list], which[by_list]
            bound = np.full(len(q), np.inf)  # squared and scaled: the worst of the best so far
            slack = SLACK * ((small_q ** 2).sum(axis=1) + dims)
            found: list[tuple] = []
            held = 0

            def reduced() -> None:
                nonlocal found, held
                r, i, d = best(*(np.concatenate(c) for c in zip(*found)), n_keep)
                found, held = [(r, i, d)], 0
                rows, first, have = np.unique(r, return_index=True, return_counts=True)
                full = have == n_keep
                bound[rows[full]] = (d[first[full] + n_keep - 1] / scale) ** 2

            for one in np.unique(which):
                lo, hi = np.searchsorted(own, [one, one + 1])
                group = who[np.searchsorted(which, one):np.searchsorted(which, one + 1)]
                for start in range(lo, hi, LIST_ROWS):
                    some = slice(start, min(hi, start + LIST_ROWS))
                    for i in range(0, len(group), 512):
                        g = group[i:i + 512]
                        rough = _squares(small_q[g], small_a[some])
                        edge = bound[g]
                        if rough.shape[1] > n_keep:
                            edge = np.minimum(edge, np.partition(rough, n_keep - 1, axis=1)[:, n_keep - 1])
                        r, j = np.nonzero(rough <= (edge + slack[g])[:, None])
                        j = j + start
                        d = distances(a[j], q[g[r]])
                        times = counts[j]
                        at = np.repeat(ends[j] - times, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        found.append((np.repeat(g[r], times), flat[at], np.repeat(d, times)))
                        held += len(at)
                        if held > max(100_000, 4 * n_keep * len(q)):
                            reduced()
            if found:
                reduced()
                best_t, best_i, best_d = target[found[0][0]], found[0][1], found[0][2]
        return pa.table({"target": pa.array(best_t, pa.int64()), "vec_id": pa.array(best_i, pa.int64()), "score": pa.array(best_d, pa.float64())})

    found = dealt.select("shard", "list", "ids", "v").groupBy("shard").cogroup(probes.groupBy("shard")).applyInArrow(nearest, "target long, vec_id long, score double")
    order = Window.partitionBy("target").orderBy("score", "vec_id")
    merged = found.groupBy("target", "vec_id").agg(F.min("score").alias("score")).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n_keep)
    hits = merged.groupBy("target").agg(F.collect_list(F.struct("score", "vec_id")).alias("hits"))
    # One row for each distinct vector; the queries that have it may be many, so the rows of answers go to them while they are few.
    answers = small_side(targets.join(hits, "target").select("v", "hits"), 10_000)
    pairs = asked.join(answers, "v").select(F.col("vec_id").alias("query_id"), F.explode("hits").alias("hit")).filter("query_id <> hit.vec_id")
    pairs = pairs.groupBy("query_id", "hit.vec_id").agg(F.min("hit.score").alias("score"))  # a query that repeats with other vectors
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest entries of each row, nearest first, ties to smaller ids; an id counts once a row."""
    order = np.lexsort((ids, scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    by_id = np.lexsort((ids, rows))  # stable: the nearest entry of an id comes first
    again = np.zeros(len(ids), bool)
    again[by_id[1:]] = (rows[by_id[1:]] == rows[by_id[:-1]]) & (ids[by_id[1:]] == ids[by_id[:-1]])
    rows, ids, scores = rows[~again], ids[~again], scores[~again]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[keep], ids[keep], scores[keep]
