"""Exact top-k inner products: tiled matrix products, partial selection per tile, tree merging.

1. Components become ``floor(scale * x)``.  Where the rows are read, they are packed into tiles of
   integers, as narrow as their values allow, and written to the shared folder.
2. Tiles of queries form blocks and tiles of vectors form shards of bounded bytes.  Each block meets each
   shard once, in a task of its own that multiplies them piece by piece.  Of each product only scores above
   the k-th best so far of their query are looked at; ties are cut by id before anything is listed.
3. The lists of a query are merged sixteen at a time, level by level, by tasks that hold a bounded number
   of queries.

Products are exact: single or double precision where the bound of the sums allows it, else 64-bit
integers, else Python's integers; scores beyond a long are held at its limits.

Nulls and odd values: rows with a null id, and vectors that are null, empty, hold nulls, or hold
components that are not finite after scaling, take no part; zero vectors do.  A query meets vectors of
its own length only.  Rows that repeat an id are one candidate, or one query, with the highest score; a
query never meets its own id.  Ties go to smaller ids.  With too few candidates all are returned; an
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import col, saved

#: Rows of a tile, packed bytes of a block of queries and of a shard, lists merged at once, queries merged in one task.
TILE_ROWS, TILE_BYTES = 1024, 4 << 20
BLOCK_BYTES, SHARD_BYTES = 16 << 20, 64 << 20
FAN_IN, MERGED_QUERIES = 16, 8192
#: Rows and columns of one matrix product.
PRODUCT_ROWS, PRODUCT_COLUMNS = 1024, 4096
LIMIT = (1 << 63) - 1
WIDTHS = ((1, np.int8), (2, np.int16), (4, np.int32), (8, np.float64))
TILES = "tile long, dims int, width int, n int, ids binary, numbers binary"


def scaled(values: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """``(floor(scale * values), rows that are finite)``, in doubles."""
    with np.errstate(over="ignore"):
        x = np.floor(scale * values)
    return x, np.isfinite(x).all(axis=1)


def tiles(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """The rows that take part, packed where they are read; see :data:`TILES`."""
    v = col(rows, vector_col).cast("array<double>")
    d = rows.select(col(rows, id_col).cast("long").alias("id"), v.alias("v")).filter("id IS NOT NULL AND size(v) > 0")
    d = d.filter(F.forall("v", lambda x: x.isNotNull()))

    def packed(batches):
        part, held, made = TaskContext.get().partitionId(), defaultdict(list), 0

        def tile(key):
            nonlocal made
            dims, width = key
            ids, numbers = (np.concatenate(c) for c in zip(*held.pop(key)))
            made += 1
            return pa.RecordBatch.from_pydict({
                "tile": pa.array([(part << 32) + made], pa.int64()), "dims": pa.array([dims], pa.int32()), "width": pa.array([width], pa.int32()),
                "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "numbers": pa.array([numbers.tobytes()], pa.binary())})

        for b in batches:
            ids, lengths = b["id"].to_numpy(), pc.list_value_length(b["v"]).to_numpy()
            flat, ends = b["v"].flatten().to_numpy(), np.cumsum(lengths)
            for dims in np.unique(lengths):
                rows_at = np.flatnonzero(lengths == dims)
                x, fits = scaled(flat[(ends[rows_at] - dims)[:, None] + np.arange(dims)], scale)
                x, own = x[fits], ids[rows_at][fits]
                top = np.abs(x).max(axis=1) if len(x) else np.zeros(0)
                low = -1.0
                for width, kind in WIDTHS:
                    high = np.inf if kind is np.float64 else float(np.iinfo(kind).max)
                    inside, low = np.flatnonzero((top > low) & (top <= high)), high
                    step = int(max(1, min(TILE_ROWS, TILE_BYTES // (width * dims))))
                    key = (int(dims), width)
                    while len(inside):
                        room = step - sum(len(i) for i, _ in held[key])
                        held[key].append((own[inside[:room]], x[inside[:room]].astype(kind)))
                        inside = inside[room:]
                        if sum(len(i) for i, _ in held[key]) >= step:
                            yield tile(key)
        for key in [k for k, h in held.items() if h]:
            yield tile(key)

    return d.mapInArrow(packed, TILES)


def unpacked(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(ids, matrix)`` of the tiles of each width, by id."""
    out = []
    for width, kind in WIDTHS:
        own = table.filter(pc.equal(table["width"], width))
        if own.num_rows:
            ids = np.frombuffer(b"".join(own["ids"].to_pylist()), np.int64)
            x = np.frombuffer(b"".join(own["numbers"].to_pylist()), kind).reshape(len(ids), -1)
            order = np.argsort(ids, kind="stable")
            out.append((ids[order], x[order]))
    return out


def _clamped(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of numbers too large for 64-bit sums, held at the limits of a long."""
    (ma, ea), (mb, eb) = (np.frexp(np.abs(m).max(axis=1)) for m in (a, b))
    x, y = np.ldexp(a, -ea[:, None]), np.ldexp(b, -eb[:, None])
    rough, slack = x @ y.T, a.shape[1] ** 2 * 2.0 ** -50
    edge = np.ldexp(1.0, np.clip(63 - ea[:, None] - eb, -1000, 1000))
    out = np.where(rough > 0, LIMIT, -LIMIT)
    near = np.abs(rough) - slack < edge
    apart = (a != 0).astype(np.float32) @ (b != 0).astype(np.float32).T == 0
    out[apart] = 0
    for i, j in np.argwhere(near & ~apart):
        exact = sum(int(p) * int(q) for p, q in zip(a[i], b[j]))
        out[i, j] = max(-LIMIT, min(LIMIT, exact))
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two matrices of whole numbers, in the fastest type that holds them."""
    bound = a.shape[1] * max(float(np.abs(a.astype(float)).max()), 1.0) * max(float(np.abs(b.astype(float)).max()), 1.0)
    if bound < 2.0 ** 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if bound < 2.0 ** 53:
        return a.astype(float) @ b.astype(float).T
    if bound < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return _clamped(a.astype(float), b.astype(float))


def best(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each query, best first, ties to smaller ids; an id counts once a query."""
    order = np.lexsort((ids, -scores, queries))
    queries, ids, scores = queries[order], ids[order], scores[order]
    by_id = np.lexsort((ids, queries))  # stable: the best entry of an id comes first
    again = np.zeros(len(ids), bool)
    again[by_id[1:]] = (queries[by_id[1:]] == queries[by_id[:-1]]) & (ids[by_id[1:]] == ids[by_id[:-1]])
    queries, ids, scores = queries[~again], ids[~again], scores[~again]
    first = np.searchsorted(queries, queries, side="left")
    keep = np.arange(len(queries)) - first < k
    return queries[keep], ids[keep], scores[keep]


def _selected(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest of each row, ties to the left, in any order."""
    n = s.shape[1]
    if s.dtype != np.int64 and np.abs(s[np.isfinite(s)]).max(initial=0) < 2.0 ** 40:
        return np.argpartition(np.arange(n) - s.astype(float) * n, k - 1, axis=1)[:, :k]
    return (n - 1 - np.argsort(s[:, ::-1], axis=1, kind="stable"))[:, ::-1][:, :k]


def searched(asked: tuple[np.ndarray, np.ndarray], shard: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, id, score)`` of the k best of each row of ``asked`` within ``shard``."""
    own, x = asked
    rows = np.zeros(0, np.int64)
    ids, scores, seen = rows, rows, None
    floor = np.full(len(own), -LIMIT - 1)  # k-th best so far
    for vec_ids, v in shard:
        for start in range(0, len(vec_ids), PRODUCT_COLUMNS):
            c = vec_ids[start:start + PRODUCT_COLUMNS]
            s = products(x, v[start:start + PRODUCT_COLUMNS])
            heads = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            if len(heads) < len(c):
                s, c = np.maximum.reduceat(s, heads, axis=1), c[heads]
            none = np.iinfo(np.int64).min if s.dtype == np.int64 else -np.inf
            at = np.minimum(np.searchsorted(c, own), len(c) - 1)
            itself = np.flatnonzero(c[at] == own)
            s[itself, at[itself]] = none
            least = np.where(floor < -LIMIT, none, floor).astype(s.dtype)[:, None]
            # Within ascending ids a tie loses to what is there already.
            hit = (s > least) if seen is not None and c[0] > seen else (s >= least) & (s != none)
            seen = c[-1] if seen is None else max(seen, c[-1])
            count = hit.sum(axis=1)
            many = np.flatnonzero(count > k)
            if len(many):
                chosen = _selected(np.where(hit[many], s[many], none), k)
                hit[many] = False
                hit[many[:, None], chosen] = True
            r, j = np.nonzero(hit)
            if not len(r):
                continue
            changed = np.zeros(len(own), bool)
            changed[r] = True
            stay = ~changed[rows]
            new = best(np.r_[rows[~stay], r], np.r_[ids[~stay], c[j]], np.r_[scores[~stay], s[r, j].astype(np.int64)], k)
            rows, ids, scores = (np.r_[old[stay], n] for old, n in zip((rows, ids, scores), new))
            places, first, held = np.unique(new[0], return_index=True, return_counts=True)
            full = held == k
            floor[places[full]] = new[2][first[full] + k - 1]
    return rows, ids, scores


def lists(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, part: int) -> pa.Table:
    """One row for each query; entries come ordered by query."""
    own, first = np.unique(queries, return_index=True)
    ends = pa.array(np.r_[first, len(queries)].astype(np.int32))
    return pa.table({"query_id": pa.array(own, pa.int64()), "part": pa.array(np.full(len(own), part), pa.int64()),
                     "ids": pa.ListArray.from_arrays(ends, pa.array(ids, pa.int64())), "scores": pa.ListArray.from_arrays(ends, pa.array(scores, pa.int64()))})


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of each query, its own id left out."""
    points = saved(tiles(vectors, id_col, vector_col, scale), "tiles")
    asked = saved(tiles(queries, id_col, vector_col, scale), "asked")
    size = F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.length("numbers")), F.lit(0)).alias("bytes"))
    have, wanted = points.select(size).first()[0], asked.select(size).first()[0]
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-wanted.bytes // BLOCK_BYTES))
    shards = max(1, -(-have.bytes // SHARD_BYTES), min(2 * cores, have.rows // TILE_ROWS))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("tile"), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    def cell(shard: pa.Table, block: pa.Table) -> pa.Table:
        part, found = 0, []
        if shard.num_rows and block.num_rows:
            part = block["block"][0].as_py() * shards + block["shard"][0].as_py()
            inside = unpacked(shard)
            for own, x in unpacked(block):
                for i in range(0, len(own), PRODUCT_ROWS):
                    r, ids, scores = searched((own[i:i + PRODUCT_ROWS], x[i:i + PRODUCT_ROWS]), inside, k)
                    found.append((own[i + r], ids, scores))
        q, ids, scores = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        return lists(*best(q, ids, scores, k), part)

    schema, keys = "query_id long, part long, ids array<long>, scores array<long>", ("dims", "block", "shard")
    found = dealt(points, "shard", shards, "block", blocks).groupBy(*keys).cogroup(
        dealt(asked, "block", blocks, "shard", shards).groupBy(*keys)).applyInArrow(cell, schema)

    def merged(group: pa.Table) -> pa.Table:
        ids, scores = (group[c].combine_chunks() for c in ("ids", "scores"))
        q = np.repeat(group["query_id"].to_numpy(), pc.list_value_length(ids).to_numpy())
        return lists(*best(q, ids.flatten().to_numpy(), scores.flatten().to_numpy(), k), group["part"][0].as_py() // FAN_IN)

    groups, parts = -(-max(1, wanted.rows) // MERGED_QUERIES), blocks * shards
    while True:
        bucket = F.pmod(F.xxhash64("query_id"), F.lit(max(groups, min(cores, wanted.rows // 64)) or 1)).alias("bucket")
        found = found.groupBy(bucket, F.expr(f"part div {FAN_IN}").alias("branch")).applyInArrow(merged, schema)
        parts = -(-parts // FAN_IN)
        if parts == 1:
            break
    pairs = found.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("rank", "pair"))
    return pairs.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("pair.ids").alias("vec_id"), F.col("pair.scores").alias("score"))
