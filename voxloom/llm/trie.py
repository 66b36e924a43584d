"""Prefix trie of conversations, built as a burst trie.

1. A turn becomes a symbol of fixed length: a 128-bit hash of role and text, and its number of words.  A
   conversation is one string of symbols, so its prefixes are prefixes of the string.  Conversations are
   rebuilt with the first turns of another one (see :func:`rebuilt`).
2. Equal conversations become one row with their number, smallest id and the digest of their ids, which is
   fed block by block in the order of the ids.
3. All rows start in the container of the root.  A container with more than :data:`CONTAINER_ROWS` rows (or
   :data:`CONTAINER_TURNS` turns of two rows or more) bursts: its prefix becomes a head of the trie and its
   rows move on by their next turn.  Several levels burst in one round, twice as many in the next.
4. Remaining containers lie in shards, sorted by prefix and string.  One sweep with a stack over a container makes its
   nodes with all sums of their subtrees.
5. Heads add up the tops of their containers, and pass the sums to the heads above them.

Nulls and odd values: rows with a null id belong to no conversation and are left out; a null role or text is
empty; null turns come first, and rows of one turn number are ordered by role and text, repeated rows
included.  A conversation without turns is a member of the root only.  An empty table has no nodes.  The
remainder of a negative id is negative, as in SQL.  Extra columns are ignored.  A conversation is one row
after step 1, 20 bytes a turn.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.llm.common import WS, col, saved
from voxloom.session import small_side

#: Bytes of a symbol: the hash of a turn, then its words.
HASH_BYTES, SYMBOL = 16, 20
CONTAINER_ROWS, CONTAINER_TURNS, FIRST_LEVELS = 2048, 200_000, 4
#: Ids in one block of a digest; rows and bytes in one batch of results.
BLOCK_IDS, BATCH_ROWS, BATCH_BYTES = 65_536, 4096, 8 << 20
NO_IDS = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def symbol(role: Column, text: Column) -> Column:
    """A turn in hexadecimal digits."""
    turn = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(f"[^{WS}]+"))
    return F.concat(F.substring(turn, 1, 2 * HASH_BYTES), F.lpad(F.hex(words), 8, "0"))


def rebuilt(turns: DataFrame, donors_every: int = 20, most_given: int = 4, id_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, seq``: each conversation with the first turns of its donor, then its own from there on.

    The donor of ``c`` is ``c - c % donors_every``; it gives ``crc32(c) % most_given`` turns, or all it has.
    """
    own = turns.select(col(turns, id_col).cast("long").alias("conv_id"), col(turns, turn_col).alias("turn"),
                       *[F.coalesce(col(turns, c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    placed = own.filter("conv_id IS NOT NULL").select("conv_id", place.alias("place"), symbol(F.col("role"), F.col("text")).alias("s"))
    digits = 2 * SYMBOL
    whole = saved(placed.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "s"))), lambda x: x["s"]), "").alias("own")), "turns")
    donors = whole.filter(F.col("conv_id") % donors_every == 0).select(F.col("conv_id").alias("donor"), F.substring("own", 1, digits * (most_given - 1)).alias("given"))
    given = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most_given)).cast("int")
    joined = whole.withColumn("h", given).withColumn("donor", F.col("conv_id") - F.col("conv_id") % donors_every).join(donors, "donor", "left")
    seq = F.concat(F.expr(f"substring(coalesce(given, ''), 1, {digits} * h)"), F.expr(f"substring(own, {digits} * h + 1)"))
    return joined.select("conv_id", F.unhex(seq).alias("seq"))


def _batches(rows, schema: pa.Schema):
    """Record batches of bounded size from tuples."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def distinct(convs: DataFrame) -> DataFrame:
    """``seq, n, first, ends``: each sequence once, with the digest of its ids in order.

    The ids of one sequence may be spread over many tasks, which join them to blocks; the blocks pass one digest in order.
    """
    blocks_of = pa.schema([("seq", pa.binary()), ("n", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])
    result_of = pa.schema([("seq", pa.binary()), ("n", pa.int64()), ("first", pa.int64()), ("ends", pa.string())])

    def blocks(batches):
        def rows():
            now, ids = None, []
            for b in batches:
                for seq, i in zip(b["seq"].to_pylist(), b["conv_id"].to_pylist()):
                    if ids and (seq != now or len(ids) >= BLOCK_IDS):
                        yield now, len(ids), ids[0], ",".join(map(str, ids)).encode()
                        ids = []
                    now = seq
                    ids.append(i)
            if ids:
                yield now, len(ids), ids[0], ",".join(map(str, ids)).encode()

        yield from _batches(rows(), blocks_of)

    def digests(batches):
        def rows():
            now, n, first, digest = None, 0, None, None
            for b in batches:
                for seq, count, start, ids in zip(*(b[c].to_pylist() for c in ("seq", "n", "first", "ids"))):
                    if digest is not None and seq == now:
                        digest.update(b"," + ids)
                        n += count
                        continue
                    if digest is not None:
                        yield now, n, first, digest.hexdigest()
                    now, n, first, digest = seq, count, start, hashlib.sha256(ids)
            if digest is not None:
                yield now, n, first, digest.hexdigest()

        yield from _batches(rows(), result_of)

    cut = convs.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(blocks, "seq binary, n long, first long, ids binary")
    return cut.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(digests, "seq binary, n long, first long, ends string")


def _prefix(depth: Column) -> Column:
    """Hash of the first ``depth`` symbols of ``seq``."""
    return F.sha2(F.substr("seq", F.lit(1), SYMBOL * depth), 256)


def burst(seqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, heads)``: the rows with the depth ``b`` of the head above their container (or where they end), and
    the heads below the root (``prefix, level, n_convs, first``)."""
    live, done, heads, depth, levels = seqs, [], [], 0, FIRST_LEVELS
    while True:
        steps = F.explode(F.sequence(F.lit(depth + 1), F.least("len", F.lit(depth + levels)))).alias("level")
        below = live.filter(F.col("len") > depth).select("first", "n", "len", "seq", steps).select(
            "first", "n", "level", (F.col("len") - F.col("level")).alias("turns"), _prefix(F.col("level")).alias("prefix"))
        sizes = below.groupBy("prefix", "level").agg(F.count("*").alias("rows"), F.sum("turns").alias("turns"), F.sum("n").alias("n_convs"), F.min("first").alias("first"))
        over = saved(sizes.filter((F.col("rows") > CONTAINER_ROWS) | ((F.col("rows") > 1) & (F.col("turns") > CONTAINER_TURNS))), "heads")
        heads.append(over.select("prefix", "level", "n_convs", "first"))
        if over.isEmpty():
            done.append(live.withColumn("b", F.lit(depth)))
            break
        deepest = below.select("first", "prefix", "level").join(small_side(over.select("prefix")), "prefix").groupBy("first").agg(F.max("level").alias("b"))
        moved = saved(live.join(deepest, "first", "left").withColumn("b", F.coalesce("b", F.lit(depth))), "burst")
        depth += levels
        levels *= 2
        on = (F.col("b") == depth) & (F.col("len") > depth)
        done.append(moved.filter(~on))
        live = moved.filter(on).drop("b")
    rows, all_heads = done[0], heads[0]
    for d in done[1:]:
        rows = rows.unionByName(d)
    for h in heads[1:]:
        all_heads = all_heads.unionByName(h)
    return rows, all_heads


def _shared(a: bytes, b: bytes) -> int:
    """Symbols that both begin with."""
    n = min(len(a), len(b)) // SYMBOL * SYMBOL
    if a[:n] == b[:n]:
        return n // SYMBOL
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // SYMBOL


def container_nodes(rows: list[tuple[bytes, int, int, str]], top: int, above: int) -> list[list]:
    """The nodes of one container, the top (at depth ``top``) first, as lists in the order of :data:`NODE`.

    ``rows`` are ``(seq, n, first, ends)`` by ``seq``; ``above`` is the smallest member of the node above the top.
    """
    nodes, parents, words, stack, before = [], [], [], [], b""

    def close(depth: int) -> None:
        """Close the open nodes from ``depth`` down."""
        while len(stack) > depth - top:
            i = stack.pop()
            node, up = nodes[i], parents[i]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * words[i]
            if up >= 0:
                over = nodes[up]
                over[0] = min(over[0], node[0])
                for c in (3, 5, 6):
                    over[c] += node[c]

    for seq, n, first, ends in rows:
        depth = max(top, _shared(before, seq) + 1) if stack else top
        close(depth)
        for d in range(depth, len(seq) // SYMBOL + 1):
            parents.append(stack[-1] if stack else -1)
            if stack:
                nodes[stack[-1]][4] += 1
            stack.append(len(nodes))
            words.append(int.from_bytes(seq[d * SYMBOL - SYMBOL + HASH_BYTES:d * SYMBOL], "big"))
            nodes.append([first, d, above, 0, 0, 0, 0, NO_IDS])
        end = nodes[stack[-1]]
        end[0], end[3], end[7] = min(end[0], first), end[3] + n, ends
        before = seq
    close(top)
    for node, up in zip(nodes, parents):
        if up >= 0:
            node[2] = nodes[up][0]
    return nodes


def swept(rows: DataFrame) -> DataFrame:
    """:data:`NODE` and ``head`` (of the tops of containers only) from ``seq, n, first, ends, b, head, above``."""
    fields = [(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in NODE.split(", ")]
    schema = pa.schema([*fields, ("head", pa.string())])

    def sweep(batches):
        def made():
            now, held = None, []
            for b in batches:
                for top, seq, n, first, ends, depth, head, above in zip(*(b[c].to_pylist() for c in ("top", "seq", "n", "first", "ends", "b", "head", "above"))):
                    if now is not None and top != now[0]:
                        yield from nodes(now, held)
                        held = []
                    now = (top, depth, head, above)
                    held.append((seq, n, first, ends))
            if held:
                yield from nodes(now, held)

        def nodes(now, held):
            _, depth, head, above = now
            for i, node in enumerate(container_nodes(held, depth + 1, above)):
                yield (*node, None if i else head)

        yield from _batches(made(), schema)

    dealt = rows.withColumn("top", _prefix(F.col("b") + 1)).repartition("top").sortWithinPartitions("top", "seq")
    return dealt.select("top", "seq", "n", "first", "ends", "b", "head", "above").mapInArrow(sweep, f"{NODE}, head string")


def trie(convs: DataFrame) -> DataFrame:
    """:data:`NODE` for every distinct prefix of the sequences ``conv_id, seq``, the empty one included."""
    spark = convs.sparkSession
    seqs = saved(distinct(saved(convs, "rebuilt")).withColumn("len", F.expr(f"octet_length(seq) div {SYMBOL}").cast("int")), "sequences")
    total = seqs.agg(F.sum("n").alias("n"), F.min("first").alias("first")).first()
    if total.n is None:
        return spark.createDataFrame([], NODE)
    rows, heads = burst(seqs)
    root = F.sha2(F.lit(b""), 256)
    top_head = spark.range(1).select(root.alias("prefix"), F.lit(0).alias("level"), F.lit(total.n).cast("long").alias("n_convs"), F.lit(total.first).cast("long").alias("first"))
    heads = heads.unionByName(top_head)
    rows = saved(rows.withColumn("head", _prefix(F.col("b"))), "containers")
    named = small_side(heads.select(F.col("prefix").alias("head"), F.col("first").alias("above")))
    nodes = saved(swept(rows.filter("len > b").join(named, "head")), "nodes")

    # Heads: what lies right below them, what ends there, then the sums of all heads below.
    tops = nodes.filter("head IS NOT NULL").groupBy("head").agg(F.count("*").alias("tops"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("tokens"))
    ended = rows.filter("len = b").select("head", F.col("ends").alias("ends_sha256"))
    words = F.conv(F.hex(F.substr("seq", SYMBOL * F.col("level") - SYMBOL + HASH_BYTES + 1, F.lit(SYMBOL - HASH_BYTES))), 16, 10).cast("long")
    path = F.transform(F.sequence(F.lit(0), F.col("level")), lambda i: _prefix(i))
    # The smallest member of a head has its prefix.
    known = seqs.select("first", "seq").join(small_side(heads), "first").select(
        F.col("prefix").alias("head"), F.col("level").cast("long").alias("depth"), "n_convs", F.col("first").alias("conv_id"),
        F.when(F.col("level") > 0, words).otherwise(0).alias("words"), F.when(F.col("level") > 0, _prefix(F.col("level") - 1)).alias("up"), path.alias("path"))
    known = saved(known, "known")
    inner = known.filter("up IS NOT NULL").groupBy(F.col("up").alias("head")).agg(F.count("*").alias("inner"))
    zero = {"tops": 0, "leaves": 0, "tokens": 0, "inner": 0, "ends_sha256": NO_IDS}
    local = known.join(tops, "head", "left").join(inner, "head", "left").join(ended, "head", "left").fillna(zero)
    local = local.withColumn("n_children", F.col("tops") + F.col("inner"))
    local = local.withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves"))).withColumn("tokens", F.col("tokens") + (F.col("n_convs") - 1) * F.col("words"))
    sums = local.select(F.explode("path").alias("head"), "leaves", "tokens").groupBy("head").agg(F.sum("leaves").alias("n_leaves"), F.sum("tokens").alias("saved_tokens"))
    above = known.select(F.col("head").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    own = local.join(sums, "head").join(above, "up", "left")
    names = [f.split()[0] for f in NODE.split(", ")]
    return nodes.select(*names).unionAll(own.select(*names))
