"""Exact order statistics without a sort: counts in ranges that narrow around the wanted ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1024  # ranges that one pass counts between two bounds; a task passes on one row per range at most


def values_at(values: DataFrame, ranks: Sequence[int], low: int, high: int, column: str = "t", cells: int = CELLS) -> dict[int, int]:
    """The values that would stand at the zero-based ``ranks`` of the sorted integers ``column``, all within ``low`` and ``high``.

    Each pass cuts every open range into ``cells`` parts, counts its rows and keeps the parts that hold a
    wanted rank, until a part holds one value.  Passes grow with the logarithm of the range, not with the
    rows; no row is moved, and a part need not fit anywhere.  Pass a narrow table: every pass scans it.
    """
    found: dict[int, int] = {}
    t = F.col(column)
    pending = {(low, high): [(r, r) for r in sorted(set(ranks))]}  # range -> (rank, its place within the range)
    while pending:
        place, widths = F.lit(None), {}
        for i, (a, b) in enumerate(pending):
            widths[i] = -(-(b - a + 1) // cells)
            cell = F.call_function("div", t - F.lit(a), F.lit(widths[i]).cast("long"))
            place = F.when((t >= a) & (t <= b), F.struct(F.lit(i).alias("i"), cell.alias("cell"))).otherwise(place)
        rows = values.select(place.alias("_at")).filter("_at IS NOT NULL").groupBy("_at.i", "_at.cell").agg(F.count(F.lit(1)).alias("n"))
        counts = sorted((r.i, r.cell, r.n) for r in rows.collect())  # at most ``cells`` rows a range
        narrower: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i, ((a, b), wanted) in enumerate(pending.items()):
            before, parts = 0, [(c, n) for j, c, n in counts if j == i]
            for c, n in parts:
                start = a + c * widths[i]
                for rank, at in wanted:
                    if before <= at < before + n:
                        if widths[i] == 1:
                            found[rank] = start
                        else:
                            narrower.setdefault((start, min(b, start + widths[i] - 1)), []).append((rank, at - before))
                before += n
        pending = narrower
    return found
