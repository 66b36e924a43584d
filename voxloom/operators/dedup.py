"""Keep the first row of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_side


def keep_first(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """Rows that come first within ``keys`` by ``position`` (unique over ``df``).

    The winners are found by a minimum, which is combined before the shuffle, so
    a key with a third of all rows costs no more than any other.  The rows
    themselves then meet the winners on their own unique position.
    """
    if len(position) == 1:
        # A plain minimum stays a hash aggregation; one of structs has to sort.
        winners = df.groupBy(*keys).agg(F.min(position[0]).alias(position[0])).select(*position)
    else:
        winners = df.groupBy(*keys).agg(F.min(F.struct(*position)).alias("_at")).select("_at.*")
    return df.join(winners, list(position), "left_semi")


def drop_repeats(df: DataFrame, keys: Sequence[str], position: Sequence[str], max_broadcast: int = 1_000_000) -> DataFrame:
    """The same rows as :func:`keep_first`, for rows with audio.

    Repeats are usually few, so their positions are found on narrow rows and, up
    to the checked bound, broadcast against the rows: audio is not shuffled.
    """
    narrow = df.select(*keys, *position)
    repeats = narrow.join(keep_first(narrow, keys, position), list(position), "left_anti").select(*position)
    return df.join(small_side(repeats, max_broadcast), list(position), "left_anti")


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after, rows removed."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))
