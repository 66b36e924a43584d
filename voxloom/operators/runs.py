"""Runs of flagged rows in ordered groups, without a whole group in one task.

A run that ends at a row is its run inside a block, plus the run carried in
from earlier blocks when every row of the block so far is flagged.  Only one
summary row per block takes part in the step that crosses blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .blocks import BLOCK
from .joins import null_safe_join


def with_run_length(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, out: str = "run_length") -> DataFrame:
    """Length of the flagged run ending at each row, 0 on unflagged rows.

    ``df`` has a column ``_block`` (see :mod:`voxloom.operators.blocks`) that
    grows with ``order`` and bounds how many rows one task sorts; it is dropped.
    Rows with null keys are a group of their own, rows with a null order come first.
    """
    rows = df.withColumn("_flag", flag.cast("int"))
    in_block = W.partitionBy(*keys, BLOCK).orderBy(*order)
    upto = in_block.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_at", F.row_number().over(in_block))
    # Position of the last unflagged row so far; 0 while there is none in this block.
    rows = rows.withColumn("_gap", F.coalesce(F.max(F.when(F.col("_flag") == 0, F.col("_at"))).over(upto), F.lit(0)))

    blocks = rows.groupBy(*keys, BLOCK).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_gap").alias("_last_gap"))
    full = F.col("_last_gap") == 0
    running = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    # Carry into a block: the run at the end of the last block with a gap, plus all full blocks since.
    blocks = blocks.withColumn("_full_rows", F.sum(F.when(full, F.col("_n")).otherwise(0)).over(running))
    blocks = blocks.withColumn("_all", F.coalesce(F.max("_full_rows").over(before), F.lit(0))).withColumn(
        "_since",
        F.max(F.when(~full, F.struct(BLOCK, (F.col("_n") - F.col("_last_gap") - F.col("_full_rows")).alias("d"))))
        .over(before))
    summary = blocks.select(*keys, BLOCK, (F.col("_all") + F.coalesce("_since.d", F.lit(0))).alias("_carry"))
    joined = null_safe_join(rows, summary, [*keys, BLOCK])
    length = F.when(F.col("_flag") == 0, F.lit(0)).otherwise(
        F.col("_at") - F.col("_gap") + F.when(F.col("_gap") == 0, F.col("_carry")).otherwise(F.lit(0)))
    return joined.withColumn(out, length.cast("long")).drop(
        "_flag", BLOCK, "_at", "_gap", "_carry")
