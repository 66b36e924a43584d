"""Delimited metadata whose records may be glued together on one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_START = r"[A-Za-z0-9_-]{6,}\|"  # fixed value: an id of six or more characters and its delimiter

_MARK = "\u0000"


def records_of(line: Column) -> Column:
    """Array of the ``id|text`` records of a line.

    A line with at most one id stays whole; otherwise it is cut before every id,
    and what precedes the first id is a record of its own.
    """
    marked = F.regexp_replace(line, f"({RECORD_START})", f"{_MARK}$1")
    pieces = F.filter(F.split(marked, _MARK), lambda p: p != "")
    starts = F.regexp_count(line, F.lit(RECORD_START))
    return F.when(starts <= 1, F.filter(F.array(line), lambda p: p != "")).otherwise(pieces)


def parse_glued_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(id, text)`` per record; everything behind the first delimiter is text."""
    clean = F.regexp_replace(column, "[\r\n]+$", "")
    record = F.explode(records_of(clean)).alias("_record")
    kept = [c for c in lines.columns if c != column]
    parts = F.split("_record", r"\|", 2)
    return lines.select(*kept, record).select(
        *kept, F.get(parts, F.lit(0)).alias("id"), F.get(parts, F.lit(1)).alias("text"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return parse_glued_records(spark.read.text(path))
