"""Helpers of the operators in this folder: scratch tables, batches, free column names."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.session import hadoop_path, scratch_path, ship_package

#: White space of the contracts: blank and the five ASCII controls, as a character class.
WS = r"\x20\x09-\x0D"

# Long texts must not meet in one Arrow batch of 10,000 rows.  The number of records stays the session's.
TEXT_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def prepared(spark: SparkSession) -> None:
    """Ship the package to the workers; Arrow batches sized for texts, unless the user set them.

    A query is lazy, so the settings have to outlive the call that builds it.
    """
    ship_package(spark)
    for key, value in TEXT_BATCHES.items():
        if spark.conf.get(key, None) in (None, "-1", "256MB", "268435456b", str(256 << 20)):
            spark.conf.set(key, value)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers each up to which Spark may choose the join by its own guess.
FEW_ROWS = 100_000


def by_shuffle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` for a join by a shuffle, unless it is known to have few ``rows``.

    Spark takes the bytes of a stored table for those in memory and an array for one element, so it would
    send a table that grows with the input, most of all an exploded one, through the driver.
    """
    return df if rows is not None and rows <= FEW_ROWS else df.hint("merge")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(df: DataFrame, name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def per_text(row: Callable[[], Callable[[str], tuple]], schema: str) -> Callable[[Column], Column]:
    """An Arrow UDF ``text -> struct``: ``row()`` is made once per task and called with each text (null: empty)."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = _parse_datatype_string(schema)
    fields = list(to_arrow_schema(kind))

    def run(batches):
        fn = row()
        for texts in batches:
            rows = [fn(t.as_py() or "") for t in texts]
            columns = zip(*rows) if rows else [[] for _ in fields]
            yield pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(columns, fields)], fields=fields)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(col(docs, id_col).cast("long").alias("doc_id"), col(docs, text_col).alias("text"))


def quiet_tokenizers() -> None:
    """One task uses one core, inside the tokenizers library too."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def text_spread(df: DataFrame) -> DataFrame:
    """Deal a scan of fewer parts than cores out to all cores; larger scans stay where they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """About ``n`` rows of any number, at most ``n``: those with the smallest hash of ``key``.

    Rows beyond half as many again are left out where they are read, so tasks return only their share.
    """
    rows = df.count()
    draw = F.pmod(F.xxhash64(key, F.lit("draw")), F.lit(1 << 40))
    few = df.filter(draw < int((1 << 40) * min(1.0, 1.5 * n / max(1, rows)))) if rows > 2 * n else df
    return few.orderBy(draw, key).limit(n)


class Kept(dict):
    """Results of ``make`` for the keys met lately: of two generations, the older one goes when the newer is full."""

    limit = 300_000

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        if len(key) < 100:
            self[key] = value
        return value
