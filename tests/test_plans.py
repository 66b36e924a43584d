"""Plans are what the design says they are."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from voxloom.operators import gates, identity
from voxloom.plans import report
from voxloom.sinks.files import write_shards
from voxloom.sources.scan import read_corpus
from workloads import tables

D = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_do_not_carry_text_or_audio_through_a_shuffle(spark):
    text = plan(report.corpus_rollup(tables.kept(spark, D)))
    assert text.count("ArrowEvalPython") == 1
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            assert "embedding" not in line and "text" not in line
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filter_on_metrics_runs_the_stage_once(spark):
    rows = gates.quality_subset(tables.annotated(spark, D))
    assert plan(rows).count("ArrowEvalPython") == 1


def test_quality_filter_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "c")
    write_shards(tables.kept(spark, D).select("utt_id", "source", "split", "snr_db", "duration"), path, 4096, ("source", "split"))
    text = plan(gates.quality_subset(read_corpus(spark, path, "src1", "en")).select("utt_id"))
    assert "GreaterThan(snr_db,20.0)" in text and "GreaterThan(duration,1.0)" in text
    assert re.search(r"PartitionFilters: \[[^\]]*src1", text) and re.search(r"PartitionFilters: \[[^\]]*en", text)


def test_file_index_counts_without_reading_columns(spark):
    raw = spark.read.parquet(f"{D}/documents.parquet").select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"))
    counted = raw.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    assert "ReadSchema: struct<>" in plan(counted)
    indexed = plan(identity.with_file_index(raw, []))
    assert "BroadcastHashJoin" in indexed and "SortMergeJoin" not in indexed


def test_pruned_scan(spark):
    text = plan(entry.queries()["scan_pruned"](spark, D))
    assert "ReadSchema: struct<lang:string,n_chars:bigint>" in text
