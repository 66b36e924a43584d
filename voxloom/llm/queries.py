"""The queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import ann, bpe, importance, licenses, neardup, packing, quality, rules, secrets, sharding, tokencount, topk, trie
from voxloom.llm.ann_sql import ANN_SQL
from voxloom.llm.common import prepared
from voxloom.llm.importance_sql import IMPORTANCE_SQL
from voxloom.llm.rules_sql import RULES_SQL
from voxloom.llm.topk_sql import TOP_K_SQL
from voxloom.llm.trie_sql import TRIE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("op6_quality_rules", RULES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-supervision quality rules over all documents."""
    return rules.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("posterior", 6).alias("posterior"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality scores of all documents, learnt outside the held-out fold."""
    return quality.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, similarity 0.85 or more."""
    return neardup.near_duplicates(documents(spark, sf_dir))


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def pieces(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 ids, filled with lexical neighbours."""
    return pieces(packing.pack(documents(spark, sf_dir)))


@query("op2_bpe_codec")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of all documents through the token automaton."""
    return bpe.encode_decode(documents(spark, sf_dir))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return tokencount.token_counts(documents(spark, sf_dir))


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    d = sharding.shard_by_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op1_ann", ANN_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth one, through balanced posting lists."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of all documents."""
    return licenses.scan(documents(spark, sf_dir))


@query("op11_top_k", TOP_K_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest integer inner products of every twentieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op12_importance_resampling", IMPORTANCE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their score against the benchmark texts, and the rank of the twentieth part drawn."""
    return importance.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    return trie.trie(trie.rebuilt(table(spark, sf_dir, "conversations")))
