"""Transcript functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import text as txt
from voxloom.operators.gates import reason_class
from voxloom.session import spread

from . import query
from .tables import SQL_ANNOTATED, annotated, long, sql_normal, sql_words, table, texts

_ASCII = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _ASCII)  # full-width forms


@query("nfkc", "SELECT doc_id, md5(nfc_normalize(text)) AS digest FROM documents")
def nfkc(spark, d):
    """Texts with all letters and digits in full-width form come back as they were."""
    wide = F.translate("text", _ASCII, _WIDE)
    return texts(spark, d).select("doc_id", F.md5(txt.nfkc(wide)).alias("digest"))


@query("homoglyphs", "SELECT doc_id, md5(translate(text, 'etaoinsr', 'کیهیواا')) AS digest FROM documents")
def homoglyphs(spark, d):
    """Latin letters stand in for the eight letters that are unified or deleted."""
    arabic = F.translate("text", "etaoinsr", txt.HOMOGLYPHS_FROM)
    return texts(spark, d).select("doc_id", F.md5(txt.homoglyphs(arabic)).alias("digest"))


@query("collapse_ws", r"""
SELECT doc_id, md5(regexp_replace(regexp_replace(chr(10) || chr(160) || replace(text, ' ', ' ' || chr(9) || '  ') || chr(8195),
       '[ \t]+', ' ', 'g'), '^[\s\x{a0}\x{1c}-\x{1f}\x{2000}-\x{200a}]+|[\s\x{a0}\x{1c}-\x{1f}\x{2000}-\x{200a}]+$', '', 'g')) AS digest
FROM documents""")
def collapse_ws(spark, d):
    """Blanks and tabs between words, other white space at the ends."""
    loose = F.concat(F.lit("\n\u00a0"), F.replace(F.col("text"), F.lit(" "), F.lit(" \t  ")), F.lit("\u2003"))
    return texts(spark, d).select("doc_id", F.md5(txt.collapse_ws(loose)).alias("digest"))


@query("normalize_text", f"""
SELECT 'documents' AS origin, doc_id AS id, md5({sql_normal('text')}) AS digest FROM documents
UNION ALL SELECT 'pages', page_id, md5({sql_normal('html')}) FROM pages""")
def normalize_text(spark, d):
    docs = texts(spark, d).select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    pages = spread(table(spark, d, "pages")).select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("origin", "id", F.md5(txt.normalize_text(F.col("text"))).alias("digest"))


@query("text_stats", f"""
SELECT doc_id, length(t)::BIGINT AS num_chars, {sql_words('t')}::BIGINT AS num_words FROM (SELECT doc_id, {sql_normal('text')} AS t FROM documents)""")
def text_stats(spark, d):
    rows = texts(spark, d).select("doc_id", txt.normalize_text(F.col("text")).alias("t"))
    return rows.select("doc_id", long(txt.num_chars(F.col("t")), "num_chars"), long(txt.num_words(F.col("t")), "num_words"))


TITLE = "(?s)<title>(.*?)</title>"
HEADING = "(?s)<h1[^>]*>(.*?)</h1>"
PARAGRAPH = "(?s)<p[^>]*>(.*?)</p>"


@query("extract_text", f"""
WITH c AS (SELECT page_id, regexp_extract(html, '{TITLE}', 1) AS a, regexp_extract(html, '{HEADING}', 1) AS b,
                  regexp_extract(html, '{PARAGRAPH}', 1) AS p FROM pages),
n AS (SELECT page_id, {sql_normal('a')} AS a, {sql_normal('b')} AS b, {sql_normal('p')} AS p FROM c)
SELECT page_id, md5(CASE WHEN p <> '' THEN p WHEN b <> '' THEN b ELSE a END) AS digest FROM n""")
def extract_text(spark, d):
    """First candidate that is not blank: paragraph, heading, title of a page."""
    rows = table(spark, d, "pages").select(
        "page_id", *[F.regexp_extract("html", p, 1).alias(f"c{i}") for i, p in enumerate((PARAGRAPH, HEADING, TITLE))])
    return rows.select("page_id", F.md5(txt.extract_text([F.col("c0"), F.col("c1"), F.col("c2")])).alias("digest"))


@query("speaking_rate", f"WITH {SQL_ANNOTATED} SELECT doc_id, speaking_rate, chars_per_sec FROM annotated WHERE n IS NOT NULL")
def speaking_rate(spark, d):
    return annotated(spark, d).filter(F.col("n_samples").isNotNull()).select("doc_id", "speaking_rate", "chars_per_sec")


@query("reason_prefix", f"WITH {SQL_ANNOTATED} SELECT doc_id, trim(split_part(reason, ':', 1)) AS reason_class FROM annotated WHERE reason IS NOT NULL")
def reason_prefix(spark, d):
    """Text before the first colon."""
    return annotated(spark, d).filter(F.col("reason").isNotNull()).select("doc_id", reason_class(F.col("reason")).alias("reason_class"))
