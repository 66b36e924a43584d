"""Quality rules as weak supervision, in native DataFrame functions only.

Rules vote on a document (1 good, -1 bad, 0 abstain).  Expectation-maximisation over the counts of
vote patterns estimates how often each rule is right and how many documents are good; the posterior
probability that a document is good, given its votes, decides.  There are at most ``3 ** len(RULES)``
patterns, so EM runs over one bounded row, as one native expression.

Nulls: a null text counts as empty; null ids are passed through.  An empty text fails the base rules.
An empty table gives an empty result.  Repeated rows give repeated results.  Extra columns are ignored,
except in :func:`keep_good`, which returns all columns of its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import WS, col, fresh, ids_and_texts, saved

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages served (fixed values).
STOPWORDS = ("the", "of", "and", "to", "in", "is", "on", "for", "it", "that", "with", "as", "by",
             "der", "die", "das", "und", "ist", "von", "zu", "mit", "den", "für", "auf",
             "le", "la", "les", "de", "des", "et", "un", "une", "en", "que", "pour", "est",
             "el", "los", "las", "y", "una", "es", "con", "por", "se", "del")
RULES = ("symbols", "repeats", "lines", "upper", "stopwords", "length", "ends")
ITERATIONS = 20
#: Where EM starts: the share of good documents, and how often either class gets the votes -1, 0, 1.
START_GOOD, START_VOTES = 0.7, ((0.1, 0.35, 0.55), (0.5, 0.35, 0.15))
#: Added to each count of votes, so no single rule decides alone.
SMOOTHING = 1.0
#: Posterior from which a document is kept: low, so that only clear cases go.
KEEP_FROM = 0.05


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _windows(words: Column) -> Column:
    """64-bit hashes of the 3-word windows, in order."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) >= 3, F.transform(
        starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more in the text.

    Only texts that repeat a window sort (hash, position) pairs.  A repeated window at position p covers
    p, p+1 and p+2, less what the next one covers itself.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hits = F.transform(
        F.array(pairs), lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])), lambda x: x["i"])))
    covered = F.transform(hits, lambda p: F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, v: a + v))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.get(covered, F.lit(0))).otherwise(F.lit(0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts that the rules read, one row per document."""
    d = ids_and_texts(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return _measured(d, "text", "doc_id")


def _measured(d: DataFrame, text_col: str, *keep: str) -> DataFrame:
    text = col(d, text_col)
    d = d.select(
        *[col(d, k) for k in keep],
        F.array_remove(F.split(text, f"[{WS}]+"), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "").alias("_lines"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).alias("n_symbols"),
    )
    w, lines = F.col("_words"), F.col("_lines")
    d = d.select(
        *[col(d, k) for k in keep], "n_symbols", F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
        F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.size(F.filter(w, lambda x: (x == F.upper(x)) & (x != F.lower(x)))).alias("n_upper"),
        F.size(F.filter(w, lambda x: x.isin(*STOPWORDS))).alias("n_stop"),
        F.size(F.filter(lines, lambda x: F.substring(F.rtrim(x), -1, 1).isin(".", "!", "?", ":"))).alias("n_ends"),
        _windows(w).alias("_hashes"),
    )
    return d.select(*[col(d, k) for k in keep], *[
        c.cast("long").alias(n) for n, c in (
            ("n_words", F.col("n_words")), ("word_chars", F.col("word_chars")), ("n_symbols", F.col("n_symbols")),
            ("n_dup_lines", F.col("n_dup_lines")), ("n_repeat_words", F.coalesce(_repeat_words(F.col("_hashes")), F.lit(0))),
            ("n_lines", F.col("n_lines")), ("n_upper", F.col("n_upper")), ("n_stop", F.col("n_stop")), ("n_ends", F.col("n_ends")))])


def votes() -> Column:
    """The votes of :data:`RULES`, in their order, in whole numbers only."""
    n, chars = F.col("n_words"), F.col("word_chars")

    def vote(bad: Column, good: Column) -> Column:
        return F.when(n == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    # Lack of a flaw is no evidence for quality, so most rules only vote bad or abstain.
    never = F.lit(False)
    return F.array(
        vote(10 * F.col("n_symbols") > 2 * n, 50 * F.col("n_symbols") <= n),
        vote(10 * F.col("n_repeat_words") > 3 * n, never),
        vote(10 * F.col("n_dup_lines") > 3 * F.col("n_lines"), never),
        vote(10 * F.col("n_upper") > 4 * n, never),
        vote(100 * F.col("n_stop") < 5 * n, 100 * F.col("n_stop") >= 15 * n),
        vote((chars > 12 * n) | (chars < 2 * n), never),
        vote(never, 2 * F.col("n_ends") >= F.col("n_lines")),
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def _posterior(vote: Column, p: Column) -> Column:
    """P(good | votes): ``p.good`` is the prior, ``p.g`` and ``p.b`` hold P(vote | class) at 3 * rule + vote + 1."""
    def side(rates: Column) -> Column:
        return F.aggregate(F.transform(vote, lambda v, j: F.get(rates, 3 * j + v + 1)), F.lit(1.0), lambda x, y: x * y)

    good, bad = p["good"] * side(p["g"]), (1 - p["good"]) * side(p["b"])
    return good / (good + bad)


def _step(patterns: Column, p: Column) -> Column:
    """One round of EM over the pattern counts."""
    def total(rows: Column, value) -> Column:
        return F.aggregate(F.transform(rows, value), F.lit(0.0), lambda a, v: a + v)

    def rates(rows: Column, weight: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(3 * len(RULES) - 1)), lambda k: (
            total(rows, lambda r: F.when(F.get(r["v"], F.floor(k / 3).cast("int")) == k % 3 - 1, r[weight]).otherwise(0.0)) + SMOOTHING)
            / (total(rows, lambda r: r[weight]) + 3 * SMOOTHING))

    def weighed(r: Column) -> Column:
        q = _posterior(r["v"], p)
        return F.struct(r["v"].alias("v"), (r["n"] * q).alias("g"), (r["n"] * (1 - q)).alias("b"))

    def update(rows: Column) -> Column:
        g, b = total(rows, lambda r: r["g"]), total(rows, lambda r: r["b"])
        return F.struct(rates(rows, "g").alias("g"), rates(rows, "b").alias("b"), ((g + 1) / (g + b + 2)).alias("good"))

    return F.get(F.transform(F.array(F.transform(patterns, weighed)), update), F.lit(0))


def pattern_posteriors(measured: DataFrame) -> DataFrame:
    """``votes, posterior`` for each vote pattern that occurs: at most ``3 ** len(RULES)`` rows."""
    counts = measured.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    one = counts.agg(F.sort_array(F.collect_list(F.struct(F.col("votes").alias("v"), F.col("n").alias("n")))).alias("patterns"))
    start = F.struct(*[F.array(*[F.lit(x) for x in START_VOTES[c]] * len(RULES)).alias("gb"[c]) for c in (0, 1)],
                     F.lit(START_GOOD).alias("good"))
    fitted = one.withColumn("p", F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start, lambda p, _: _step(F.col("patterns"), p)))
    return fitted.select(F.explode("patterns").alias("r"), "p").select(
        F.col("r.v").alias("votes"), _posterior(F.col("r.v"), F.col("p")).alias("posterior"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the counts, ``votes``, ``base_failed``, ``posterior`` and ``kept``."""
    m = saved(measures(docs, id_col, text_col).withColumn("votes", votes()), "rules")
    # Bounded by the number of patterns, whatever the number of documents.
    table = saved(pattern_posteriors(m), "rules-patterns")
    return (m.join(F.broadcast(table), "votes")
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM)))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns.

    The voted rows are written once, so texts are measured once.
    """
    key, original = fresh(docs, "_row_votes"), docs.columns
    voted = saved(_votes_of(docs, text_col, key), "rules")
    table = saved(pattern_posteriors(voted.select(F.col(key)["votes"].alias("votes"))), "rules-patterns")
    good = table.filter(F.col("posterior") >= KEEP_FROM).select(F.col("votes").alias(f"{key}v"))
    out = voted.filter(~F.col(key)["failed"]).join(F.broadcast(good), F.col(key)["votes"] == F.col(f"{key}v"), "left_semi")
    return out.select(*[col(docs, c) for c in original])


def _votes_of(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """``docs`` with a struct of votes and base verdict beside all columns."""
    packed, text, original = fresh(docs, "_row"), fresh(docs, "_row_text"), docs.columns
    d = docs.select(F.struct(*[col(docs, c) for c in original]).alias(packed), F.coalesce(col(docs, text_col), F.lit("")).alias(text))
    m = _measured(d, text, packed)
    return m.select(F.col(f"{packed}.*"), F.struct(votes().alias("votes"), base_failed().alias("failed")).alias(key))
