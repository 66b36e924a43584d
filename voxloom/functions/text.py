"""Transcript functions as native Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that are unified; the last one has no partner and is deleted.
HOMOGLYPHS_FROM = "كيةىؤأإء"
HOMOGLYPHS_TO = "کیهیواا"

# The characters counted as whitespace at the ends of a text and between words.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_BETWEEN_WORDS = r"(?U)[\s\x1c-\x1f]+"  # the same characters as a pattern


def nfkc(text: Column) -> Column:
    """Unicode NFKC without leaving the JVM.

    Spark ships ICU for its collations; its composer is a static method, so the
    built-in reflection function reaches it and no Python worker is involved.
    Spark treats reflection as non-deterministic: it runs once per row and later
    filters stay above it, so filter on other columns before normalising.
    """
    composed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(text, F.lit("")), F.lit(True)
    )
    return F.when(text.isNotNull(), composed)


def homoglyphs(text: Column) -> Column:
    return F.translate(text, HOMOGLYPHS_FROM, HOMOGLYPHS_TO)


def collapse_ws(text: Column) -> Column:
    """Runs of blanks and tabs become one blank; line breaks inside stay."""
    return F.btrim(F.regexp_replace(text, "[ \t]+", " "), F.lit(WHITESPACE))


def normalize_text(text: Column) -> Column:
    """NFKC, homoglyphs, blanks; null becomes the empty string."""
    return F.coalesce(collapse_ws(homoglyphs(nfkc(text))), F.lit(""))


def falsy_to_empty(value: Column, data_type: str = "string") -> Column:
    """A column of any type as text, with null, zero and false as the empty string."""
    as_text = F.coalesce(value.cast("string"), F.lit(""))
    if data_type in ("string", "binary"):
        return as_text
    return F.when(value.cast("double") == 0, F.lit("")).otherwise(as_text)


def extract_text(candidates: Iterable[Column]) -> Column:
    """Normalised first candidate that is not blank before normalisation."""
    trimmed = [F.btrim(c, F.lit(WHITESPACE)) for c in candidates]
    chosen = F.coalesce(*[F.when(t != "", t) for t in trimmed], F.lit(""))
    return normalize_text(chosen)


def num_chars(text: Column) -> Column:
    return F.char_length(text)


def num_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, _BETWEEN_WORDS), ""))


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """``numerator / denominator`` of integers, rounded half up in integer arithmetic.

    No binary fraction is rounded on the way, so every engine gives the same digits.
    """
    scale = 10**digits
    num, den = numerator.cast("long"), F.nullif(denominator.cast("long"), F.lit(0))
    ticks = F.call_function("div", num * (2 * scale) + den, den * 2)
    return ticks / F.lit(float(scale))


def speaking_rate(words: Column, n_samples: Column, rate: Column) -> Column:
    """Words per second."""
    return rounded_ratio(words.cast("long") * rate.cast("long"), n_samples)


def chars_per_sec(chars: Column, n_samples: Column, rate: Column) -> Column:
    return rounded_ratio(chars.cast("long") * rate.cast("long"), n_samples)


def prefix_before(text: Column, delimiter: str) -> Column:
    return F.trim(F.substring_index(text, delimiter, 1))


def hours_label(seconds: Column) -> Column:
    """Seconds as ``1,392h 45m``."""
    whole_minutes = F.floor(seconds / 60)
    return F.format_string("%,dh %02dm", F.floor(whole_minutes / 60), F.pmod(whole_minutes, F.lit(60)))
