import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.functions import text as txt
from voxloom.operators import identity
from voxloom.sources.metadata import parse_glued_records


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
    return [r[1] for r in sorted(rows.select("i", fn(F.col("v")).alias("o")).collect())]


CASES = [
    ("كيةىؤأإء", "کیهیواا"), ("a \t  b", "a b"), ("a\nb", "a\nb"), ("می‌روم", "می‌روم"),
    (None, ""), ("   ", ""), ("ء", ""), (" x ", "x"), ("ﬁ", "fi"), ("①", "1"), ("\x1cx\x1f", "x"),
]


def test_normalize_cases(spark):
    assert apply(spark, [c[0] for c in CASES], txt.normalize_text) == [c[1] for c in CASES]


SAMPLES = ["", "a", " a  b ", "a\nb\tc", "سلام‌دنیا خوب", "x y　z", "\x1ca\x1db", "é é ﷺ ½ Å", "a\u0085b", "𝒳 𝟙 2"]


def test_nfkc_matches_the_standard(spark):
    assert apply(spark, SAMPLES, txt.nfkc) == [unicodedata.normalize("NFKC", s) for s in SAMPLES]
    assert apply(spark, [None], txt.nfkc) == [None]


def test_counts(spark):
    assert apply(spark, SAMPLES, txt.num_words) == [len(s.split()) for s in SAMPLES]
    assert apply(spark, SAMPLES, txt.num_chars) == [len(s) for s in SAMPLES]


ALPHABET = st.text(st.sampled_from("ab كيةىؤأإء\t\n\r\x0b\x1c\x85\xa0   ‌　ﬁé́۱٣"), max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ALPHABET, min_size=40, max_size=60))
def test_normalize_property(spark, texts):
    import re

    def expected(t):
        t = unicodedata.normalize("NFKC", t)
        t = t.translate({ord(a): (txt.HOMOGLYPHS_TO + "\0")[i].strip("\0") for i, a in enumerate(txt.HOMOGLYPHS_FROM)})
        return re.sub("[ \t]+", " ", t).strip()

    assert apply(spark, texts, txt.normalize_text) == [expected(t) for t in texts]
    assert apply(spark, texts, txt.num_words) == [len(t.split()) for t in texts]


def test_extract_text(spark):
    rows = spark.createDataFrame([(None, " ", "x"), ("ء", "x", "y"), (None, None, None), (" كa ", None, None)], "a string, b string, c string")
    got = [r[0] for r in rows.select(txt.extract_text([F.col("a"), F.col("b"), F.col("c")])).collect()]
    assert got == ["x", "", "", "کa"]


@pytest.mark.parametrize("num, den, value", [(4801, 16000, 0.3001), (4804, 16000, 0.3003), (1, 3, 0.3333), (2, 3, 0.6667), (0, 5, 0.0), (640000, 16000, 40.0)])
def test_rounded_ratio(spark, num, den, value):
    assert spark.range(1).select(txt.rounded_ratio(F.lit(num), F.lit(den))).head()[0] == value


def test_hours_label(spark):
    got = apply(spark, [10_822_320.0, 180.0, 3_600.0 * 1_392 + 45 * 60 + 59], txt.hours_label, "double")
    assert got == ["3,006h 12m", "0h 03m", "1,392h 45m"]


def test_speakers(spark):
    speaker = lambda c: identity.speaker_from_column(c, F.lit("s"))
    assert apply(spark, [None, " a ", "", "b"], speaker) == ["ds:s_unknown", "ds:a", "ds:s_unknown", "ds:b"]
    number = lambda c: identity.speaker_from_column(c, F.lit("s"), "integer")
    assert apply(spark, [None, 0, 7], number, "int") == ["ds:s_unknown", "ds:s_unknown", "ds:7"]


def test_glued_records(spark):
    lines = ["rec0001|one", "rec0002|two rec0003|three", "lead rec0004|four rec0005|", "", "short|id", "rec0006|a|b", "rec0007|x\r"]
    got = parse_glued_records(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert sorted((r.id, r.text) for r in got) == sorted([
        ("rec0001", "one"), ("rec0002", "two "), ("rec0003", "three"), ("lead ", None), ("rec0004", "four "), ("rec0005", ""),
        ("short", "id"), ("rec0006", "a|b"), ("rec0007", "x")])
