import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.plans import report


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        source = "big" if rng.random() < 0.4 else rng.choice(["a", "srezas"])
        split = str(rng.choice(["youtube_x", "cv17_train"] if source == "srezas" else ["train", "test"]))
        rows.append((str(source), split, f"ds:{rng.integers(5)}" if source == "big" else f"gen:{source}",
                     float(np.round(rng.uniform(0.3, 40), 4)), float(np.round(rng.normal(40, 15), 2)),
                     float(np.round(rng.normal(-17, 3), 2)), float(np.round(rng.gamma(2, 1), 4))))
    return rows, spark.createDataFrame(rows, "source string, split string, speaker_id string, duration double, snr_db double, rms_db double, speaking_rate double")


def test_histograms_add_up(corpus):
    rows, df = corpus
    for hist, edges, at in ((report.snr_histogram(df), report.SNR_EDGES, 4), (report.duration_histogram(df), report.DURATION_EDGES, 3),
                            (report.rate_histogram(df), report.RATE_EDGES, 6)):
        counts = [r.n for r in hist.collect()]
        values = [r[at] for r in rows]
        want = np.histogram(values, [-np.inf, *edges, np.inf])[0]
        assert counts == [int(w) for w in want if w] and sum(counts) == len(rows)


def test_moments(corpus):
    rows, df = corpus
    rms = np.array([r[5] for r in rows])
    got = report.rms_stats(df).head()
    assert got.mean == pytest.approx(rms.mean(), abs=1e-3) and got.std == pytest.approx(rms.std(), abs=1e-3)
    assert (got.median, got.p5, got.p95) == tuple(pytest.approx(v, abs=1e-3) for v in np.percentile(rms, [50, 5, 95]))
    assert report.duration_stats(df).head().max == max(r[3] for r in rows)


def test_levels_add_up(corpus):
    rows, df = corpus
    rolled = report.corpus_rollup(df).collect()
    by_level = {lv: sum(r.utterances for r in rolled if r.level == lv) for lv in (0, 1, 3)}
    assert by_level == {0: 3000, 1: 3000, 3: 3000}
    top = next(r for r in rolled if r.level == 3)
    totals = report.corpus_totals(df).head()
    assert (top.speakers, top.hours) == (totals.speakers, totals.hours)
    assert totals.hours == pytest.approx(sum(r[3] for r in rows) / 3600, abs=1e-3)
    assert totals.splits == len({r[:2] for r in rows}) and totals.sources == 3


def test_reported_sources(corpus):
    _, df = corpus
    got = {r.report_source: r for r in report.source_summary(df).collect()}
    assert set(got) == {"a", "big", "srezas", "srezas_cv17"}
    assert got["big"].speakers == 5 and got["a"].speakers is None
    assert all(r.small_split == (r.utterances < 100) for r in report.split_summary(df).collect())


def test_speakers(corpus):
    rows, df = corpus
    got = report.speaker_count(df).head()
    assert (got.speakers, got.named_speakers, got.utterances) == (len({r[2] for r in rows}), 5, 3000)
    assert report.speaker_estimate(df).head()[0] == got.speakers


def test_empty_corpus(corpus):
    _, df = corpus
    none = df.filter(F.lit(False))
    assert report.corpus_totals(none).head().utterances in (None, 0)
    assert report.snr_histogram(none).collect() == []
    assert tuple(report.rms_stats(none).head()) == (0, None, None, None, None, None)


def test_percentiles_of_distinct_values_move_no_rows(spark):
    """All values differ; a pass shuffles counts of ranges, not values."""
    n = 200_000
    df = spark.range(n, numPartitions=8).select(((F.col("id") * 7919) % n * 3 - 50_000).alias("t"))
    want = np.sort(np.arange(n) * 3 - 50_000)
    ranks = [0, 1, n // 2, n // 20 - 1, n - 1]
    before = shuffled_records(spark)
    assert ranks_of(df, ranks, cells=16) == {r: int(want[r]) for r in ranks}
    added = shuffled_records(spark)[len(before):]
    # A stage reads one count for each range and task that wrote it, never the values.
    assert added and max(added) <= 8 * 16 * len(ranks)
    got = report.moments(df.select((F.col("t") / 10.0).alias("v")).select(report.ticks(F.col("v"), 1).alias("t")), 1, (0.05, 0.95), extremes=True).head()
    assert got.n == n and got.max == want[-1] / 10
    assert (got.median, got.p5, got.p95) == tuple(round(float(x), 4) for x in np.percentile(want / 10, [50, 5, 95]))


def shuffled_records(spark) -> list[int]:
    """Records that each stage so far read from shuffles, oldest first."""
    empty = spark._jvm.java.util.ArrayList()
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(empty, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), empty)
    return [n for _, n in sorted((stages.apply(i).stageId(), stages.apply(i).shuffleReadRecords()) for i in range(stages.size()))]


def ranks_of(df, ranks, **kw):
    from voxloom.operators.ranks import values_at

    return values_at(df, ranks, *df.agg(F.min("t"), F.max("t")).head(), **kw)


@pytest.mark.parametrize("values", [[5], [5] * 1000, [-3, 7], [0, 0, 0, 10**15], list(range(-500, 500))])
def test_ranks_with_ties_and_gaps(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t long")
    for cells in (2, 1024):
        assert ranks_of(df, range(0, len(values), max(1, len(values) // 7)), cells=cells) == {
            r: sorted(values)[r] for r in range(0, len(values), max(1, len(values) // 7))}
