import random

import pytest
from pyspark.sql import functions as F

from voxloom.operators import dedup, identity, joins, quality
from voxloom.operators.blocks import range_blocks, time_blocks
from voxloom.operators.runs import with_run_length
from voxloom.session import small_side


@pytest.mark.parametrize("block, most", [(1, 1000), (7, 1000), (1000, 1000), (7, 3)])
def test_row_index_with_a_hot_key(spark, block, most):
    rng = random.Random(block)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("abc"), f"f{rng.randrange(3)}", p) for p in rng.sample(range(5000), 400)]
    got = identity.with_row_index(spark.createDataFrame(rows, "k string, f string, p long"), ["k"], "p", ["f"], block_rows=block, max_blocks=most).collect()
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        want = {(f, p): i for i, (f, p) in enumerate(sorted((f, p) for k, f, p in rows if k == key))}
        assert {(r.f, r.p): r.row_index for r in got if r.k == key} == want


def test_file_index(spark, tmp_path):
    for split, n in (("test-0", 5), ("train-0", 40), ("train-1", 3), ("train-2", 17)):
        spark.range(n).select(F.lit(split).alias("name"), "id").coalesce(1).write.parquet(str(tmp_path / split))
    raw = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path)).select(
        "name", "id", F.substring_index("name", "-", 1).alias("split"),
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_pos"))
    got = identity.with_file_index(raw, ["split"]).collect()
    train = sorted((r.row_index, r.name, r.id) for r in got if r.split == "train")
    assert [t[0] for t in train] == list(range(60))
    assert [(t[1], t[2]) for t in train] == [("train-0", i) for i in range(40)] + [("train-1", i) for i in range(3)] + [("train-2", i) for i in range(17)]
    assert sorted(r.row_index for r in got if r.split == "test") == list(range(5))
    assert sorted(r.row_index for r in identity.with_file_index(raw, []).collect()) == list(range(65))


def test_ids_and_next_index(spark):
    ids = spark.createDataFrame([("s_train_00000007",), ("s_train_00000041",), ("s_test_00000099",), ("other",), ("s_train_x",)], "utt_id string")
    assert identity.next_index(ids, F.lit("s_train_")).head()[0] == 42
    assert identity.next_index(ids, F.lit("nothing_")).head()[0] == 0
    assert spark.range(1).select(identity.utt_id(F.lit("s"), F.lit("train"), F.lit(12))).head()[0] == "s_train_00000012"


def test_keep_first_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(("hot" if rng.random() < 0.4 else str(rng.randrange(50))), i, i * i) for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    got = {r.k: (r.pos, r.v) for r in dedup.keep_first(df, ["k"], ["pos"]).collect()}
    want = {}
    for k, p, v in sorted(rows, key=lambda r: r[1]):
        want.setdefault(k, (p, v))
    assert got == want
    counts = dedup.duplicate_counts(df, ["k"]).head()
    assert (counts.rows_before, counts.rows_after, counts.removed) == (500, len(want), 500 - len(want))


@pytest.mark.parametrize("width", [0, 1, 3, 10, 1000])
@pytest.mark.parametrize("share", [0.3, 0.9, 1.0])
def test_runs_across_blocks(spark, width, share):
    rng = random.Random(width * 100 + int(share * 10))
    rows = [(k, t, rng.random() < share) for k in ("a", "hot") for t in sorted(rng.sample(range(300), 20 if k == "a" else 200))]
    df = spark.createDataFrame(rows, "k string, t long, f boolean")
    cut = df.withColumn("_block", F.floor(F.col("t") / width)) if width else range_blocks(df, ["k", "t"])
    got = {(r.k, r.t): r.run_length for r in with_run_length(cut, ["k"], ["t"], F.col("f")).collect()}
    run, last = 0, None
    for k, t, f in sorted(rows):
        run = (run if k == last else 0) + 1 if f else 0
        last = k
        assert got[(k, t)] == run
    assert len(got) == len(rows)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("rows_per_block", [1, 5, 1000])
def test_time_blocks_follow_the_order(spark, kind, rows_per_block):
    # A burst: most rows fall into one second.
    rng = random.Random(rows_per_block)
    rows = [("hot", i, 1_700_000_000 + (500_000 if i % 10 else rng.randrange(1_000_000))) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, i long, s long").withColumn("ts", F.timestamp_seconds("s").cast(kind))
    cut = time_blocks(df, ["k"], "ts", ["ts", "i"], rows_per_block).collect()
    blocks = [r._block for r in sorted(cut, key=lambda r: (r.s, r.i))]
    assert len(blocks) == 120 and blocks == sorted(blocks)


def test_joins(spark):
    meta = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, t string")
    audio = spark.createDataFrame([(1, 10), (3, 30)], "id long, n long")
    assert sorted(r.id for r in joins.pair_audio(meta, audio).collect()) == [1, 3]
    assert [r.id for r in joins.missing_audio(meta, audio).collect()] == [2]
    assert sorted(r.id for r in joins.remaining(meta, audio, ["id"]).collect()) == [2]
    assert [r.id for r in joins.without_existing(meta, audio, ["id"]).collect()] == [2]


def test_small_side_checks_the_size(spark):
    rows = spark.range(20)
    big = spark.range(1000)
    hinted = big.join(small_side(rows, 100), "id")._jdf.queryExecution().toString()
    unhinted = big.join(small_side(rows, 5), "id")._jdf.queryExecution().toString()
    assert "strategy=broadcast" in hinted and "strategy=broadcast" not in unhinted
    assert big.join(small_side(rows, 5), "id").count() == 20


def test_checks_find_what_is_wrong(spark):
    kind = "source string, split string, utt_id string, audio struct<array:array<float>,sampling_rate:int>, text string, duration float, n_samples int, speaker_id string"
    good = ("s", "train", "1", ([0.0, 1.0], 16000), "x", 1.0, 2, "a")
    rows = [good, ("s", "train", "2", ([0.0], 8000), "", 0.0, 2, None), ("s", "test", "1", None, None, None, None, "")]
    found = {(r.split, r.check): r.violations for r in quality.verify_rows(spark.createDataFrame(rows, kind), quality.row_checks()).collect()}
    assert found == {(s, c): (1 if s == "test" or True else 0) for s in ("train", "test") for c in quality.row_checks()}
    df = spark.createDataFrame(rows, kind)
    unique = quality.uniqueness(df).head()
    assert (unique.total, unique.distinct_ids, unique.repeated_ids, unique.is_unique) == (3, 2, 1, False)
    assert quality.has_repeats(df) and not quality.has_repeats(df.filter("split = 'train'"))
    assert dict(quality.verify_schema(df))["no_split_column"] is False
    assert all(ok for _, ok in quality.verify_schema(df.drop("split")))
    paths = spark.createDataFrame([(("x.wav",),), ((None,),), ((" ",),)], "audio struct<path:string>")
    assert quality.external_paths(paths).count() == 1


def test_null_keys_and_positions_keep_their_rows(spark):
    from voxloom.operators import runs

    rows = spark.createDataFrame([("a", 0), (None, 1), (None, 5), ("a", None)], "split string, pos long")
    got = {(r.split, r.pos): r.row_index for r in identity.with_row_index(rows, ["split"], "pos").collect()}
    assert got == {("a", None): 0, ("a", 0): 1, (None, 1): 0, (None, 5): 1}
    timed = spark.createDataFrame([("a", 1, True), ("a", 2, True), (None, 1, True), ("a", None, True)], "k string, t long, f boolean")
    blocked = timed.withColumn("_block", timed.t)
    got = {(r.k, r.t): r.run_length for r in runs.with_run_length(blocked, ["k"], ["t"], timed.f).collect()}
    assert got == {("a", None): 1, ("a", 1): 2, ("a", 2): 3, (None, 1): 1}


def test_registry_loses_no_row(spark):
    from voxloom.operators.joins import apply_registry

    rows = spark.createDataFrame([("x",), (None,)], "source string")
    known = spark.createDataFrame([("x", 1, 2.5), (None, 2, 9.0)], "source string, rate int, max_s double")
    assert {(r.source, r.rate) for r in apply_registry(rows, known).collect()} == {("x", 1), (None, 2)}


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("missing", ["y", None])
def test_unknown_source_fails_whatever_is_read(spark, monkeypatch, missing, broadcast):
    from voxloom.operators import joins

    if not broadcast:
        monkeypatch.setattr(joins, "small_side", lambda df, *_: df)
    known = spark.createDataFrame([("x", 1, 2.5, "a")], "source string, rate int, max_s double, registered string")
    rows = joins.apply_registry(spark.createDataFrame([("x", 1), (missing, 2)], "source string, i int"), known)
    uses = [lambda d: d.select("max_s"), lambda d: d.select("rate"), lambda d: d.select("i"), lambda d: d.select("source").distinct(),
            lambda d: d.groupBy().count(), lambda d: d.filter("max_s < 5").select("i"), lambda d: d.filter("registered IS NOT NULL").select("rate"),
            lambda d: d.groupBy("registered").count()]
    for use in uses:
        with pytest.raises(Exception, match="no settings for"):
            use(rows).collect()
    good = joins.apply_registry(spark.createDataFrame([("x", 1)], "source string, i int"), known)
    assert [use(good).count() for use in uses] == [1] * len(uses)


def test_registry_of_the_specs(spark):
    """A fixed registry: its own sources pass, any other fails."""
    from voxloom.operators.joins import apply_registry
    from voxloom.sources.scan import registry_frame

    registry = registry_frame(spark)
    names = registry.select("source")
    assert apply_registry(names, registry).select("max_s").count() == registry.count()
    with pytest.raises(Exception, match='no settings for {"source":"nobody"}'):
        apply_registry(names.unionAll(spark.createDataFrame([("nobody",)], "source string")), registry).select("max_s").collect()
