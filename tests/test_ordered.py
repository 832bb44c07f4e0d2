import random

import pytest
from pyspark.sql import functions as F

from pagelathe.operators import ordered


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_positions_and_batches(spark, partitions):
    """Gaps in the ids, one key with most of the rows, more ranges than rows of a key."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 120, 3).select(F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("k"), F.col("id").alias("n")).repartition(5)
        got = {r.n: r.position for r in ordered.with_positions(df, ["k"], "n").collect()}
        rows = ordered.batch_rows(df, 8, "n").orderBy("batch_no").collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    for key in "ab":
        ids = [n for n in range(0, 120, 3) if (n % 4 == 0) == (key == "b")]
        assert [got[n] for n in ids] == list(range(1, len(ids) + 1))
    assert [[r.n for r in b.rows] for b in rows] == [list(range(i * 24, min(i * 24 + 24, 120), 3)) for i in range(5)]


def test_outliers_and_text_keep_ranges_even(spark):
    """One far value among dense ones; segments by value would put all others into one."""
    ids = spark.range(4_000).select(F.when(F.col("id") == 7, F.lit(2**62)).otherwise(F.col("id")).alias("n"))
    got = ordered.with_positions(ids.repartition(6), [], "n")
    assert [r.n for r in got.orderBy("position").collect()] == sorted(r.n for r in ids.collect())
    words = spark.range(50).select(F.md5(F.col("id").cast("string").cast("binary")).alias("w"))
    got = ordered.with_positions(words, [], "w").orderBy("position").collect()
    assert [r.w for r in got] == sorted(r.w for r in got) and [r.position for r in got] == list(range(1, 51))


def test_batches_last_short_and_empty(spark):
    sizes = [r.n_rows for r in ordered.batch_rows(spark.range(10), 4, "id").orderBy("batch_no").collect()]
    assert sizes == [4, 4, 2]
    assert ordered.batch_rows(spark.range(0), 4, "id").count() == 0


def test_batches_over_hashed_ids(spark):
    ids = spark.range(200).select(F.xxhash64("id").alias("h"))
    rows = ordered.batch_rows(ids, 7, "h").orderBy("batch_no").collect()
    flat = [r.h for b in rows for r in b.rows]
    assert flat == sorted(r.h for r in ids.collect()) and min(flat) < -(2**62) and max(flat) > 2**62


@pytest.mark.parametrize("parts", [1, 7])
def test_top_n_with_a_hot_group(spark, parts):
    df = spark.range(300).select(F.when(F.col("id") < 250, "hot").otherwise("cold").alias("k"), "id").repartition(parts)
    got = sorted(tuple(r) for r in ordered.top_n_per_group(df, ["k"], [F.col("id").desc()], 3, rank="r").collect())
    assert got == [("cold", 297, 3), ("cold", 298, 2), ("cold", 299, 1), ("hot", 247, 3), ("hot", 248, 2), ("hot", 249, 1)]


def test_blocks_see_their_halo(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "p")
    rows = [(r._block, r._halo, r.p) for r in ordered.with_blocks(df, "p", 2, block=4).collect()]
    assert sorted(p for _, halo, p in rows if not halo) == list(range(1, 11))
    assert sorted((b, p) for b, halo, p in rows if halo) == [(1, 3), (1, 4), (2, 7), (2, 8)]


def test_running_sums_and_maxima(spark):
    """A hot key, a null key and null values, against a loop."""
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), i, rng.choice([None, i % 7, -i])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    for how, fold in (("sum", sum), ("max", max)):
        got = {r.i: r.before for r in ordered.with_running(df, ["k"], "i", F.col("v"), "before", how).collect()}
        for key, i, _ in rows:
            earlier = [v for k, j, v in rows if k == key and j < i and v is not None]
            assert got[i] == (fold(earlier) if earlier else None)
