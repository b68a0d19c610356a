"""Places of items in a key's order: the same rows by window and by ranges, hot keys, repeats, limits."""

import random

import pytest
from pyspark.sql import functions as F

from marquee import operators as ops
from marquee.operators.positions import range_numbered, repeat_rows


def brute(pairs, distinct=False):
    keys = {}
    for k, v in pairs:
        if k is not None:
            keys.setdefault(k, []).extend([] if v is None else [v])
    out = []
    for k, items in keys.items():
        items = sorted(set(items)) if distinct else sorted(items)
        out += [(k, i + 1, v, len(items)) for i, v in enumerate(items)] or [(k, None, None, 0)]
    return sorted(out, key=str)


@pytest.mark.parametrize("heavy", [0, 3, 40, 10**6])
@pytest.mark.parametrize("distinct", [False, True])
def test_every_size_gives_the_same_rows(spark, heavy, distinct):
    rng = random.Random(heavy)
    pairs = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.choice([None, "x"] + [f"v{i:03}" for i in range(60)])) for _ in range(900)]
    pairs += [("hot", "same")] * 300 + [("only nulls", None)] * 2
    df = spark.createDataFrame(pairs, "k string, v string").repartition(6)
    got = sorted((tuple(r) for r in ops.positions(df, "k", "v", distinct=distinct, heavy_size=heavy).collect()), key=str)
    assert got == brute(pairs, distinct)


def test_a_hot_key_is_spread_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 20_011).alias("v"))
        table = range_numbered(df.withColumn("_copy", F.lit(0)), "k", "v", "_copy")
        sizes = [r["count"] for r in table.groupBy(F.shiftright("_n", 33)).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 3 * 20_000 / 8
        rows = ops.positions(df, "k", "v", heavy_size=100)
        assert rows.where("n_items <> 20000").count() == 0
        assert rows.selectExpr("max(pos)", "count(distinct pos)", "min(pos)").first()[:] == (20_000, 20_000, 1)
        assert [r["v"] for r in rows.orderBy("pos").limit(3).collect()] == sorted(i * 7919 % 20_011 for i in range(20_000))[:3]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeats_are_counted_and_dealt_in_blocks(spark):
    df = spark.createDataFrame([("a", 25_000), ("b", 0), ("c", 1)], "k string, n long")
    got = repeat_rows(df, "n", "i").groupBy("k").agg(F.min("i"), F.max("i"), F.count_distinct("i")).collect()
    assert sorted(map(tuple, got)) == [("a", 0, 24_999, 25_000), ("c", 0, 0, 1)]


def test_a_text_beyond_its_limit_is_an_error(spark):
    rows = ops.positions(spark.range(50).select(F.lit("k").alias("k"), F.col("id").alias("v")), "k", "v")
    assert ops.list_text(rows, "k", "v", max_items=50).first()["list_text"] == ",".join(map(str, range(50)))
    with pytest.raises(Exception, match="a key has 50 items"):
        ops.list_text(rows, "k", "v", max_items=49).collect()
    with pytest.raises(Exception, match="a key has 50 items"):
        ops.set_text(rows, "k", "v", max_items=49).collect()


def test_empty_table(spark):
    assert ops.positions(spark.createDataFrame([], "k string, v string"), "k", "v").collect() == []
