"""Pairs of keys that hold very many rows equal those of a plain join."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from overround import operators as op
from overround.plans import markets as mk


def pairs(rows, how):
    """Null-safe join of the two sides, in plain Python."""
    out = Counter()
    for k, side, x in rows:
        if side in ("l", "b"):
            others = [y for k2, s2, y in rows if s2 in ("r", "b") and k2 == k]
            out.update((k, x, y) for y in others)
            if not others and how == "left":
                out[(k, x, None)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 7, 1000])
def test_grid_of_chunks_equals_the_join(spark, how, hot_rows):
    rng = random.Random(hot_rows)
    rows = [(rng.choice(["a", "a", "b", None, "c"]), rng.choice("llrb"), rng.randrange(5)) for _ in range(120)]
    rows += [("only left", "l", k) for k in range(20)] + [("only right", "r", k) for k in range(20)] + [("a", "x", 1)]
    df = spark.createDataFrame(rows, "k string, side string, x int")
    left, right = F.col("side").isin("l", "b"), F.col("side").isin("r", "b")
    out = op.pair_sides(df, ["k"], left, right, [F.col("x").alias("lx")], [F.col("x").alias("rx")], how, hot_rows)
    assert out.columns == ["k", "lx", "rx"]
    assert Counter(map(tuple, out.collect())) == pairs([r for r in rows if r[1] != "x"], how)


def test_a_hot_key_is_gathered_in_chunks(spark):
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                             F.when(F.col("id") % 3000 == 0, "r").otherwise("l").alias("s"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = op.pair_sides(df, ["k"], F.col("s") == "l", F.col("s") == "r", [F.col("id").alias("x")], [F.col("id").alias("y")], "left", 500)
        assert out.count() == 9_990 * 10 + 20_000
        sizes = [r["count"] for r in out.where("k = 0").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 3 and max(sizes) < 0.6 * 99_900
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_hot_key_means_one_pass(spark):
    df = spark.createDataFrame([("a", "l", 1), ("a", "r", 2)], "k string, s string, x int")
    out = op.pair_sides(df, ["k"], F.col("s") == "l", F.col("s") == "r", [F.col("x").alias("lx")], [F.col("x").alias("rx")], hot_rows=5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and out.collect()[0][:] == ("a", 1, 2)
    assert mk.pair_sides is op.pair_sides
