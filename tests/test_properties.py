
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from overround import functions as fx
from overround import operators as op

prices = st.floats(min_value=1.01, max_value=101.0, allow_nan=False)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(prices, prices), min_size=1, max_size=20))
def test_margin_is_non_negative_and_symmetric(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    got = df.select(fx.margin("a", "b").alias("m"), fx.margin("b", "a").alias("r")).collect()
    assert all(r["m"] >= 0 and r["m"] == r["r"] for r in got)


line_values = st.lists(st.sampled_from([-6.5, -2.5, -0.05, 0.0, 0.05, 2.5, 6.5]), max_size=6)


@settings(max_examples=10, deadline=None)
@given(line_values, line_values)
def test_balanced_pairs_symmetric_under_swapping_sides(spark, hs, as_):
    def side(vals, line, win):
        rows = [(1, v, float(i)) for i, v in enumerate(vals)] or [(0, 99.0, 0.0)]
        return spark.createDataFrame(rows, f"m int, {line} double, {win} double")

    fwd = op.balanced_pairs(side(hs, "home_line", "home_win"), side(as_, "away_line", "away_win"), ["m"])
    back = op.balanced_pairs(side(as_, "home_line", "home_win"), side(hs, "away_line", "away_win"), ["m"])
    a = sorted((r["home_win"], r["away_win"]) for r in fwd.collect())
    b = sorted((r["away_win"], r["home_win"]) for r in back.collect())
    assert a == b


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None])), max_size=12))
def test_union_distinct_is_idempotent(spark, data):
    df = spark.createDataFrame(data or [(0, "x")], "k int, s string")
    once = op.union_distinct_by_name(df, df)
    twice = op.union_distinct_by_name(once, once)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10_000))
def test_keep_first_invariant_under_permutation(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("ab"), rng.choice([1.5, 2.5]), rng.choice([1.9, 2.0]), i) for i in range(30)]
    shuffled = data[:]
    rng.shuffle(shuffled)
    a = op.keep_first(spark.createDataFrame(data, "m string, l double, p double, o int"), ["m", "l", "p"], ["o"])
    b = op.keep_first(spark.createDataFrame(shuffled, "m string, l double, p double, o int").repartition(4),
                      ["m", "l", "p"], ["o"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_first_where_ignores_rows_after_the_first_match(spark):
    df = spark.createDataFrame([(1, i, "or later" if i % 2 else "x", float(i)) for i in range(10)],
                               "g int, o int, t string, v double").repartition(3)
    got = df.groupBy("g").agg(op.first_where("v", F.col("t").rlike("or later"), ["o"]).alias("v")).first()
    assert got["v"] == 1.0


keys_st = st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([0.5, 1.5, None]),
                             st.integers(0, 50)), max_size=12)


@settings(max_examples=12, deadline=None)
@given(keys_st, keys_st)
def test_skew_safe_left_join_equals_left_join(spark, left, right):
    l_df = spark.createDataFrame(left or [(9, 9.5, 0)], "m int, line double, o int")
    r_df = spark.createDataFrame([(m, ln, v + 1000) for m, ln, v in right] or [(8, 8.5, 0)], "m int, line double, u int")
    plain = op.natural_join(l_df, r_df, on=["m", "line"], how="left")
    safe = op.natural_join(l_df, r_df, on=["m", "line"], how="left", skew_safe=True)
    assert safe.columns == plain.columns
    assert sorted(map(tuple, safe.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
