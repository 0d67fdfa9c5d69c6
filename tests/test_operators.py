import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from overround import operators as op

from .conftest import rows


def test_natural_join_matches_nulls(spark):
    left = spark.createDataFrame([(1, None, "a"), (1, 2.5, "b"), (2, 1.0, "c")], "m int, line double, o string")
    right = spark.createDataFrame([(1, None, "x"), (1, 2.5, "y"), (1, 2.5, "z")], "m int, line double, u string")
    got = rows(op.natural_join(left, right), ["o", "u"])
    assert [(r["o"], r["u"]) for r in got] == [("a", "x"), ("b", "y"), ("b", "z"), ("c", None)]
    plain = rows(op.natural_join(left, right, null_safe=False), ["o", "u"])
    assert [(r["o"], r["u"]) for r in plain] == [("a", None), ("b", "y"), ("b", "z"), ("c", None)]


def test_keep_first_uses_order_not_arrival(spark):
    data = [("m1", 2.5, 1.9, 3), ("m1", 2.5, 1.9, 1), ("m1", 2.5, 1.9, 2), ("m2", 1.0, 2.0, 5)]
    random.Random(7).shuffle(data)
    df = spark.createDataFrame(data, "match string, line double, price double, ord int").repartition(3)
    got = rows(op.keep_first(df, ["match", "line", "price"], ["ord"]), ["match"])
    assert [(r["match"], r["ord"]) for r in got] == [("m1", 1), ("m2", 5)]


def test_nth_rows_and_first_where(spark):
    df = spark.createDataFrame([("g", 3, "b", 30.0), ("g", 1, "a", 10.0), ("g", 2, "b", 20.0), ("h", 9, "a", 1.0)],
                               "g string, o int, t string, v double")
    nth = rows(op.nth_rows(df, ["g"], ["o"], 2), ["g", "rn"])
    assert [(r["g"], r["rn"], r["o"]) for r in nth] == [("g", 1, 1), ("g", 2, 2), ("h", 1, 9)]
    agg = rows(df.groupBy("g").agg(op.first_where("v", F.col("t") == "b", ["o"]).alias("fb"),
                                   op.first_by("t", ["o"]).alias("ft"),
                                   op.any_true(F.col("t") == "b").alias("anyb")), ["g"])
    assert [(r["g"], r["fb"], r["ft"], r["anyb"]) for r in agg] == [("g", 20.0, "a", True),
                                                                   ("h", None, "a", False)]


def test_opposite_sign_pairs_drop_equal_and_zero(spark):
    home = spark.createDataFrame([(1, 2.5, 1.9), (1, 0.0, 1.9), (1, -4.5, 2.0)], "m int, home_line double, home_win double")
    away = spark.createDataFrame([(1, -2.5, 1.9), (1, 0.0, 1.9), (1, -4.5, 1.8)], "m int, away_line double, away_win double")
    h = home.withColumn("line", F.abs("home_line"))
    a = away.withColumn("line", F.abs("away_line"))
    got = rows(op.opposite_sign_pairs(h, a, ["m", "line"]), ["home_line"])
    assert [(r["home_line"], r["away_line"]) for r in got] == [(2.5, -2.5)]


lines = st.lists(st.sampled_from([-13.5, -6.5, -2.5, -1.0, -0.05, 0.0, 0.05, 0.1, 1.0, 2.5, 6.5, 13.5, None]),
                 min_size=0, max_size=8)


@settings(max_examples=15, deadline=None)
@given(lines, lines)
def test_balanced_pairs_equals_brute_force(spark, hs, as_):
    home = spark.createDataFrame([(1, h, float(i)) for i, h in enumerate(hs)] or [(0, 0.0, 0.0)],
                                 "m int, home_line double, home_win double")
    away = spark.createDataFrame([(1, a, float(i)) for i, a in enumerate(as_)] or [(0, 5.0, 0.0)],
                                 "m int, away_line double, away_win double")
    got = sorted((r["home_win"], r["away_win"]) for r in op.balanced_pairs(home, away, ["m"]).collect())
    exp = sorted((float(i), float(j)) for i, h in enumerate(hs) for j, a in enumerate(as_)
                 if h is not None and a is not None and abs(h + a) < 0.1)
    assert got == exp


def test_balanced_pairs_plan_has_no_cartesian(spark):
    home = spark.createDataFrame([(1, 2.5, 1.9)], "m int, home_line double, home_win double")
    away = spark.createDataFrame([(1, -2.5, 1.9)], "m int, away_line double, away_win double")
    plan = op.balanced_pairs(home, away, ["m"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_union_by_name_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(1,), (1,)], "k int")
    assert sorted(map(tuple, op.union_by_name(a, b).collect()), key=str) == sorted([(1, None), (1, None), (1, "x")], key=str)
    assert op.union_distinct_by_name(a, b).count() == 2


def test_positional_zip_and_array_get(spark):
    df = spark.createDataFrame([(1, ["A", "B"], ["1.9", "2.0", "9"])], "id int, n array<string>, p array<string>")
    got = [tuple(r) for r in op.positional_zip(df, {"name": "n", "price": "p"}, keep=["id"]).collect()]
    assert got == [(1, 0, "A", "1.9"), (1, 1, "B", "2.0"), (1, 2, None, "9")]
    assert df.select(op.array_get("n", 5)).first()[0] is None


def test_select_any_of(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert op.select_any_of(df, ["b", "round", "a"]).columns == ["b", "a"]
