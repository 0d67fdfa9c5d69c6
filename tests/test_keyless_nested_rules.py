"""Positions over whole tables, elements that hold elements, and tables of name rules."""

import random

import pytest
from pyspark.sql import functions as F

from overround import functions as fx
from overround import operators as op
from overround.functions.names import TEAM_NAME_RULES
from overround.sources import nested_texts


def test_positions_follow_the_order(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 1, 1, 2, 3]), k) for k in range(500)]
    df = spark.createDataFrame(data, "a int, b int").repartition(7)
    got = sorted(tuple(r) for r in op.with_ordinal(df, ["a", "b"], "n").select("n", "a", "b").collect())
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == [(i, *r) for i, r in enumerate(want)]
    with pytest.raises(ValueError, match="already"):
        op.with_ordinal(df, ["a"], "b")
    assert op.with_ordinal(df.limit(0), ["a"], "n").collect() == []


def test_a_value_of_a_third_of_all_rows_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that small partitions stay apart
    df = spark.range(0, 1_000_000, 1, 16).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("v"))
    try:
        out = op.with_ordinal(df, ["k"], "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n, low, high, different = out.agg(F.count("*"), F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert (n, low, high, different) == (1_000_000, 0, 999_999, 1_000_000)
    steps = out.select("n", "k").orderBy("n").where("k = 7").agg(F.max("n") - F.min("n") + 1, F.count("*")).first()
    assert steps[0] == steps[1] > 300_000
    # The rows were written by range, several files share the frequent value, and none holds much more than its part.
    sizes = [spark.read.parquet(f).count() for f in out.inputFiles()]
    assert len(sizes) > 3 and max(sizes) < 2.5 * 1_000_000 / len(sizes)


def test_tables_join_by_position_without_keys(spark):
    left = spark.range(1_000_000).select((F.lit(10) * F.col("id")).alias("x"))
    right = spark.range(900_000).select((-F.col("id")).alias("y"))
    joined = op.positional_join(left, right, [], ["x"], ["y"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert joined.agg(F.count("*"), F.sum(F.when(F.col("x") == 10 * F.col("pos"), 1)), F.sum(F.when(
        F.col("y") == F.col("pos") - 899_999, 1))).first()[:] == (900_000, 900_000, 900_000)
    full = op.positional_join(left.limit(3), right.limit(2), [], ["x"], ["y"], how="full").orderBy("pos").collect()
    assert [(r["x"] is None, r["y"] is None) for r in full] == [(False, False), (False, False), (False, True)]


@pytest.mark.parametrize("html, want", [
    ('<div class="ad">a<div>b</div>c</div>d', ["abc"]),
    ('<div class="ad">a<div class="x ad">b</div>c</div>', ["abc", "b"]),
    ('<p class=ad>a<br>b<div>c</p>d</div>', ["abc"]),
    ('<DIV CLASS="ad">a<!-- <div> --><script>"</div>"</script>b</Div>c', []),
    ("<div class='ad'>a<!-- <div> --><script>\"</div>\"</script>b</Div>c", ["ab"]),
    ('<div class="ad">never <b>closed', ["never closed"]),
    ('</div><div class="ad">x</div></div>', ["x"]),
    ('<img class="ad"><span class="ad"/>t<i class="ad"></i>', ["", "", ""]),
    ('<a class="ad" title="x>y">1 &lt; 2</a>', ["1 < 2"]),
    ("no tags", []), ("", []), (None, None),
])
def test_elements_end_where_their_depth_returns(spark, html, want):
    row = spark.createDataFrame([(html,)], "html string").select(nested_texts("html", "ad").alias("t")).first()
    assert row["t"] == want


def chain(names, rules):
    """First rule by (priority, canonical) that is found in a name, with the same engine's regular expressions."""
    from itertools import groupby

    ordered = sorted(rules, key=lambda r: (r[2], r[1]))
    assert all(len(list(g)) >= 1 for _, g in groupby(ordered))
    return names.select("name", fx.canonicalize("name", [(p, c) for p, c, _ in ordered]).alias("want"))


def test_rule_tables_equal_the_case_chain(spark):
    rng = random.Random(5)
    syllables = ["an", "bel", "cor", "dun", "el", "far", "gol"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))).capitalize()
    patterns = [lambda: f"(^{word()})|({word()})", lambda: f"^{word()} {word()}$", lambda: f" {word()} ", lambda: f"{word()} {word()} {word()}",
                lambda: f"(^{word()} {word()}|{word()}$)", lambda: f"{word()[:2]}", lambda: f"^{word()}.*{word()}$"]
    rules = [(rng.choice(patterns[:5])(), f"Team {k}", rng.randrange(100)) for k in range(150)]
    rules += [(p, c, 200 + k) for k, (p, c) in enumerate(TEAM_NAME_RULES)] + [(patterns[k % 2 + 5](), f"Always {k}", 50 + k) for k in range(4)]
    names = [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(400)] + ["", "x", "Brisbane B", "The Sea Eagles\n", None, "Dunan\n"]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names + names)], "k int, name string")
    table = spark.createDataFrame(rules, "pattern string, canonical string, priority int")
    got = fx.canonicalize_by_table(df, "name", table, "got")
    assert got.columns == ["k", "name", "got"]
    want = {r["name"]: r["want"] for r in chain(df, rules).collect()}
    found = got.collect()
    assert len(found) == 2 * len(names) and all(r["got"] == want[r["name"]] for r in found)
    assert len({r["got"] for r in found}) > 20


def test_two_thousand_rules_without_a_cross_join(spark):
    rules = [(f"(^Club {k} )|(Side{k:04d})", f"Team {k}", k) for k in range(2000)]
    table = spark.createDataFrame(rules, "pattern string, canonical string, priority int")
    names = spark.range(20_000).select(F.concat(F.lit("Club "), (F.col("id") % 2500).cast("string"), F.lit(" FC")).alias("name"))
    out = fx.canonicalize_by_table(names, "name", table)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    counts = {r["name"]: r["count"] for r in out.groupBy("name").count().collect()}
    assert len(counts) == 2500 and counts["Team 7"] == 8 and counts["Club 2400 FC"] == 8
    filed, unfiled = fx.rule_index(table)
    assert filed.count() == 4000 and unfiled.count() == 0
    # A word whose ends are known files a rule better than three characters of it do.
    assert filed.where("piece = 'w:77'").select("canonical").collect()[0][0] == "Team 77"


def test_too_many_rules_without_plain_text_are_refused(spark):
    table = spark.createDataFrame([(f"a.{k}", "x", k) for k in range(5)], "pattern string, canonical string, priority int")
    df = spark.createDataFrame([("a77",)], "name string")
    with pytest.raises(ValueError, match="plain text"):
        fx.canonicalize_by_table(df, "name", table, max_unfiled=4)
    assert fx.canonicalize_by_table(df, "name", table.limit(0)).collect()[0][0] == "a77"


def test_alias_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "k int, name string")
    aliases = spark.createDataFrame([("a", "B"), ("a", "A"), (None, "N")], "alias string, canonical string")
    assert sorted(map(tuple, fx.apply_alias_table(df, "name", aliases).select("k", "name").collect())) == [(1, "A"), (2, "b"), (3, None), (4, "A")]
    joined = fx.apply_alias_table(df, "name", aliases, "c")
    assert joined.columns == ["k", "name", "c"]
