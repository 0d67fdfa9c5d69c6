"""Plan-shape checks: hot keys are cut before the shuffle, pairing never
forms a cross product, filters and columns reach the Parquet scan."""

from pyspark.sql import functions as F

from overround import schemas as S
from overround.plans import markets as mk

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_selections(spark, n=3000):
    """One match holds most of the rows."""
    df = spark.range(n).select(
        F.lit("TAB").alias("agency"), F.lit("s").alias("snapshot_id"),
        F.lit(0).alias("match_pos"), F.lit(0).alias("market_pos"), F.col("id").cast("int").alias("prop_pos"),
        F.lit(None).cast("bigint").alias("match_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("M"), F.col("id").cast("string"), F.lit(" v X")))
         .otherwise(F.lit("Hot v Cold")).alias("match"),
        F.lit("2025-01-01").alias("start_time"), F.lit("Head To Head").alias("market_name"),
        F.lit(None).cast("bigint").alias("market_id"), F.col("id").alias("prop_id"),
        F.lit("x").alias("prop_name"), F.lit(None).cast("string").alias("result_type"),
        (F.col("id") % 7 + 1.5).alias("price"), F.lit(None).cast("double").alias("handicap"),
        F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("string").alias("endpoint"),
        F.lit(None).cast("timestamp").alias("landed_at"), F.lit(None).cast("bigint").alias("body_hash"))
    return spark.createDataFrame(df.rdd, S.SELECTIONS).repartition(6)


def test_hot_match_is_limited_before_shuffle(spark):
    out = mk.h2h_nth(hot_selections(spark), rules=())
    lines = _plan(out).splitlines()
    partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln]
    final = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Final" in ln]
    exchange = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    # Printed top-down: the partial limit sits below the shuffle (runs before it),
    # the final limit above it.
    assert partial and final and exchange
    assert final[0] < exchange[0] < partial[0]
    hot = out.filter("match = 'Hot v Cold'").collect()
    assert len(hot) == 1 and hot[0]["home_win"] == 2.5 and hot[0]["away_win"] == 3.5


def test_pushdown_and_pruning_reach_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    q = li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_quantity")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_market_pairing_plans_have_no_cartesian_product(spark):
    import __spark_entry__ as entry
    for name in ("market_line_balanced", "market_line_opposite", "market_over_under",
                 "market_player_over_under", "join_balanced_pair"):
        plan = _plan(entry.queries()[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_first_row_picks_are_pre_aggregated_before_the_shuffle(spark):
    import __spark_entry__ as entry
    for name in ("agg_conditional_pivot", "market_time_threshold", "market_time_bands"):
        lines = _plan(entry.queries()[name](spark, SF)).splitlines()
        partial = [i for i, ln in enumerate(lines) if "partial_min_by" in ln]
        exchange = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
        assert partial and exchange, name
        # Some partial aggregate is printed below an exchange, i.e. runs map-side before it.
        assert any(p > e for p in partial for e in exchange), name


def lineitems(spark, tmp_path, rows):
    """Rows of (l_orderkey, l_linenumber, l_returnflag) as a lineitem table; returns its folder."""
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_returnflag string").select(
        "l_orderkey", (F.col("l_linenumber") + F.lit(10)).cast("long").alias("l_partkey"), F.lit(7).cast("long").alias("l_suppkey"),
        "l_linenumber", F.lit(2.0).alias("l_quantity"), F.lit(3.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.2).alias("l_tax"), "l_returnflag", F.lit("O").alias("l_linestatus"), F.lit("2025-01-02 03:04:05").cast("timestamp_ntz").alias("l_shipdate"))
    df.write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_landed_documents_are_compressed_and_read_whole(spark, tmp_path):
    """src_json_nested and json_unnest write a fraction of the documents' text, and read all of it back."""
    from pathlib import Path

    from overround.plans import catalog as c
    from overround.session import local_path
    d = lineitems(spark, tmp_path, [(k, 1, "R") for k in range(2000)])
    path = Path(local_path(c._tab_documents(spark, d)))
    size = sum(f.stat().st_size for f in path.glob("part-*"))
    text = spark.read.text(str(path)).agg(F.sum(F.length("value"))).first()[0]
    assert 0 < size < text / 4
    assert c.QUERIES["src_json_nested"](spark, d).count() == 2000
    assert c.QUERIES["json_unnest"](spark, d).count() == 8000


def test_documents_are_parsed_in_no_filter(spark):
    """json_orders_nested: selections of parsed texts; filters inferred from the generator don't repeat the parse."""
    import json

    from overround.sources import parse_documents, sportsbet_selections, tab_selections
    tab = [{"matches": [{"name": "a", "markets": [{"betOption": "x", "propositions": [{"id": 1}]}, None]}, None]}, {"matches": []}, {}]
    sb = [[{"name": "x", "selections": [{"name": "s"}]}, None], []]
    for flatten, schema, bodies in ((tab_selections, S.TAB_RESPONSE, tab), (sportsbet_selections, S.SB_MARKETS_RESPONSE, sb)):
        docs = spark.createDataFrame([(f"u{k}", json.dumps(b)) for k, b in enumerate(bodies)] + [("n", None), ("b", "[{")], "url string, body string")
        out = flatten(parse_documents(docs, schema))
        filters = [ln for ln in _plan(out).splitlines() if "Filter" in ln]
        assert not any("from_json" in ln or "jsonObjectKeys" in ln for ln in filters), filters
        assert [tuple(r) for r in out.select("source_url", "market_pos", "prop_pos").collect()] == [("u0", 0, 0)]
