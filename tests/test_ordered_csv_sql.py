"""Ordered CSV tables and the readers as SQL table functions."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from overround import schemas as S
from overround.functions.sql_functions import register_sql_functions
from overround.sources import (
    damaged_files, number_text, parse_documents, read_csv_ordered, read_manifest, sportsbet_selections, swap_in, tab_selections,
    url_manifest, write_csv_ordered,
)

from .fixtures import TAB_DOC, sb_market_doc

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("p", T.DoubleType()), T.StructField("t", T.StringType())])


def test_numbers_are_written_as_the_feed_scripts_do(spark):
    values = [2.0, 2.5, -3.0, 0.0, 1.952, 1e10, 12345678.25, 1.25e-7, 100000.0, None, 1 / 3]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(number_text(F.col("v"))).collect()]
    assert got == ["2", "2.5", "-3", "0", "1.952", "10000000000", "1.234567825e7", "1.25e-7", "100000", None, "0.3333333333333333"]


@pytest.mark.parametrize("files", [None, 5])
def test_order_and_text_come_back(spark, tmp_path, files):
    rng = random.Random(2)
    data = [(rng.choice([None, 1, 1, 2, 3]), rng.choice([1.0, 2.5, None]), rng.choice(["x", " lead", 'q"q', "a,b", "two\nlines", None, ""]))
            for _ in range(300)]
    df, path = spark.createDataFrame(data, SCHEMA).repartition(4), str(tmp_path / "c")
    manifest = write_csv_ordered(df, path, ["k", "p", "t"], files=files).orderBy("number").collect()
    back = read_csv_ordered(spark, path, SCHEMA).orderBy("pos").collect()
    low = lambda x: (x is None, x if x is not None else 0)
    want = sorted(data, key=lambda r: (low(r[0]), low(r[1]), r[2] is None, r[2] or ""))
    assert [tuple(r)[1:] for r in back] == want and [r["pos"] for r in back] == list(range(300))
    assert sum(r["n_rows"] for r in manifest) == 300 and (files is None or len(manifest) > 1)
    assert [r["before"] for r in manifest] == [sum(m["n_rows"] for m in manifest[:i]) for i in range(len(manifest))]
    firsts = [json.loads(r["first_key"]) for r in manifest]
    assert [f.get("k") for f in firsts] == [None if (v := want[m["before"]][0]) is None else str(v) for m in manifest]
    assert damaged_files(spark, path, SCHEMA.fieldNames()).count() == 0


def test_damage_is_seen_and_a_rewrite_replaces(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(100).select(F.col("id").cast("int").alias("k"), F.col("id").cast("double").alias("p"), F.lit("t").alias("t"))
    write_csv_ordered(df, path, ["k"], files=4)
    part = sorted(f for f in os.listdir(path) if f.startswith("part-"))[1]
    text = open(f"{path}/{part}").read()
    os.remove(f"{path}/.{part}.crc")
    with open(f"{path}/{part}", "w") as out:
        out.write(text.rstrip()[:-1] + "u\n")
    assert [r["file"] for r in damaged_files(spark, path, SCHEMA.fieldNames()).collect()] == [part]
    os.remove(f"{path}/{part}")
    assert [(r["file"], r["n_found"]) for r in damaged_files(spark, path, SCHEMA.fieldNames()).collect()] == [(part, None)]
    write_csv_ordered(df.limit(0), path, ["k"])
    assert read_csv_ordered(spark, path, SCHEMA).count() == 0 and read_manifest(spark, path).agg(F.sum("n_rows")).first()[0] in (0, None)
    bad = df.withColumn("p", F.raise_error(F.lit("no price")).cast("double"))
    write_csv_ordered(df, path, ["k"])
    with pytest.raises(Exception, match="no price"):
        write_csv_ordered(bad, path, ["k"])
    assert read_csv_ordered(spark, path, SCHEMA).count() == 100 and os.listdir(tmp_path) == ["c"]


def test_swapping_in_needs_a_staged_folder(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "x").write_text("1")
    with pytest.raises(OSError, match="can't move"):
        swap_in(spark, str(tmp_path / "none"), str(tmp_path / "old"))
    assert (tmp_path / "old" / "x").read_text() == "1"


def test_table_functions_read_like_the_operators(spark):
    assert register_sql_functions(spark) == ["tab_propositions", "sportsbet_propositions", "request_urls"]
    bodies = [json.dumps(TAB_DOC), "{}", "[", None]
    docs = spark.createDataFrame([(f"u{k}", b) for k, b in enumerate(bodies)], "url string, body string")
    columns = ["match_pos", "match", "start_time", "market_pos", "market_name", "prop_pos", "prop_id", "prop_name", "price"]
    got = spark.sql("SELECT url AS source_url, p.* FROM {docs}, LATERAL tab_propositions(body) AS p", docs=docs)
    want = tab_selections(parse_documents(docs, S.TAB_RESPONSE).where("is_valid")).select("source_url", *columns)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 24

    markets = spark.createDataFrame([("u", json.dumps(sb_market_doc(1)))], "url string, body string")
    columns = ["market_pos", "market_name", "market_id", "prop_pos", "prop_id", "prop_name", "result_type", "price", "handicap"]
    got = spark.sql("SELECT p.* FROM {markets}, LATERAL sportsbet_propositions(body) AS p", markets=markets)
    want = sportsbet_selections(parse_documents(markets, S.SB_MARKETS_RESPONSE)).select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and got.count() > 0

    ids = spark.createDataFrame([(1,), (1234567890,)], "match_id long")
    got = spark.sql("SELECT match_id, r.* FROM {ids}, LATERAL request_urls('https://api.example.com/sportsbook', match_id) AS r", ids=ids)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, url_manifest(ids).collect()))


def test_table_functions_join_no_documents(spark):
    """A lateral join over a reader is a generator on the document's row; missing lists give no row, null elements one."""
    register_sql_functions(spark)
    tab = [{"matches": [{"name": "a", "markets": [{"betOption": "x", "propositions": [{"id": 1}, None]}, {"betOption": "y"}, None]},
                        None, {"name": "b"}]}, {"matches": []}, {}]
    markets = [[{"name": "x", "selections": [{"name": "s", "unformattedHandicap": "+1.5"}, {"unformattedHandicap": "?"}]}, {"name": "y"}, None], []]
    for function, bodies, want in (("tab_propositions", tab, [(0, "a", None, 0, "x", 0, 1, None, None), (0, "a", None, 0, "x", 1, None, None, None)]),
                                   ("sportsbet_propositions", markets, [(0, "x", None, 0, None, "s", None, None, 1.5),
                                                                        (0, "x", None, 1, None, None, None, None, None)])):
        docs = spark.createDataFrame([(json.dumps(b),) for b in [*bodies, bodies[0]]], "body string")
        got = spark.sql(f"SELECT p.* FROM {{docs}}, LATERAL {function}(body) AS p", docs=docs)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan, plan
        assert sorted(map(tuple, got.collect())) == sorted([*want, *want])
