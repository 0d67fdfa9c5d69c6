"""URL filters and preference formatting: rules, equivalence, nulls, ties, empty tables; and their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from overround.llm import chat, queries, urls
from overround.llm.components import connected_components
from tests.llm.conftest import SF, with_clashes

RULES = queries.RULES


def verdicts(spark, rows, edges=None):
    pages = with_clashes(spark, rows, "page_id long, url string, html string")
    links = spark.createDataFrame(edges, "from_url string, to_url string") if edges else None
    return {r["page_id"]: r for r in urls.filter_urls(pages, RULES, links).collect()}


def test_hosts_paths_and_rules(spark):
    cases = {
        1: ("https://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        2: ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("http://sub.www.example.com/en/1", "sub.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        4: ("http://x.com", "x.com", "", None, "allow"),
        5: ("http://x.com?a=/b", "x.com", "", None, "allow"),
        6: ("http://x.com/", "x.com", "/", "com/", "allow"),
        7: ("http://notnet/es/", "notnet", "/es/", None, "allow"),
        8: ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        9: ("http://a.net/ES/1", "a.net", "/ES/1", None, "allow"),
        10: ("a.net/es/1", "", "", None, "allow"),
        11: (None, "", "", None, "allow"),
        12: ("", "", "", None, "allow"),
        13: ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
        14: ("x://ÄA.net/fr/://y", "Äa.net", "/fr/://y", "net/fr/", "block"),
    }
    got = verdicts(spark, [(k, v[0], None) for k, v in cases.items()])
    for k, (_, host, path, rule, verdict) in cases.items():
        r = got[k]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict), k


def test_blocks_follow_links_and_permissions_hold(spark):
    canonical = "<head><link rel='canonical' href=\"{}\"></head>"
    refresh = '<META HTTP-EQUIV="Refresh" content="0; URL=https://b.org/2">'
    got = verdicts(spark, [
        (1, "http://b.org/1", canonical.format("https://x.net/es/1")),       # alias of a blocked address
        (2, "http://b.org/2?utm_source=a", None),                            # reached by a refresh from 3
        (3, "http://b.org/3", refresh + canonical.format("http://b.org/1")),
        (4, "http://x.net/es/1/", None),                                     # blocked by its rule
        (5, "http://b.org/5", canonical.format("http://y.net/fr/5")),        # its component is also allowed
        (6, "http://c.com/6", canonical.format("http://b.org/5")),
        (7, "http://y.net/fr/5", None),
        (8, "http://b.org/8", "<a href='http://x.net/es/1'>no canonical link</a>"),
        (9, "https://b.org/1#top", None),                                    # same address as 1
        (None, "http://b.org/1", None),
    ])
    assert {k: r["verdict"] for k, r in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "allow", 9: "block", None: "block"}


def test_edges_repeated_rows_and_empty_tables(spark):
    rows = [(1, "http://b.org/1", None)] * 2 + [(2, "http://x.net/es/2", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = spark.createDataFrame([("http://b.org/1", "http://b.org/z"), ("http://b.org/z", "http://x.net/es/2"),
                                   (None, "http://b.org/1")], "from_url string, to_url string")
    out = urls.filter_urls(pages, RULES, edges).collect()
    assert [r["verdict"] for r in out] == ["block"] * 3
    assert urls.filter_urls(pages.limit(0), RULES).count() == 0


def test_components_match_union_find(spark):
    import random

    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 470)]
    edges += [(999, k) for k in range(500, 600)] + [(7, 7), (None, 3), (4, None)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in list(parent)}


def turns(spark, rows):
    return with_clashes(spark, rows, "conv_id long, turn long, role string, text string")


def test_common_prefix_is_rendered_once(spark):
    a = [("system", "s"), ("user", "u"), ("assistant", "good"), ("user", "more"), ("assistant", "fine")]
    b = [("system", "s"), ("user", "u"), ("assistant", "bad")]
    rows = [(1, a, b), (2, a, a), (3, a, None), (4, [], []), (5, [("user", None)], [("user", None), ("assistant", "x")])]
    pairs = spark.createDataFrame(rows, "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    got = {r["pair_id"]: r for r in chat.format_preferences(pairs.na.fill("")).collect()}
    one = got[1]
    assert one["prompt"] == "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n" and one["prompt_turns"] == 2 and one["informative"]
    said = [one["chosen_completion"][s["start"]:s["stop"]] for s in one["chosen_mask"]]
    assert said == ["good<|end|>\n", "fine<|end|>\n"]
    assert [one["rejected_completion"][s["start"]:s["stop"]] for s in one["rejected_mask"]] == ["bad<|end|>\n"]
    assert (got[2]["chosen_completion"], got[2]["rejected_completion"], got[2]["informative"]) == ("", "", False)
    assert got[3]["prompt"] == "" and not got[3]["informative"] and got[4]["prompt"] == ""
    assert got[5]["prompt_turns"] == 1


def test_turns_nulls_ties_and_last_replies(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "abcd"), (None, 0, "assistant", "lost"), (2, 0, "user", None),
            (3, 0, "user", "a"), (3, 1, "assistant", "one"), (3, 2, "user", "b"), (3, 3, "assistant", "two"), (3, 4, "user", "c"),
            (4, None, None, "first"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (5, 0, "assistant", "")]
    got = {r["pair_id"]: r for r in chat.contrast_last_reply(chat.gather_turns(turns(spark, rows))).collect()}
    assert set(got) == {1, 3, 4, 5}
    assert got[1]["rejected"][-1]["text"] == "ab" and got[3]["rejected"][-1]["text"] == "one"
    assert len(got[3]["chosen"]) == 4 and got[4]["chosen"][0] == ("user", "first")
    assert got[4]["rejected"][-1]["text"] == "sa" and got[5]["rejected"][-1]["text"] == ""
    assert chat.gather_turns(turns(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")

    def plain(v):
        if hasattr(v, "asDict"):
            return [plain(x) for x in v]
        if isinstance(v, dict):
            return [plain(x) for x in v.values()]
        return [plain(x) for x in v] if isinstance(v, list) else v

    df = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    assert got == sorted(repr([plain(x) for x in r]) for r in want.fetchall())


def test_links_are_resolved_as_browsers_do(spark):
    from urllib.parse import urljoin

    bases = ["http://a.org", "http://a.org/", "https://a.org/x/y.html", "http://a.org/x/y/?q=1", "https://a.org/x/y/z#f"]
    targets = ["page.html", "./p", "../z", "../../../z", "?p=1", "/k", "/k/./x/../y?a=b", "//o.net/r", "HTTPS://o.net/s?t", "a/../b/./c", "..", "."]
    rows = [(b, t) for b in bases for t in targets]
    df = spark.createDataFrame(rows, "url string, target string")
    got = df.select("url", "target", urls.address(urls.absolute(F.col("target"), F.col("url"))).alias("got"),
                    ).collect()
    want = spark.createDataFrame([(b, t, urljoin(b, t)) for b, t in rows], "url string, target string, w string").select(
        "url", "target", urls.address(F.col("w")).alias("want")).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}
    none = spark.createDataFrame([("http://a.org/x", t) for t in ("", " ", "#top", "mailto:x@y.z", "javascript:void(0)", None)], "url string, target string")
    assert [r[0] for r in none.select(urls.absolute(F.col("target"), F.col("url"))).collect()] == [None] * 6


def test_a_block_reaches_relative_aliases(spark):
    link = "<head>{}<link rel='canonical' href='{}'></head>"
    pages = spark.createDataFrame([
        (1, "http://x.net/es/1", "<p>blocked by its rule</p>"), (2, "http://x.net/2/old", link.format("", "../es/1")),
        (3, "http://x.net/fr/3", None), (4, "http://b.org/4", link.format("<base href='//x.net/fr/'>", "3")),
        (5, "http://b.org/5", link.format("", "4"))], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, queries.RULES).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block"}
