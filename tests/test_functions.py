from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from overround import functions as fx


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("y")).first()["y"]


def test_str_extract_null_when_no_match(spark):
    assert one(spark, fx.str_extract("x", r"\d+"), "no digits") is None
    assert one(spark, fx.str_extract("x", r"\d+"), "a 12 b 34") == "12"
    assert one(spark, fx.str_extract("x", r"\d+"), None) is None


def test_signed_number_patterns(spark):
    assert one(spark, fx.extract_number("x", fx.SIGNED_NUMBER), "Team +2.5") == 2.5
    assert one(spark, fx.extract_number("x", fx.SIGNED_NUMBER), "Team -2") == -2.0
    assert one(spark, fx.extract_number("x", fx.SIGNED_DECIMAL), "Team (-2)") is None
    assert one(spark, fx.extract_number("x", fx.SIGNED_DECIMAL), "Team (-13.5)") == -13.5


def test_str_remove_first_only(spark):
    assert one(spark, fx.str_remove("x", "a"), "banana") == "bnana"
    assert one(spark, fx.str_remove("x", r" [\+\-].*$"), "Sharks -4.5") == "Sharks"
    assert one(spark, fx.str_remove("x", r" \(.*\)"), "J Smith (BRI)") == "J Smith"
    assert one(spark, fx.str_remove("x", "z"), "abc") == "abc"


def test_str_replace_first_literal_replacement(spark):
    assert one(spark, fx.str_replace_first("x", "a Try", "1+ Tries"), "To Score a Try") == "To Score 1+ Tries"
    assert one(spark, fx.str_replace_first("x", "o", "$1\\"), "foo") == "f$1\\o"
    assert one(spark, fx.str_replace_first("x", "0-", ""), "0-10") == "10"


def test_separate_pads_and_drops(spark):
    df = spark.createDataFrame([("A v B",), ("A",), ("A v B v C",), (None,)], "m string")
    got = [tuple(r) for r in df.select(*fx.separate("m", " v ", ["h", "a"])).collect()]
    assert got == [("A", "B"), ("A", None), ("A", "B"), (None, None)]


def test_paste_null_propagates(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None)], "h string, a string")
    got = [r[0] for r in df.select(fx.paste("h", F.lit("v"), "a")).collect()]
    assert got == ["A v B", None]


def test_as_numeric_is_safe(spark):
    assert one(spark, fx.as_numeric("x"), "2.5") == 2.5
    assert one(spark, fx.as_numeric("x"), " 7 ") == 7.0
    assert one(spark, fx.as_numeric("x"), "Over") is None


def test_ids_from_urls(spark):
    url = "https://x.example/Events/9123456/MarketGroupings/313/Markets"
    assert one(spark, fx.url_match_id("x"), url) == 9123456
    assert one(spark, fx.url_match_id("x"), "https://x.example/Events/12345/") is None
    assert one(spark, fx.url_match_id("x"), "https://x.example/Events/123456789/") == 12345678
    assert one(spark, fx.link_id_tail("x"), "/betting/league/a-v-b-9123456") == 9123456
    assert one(spark, fx.link_id_tail("x"), "/betting/league/a-v-b") is None


def _half_up(a, b):
    v = Decimal(repr(1 / a + 1 / b))
    return float(v.quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))


def test_margin_matches_half_up_and_zero_price_is_null(spark):
    pairs = [(1.9, 1.9), (1.5, 2.6), (1.01, 21.0), (3.25, 1.35), (2.0, 2.0), (1.8, 2.0)]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [r[0] for r in df.select(fx.margin("a", "b")).collect()]
    assert got == [_half_up(a, b) for a, b in pairs]
    df0 = spark.createDataFrame([(0.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df0.select(fx.margin("a", "b")).collect()] == [None, None]


def test_team_rules_first_match_wins_default_and_null(spark):
    names = ["Broncos", "Brisbane", "Sea Eagles", "Dolphins", "The Dolphins", "Souths", None,
             "Sharks", "Wests Tigers"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(fx.canonicalize("n")).collect()]
    assert got == ["Brisbane Broncos", "Brisbane Broncos", "Manly Warringah Sea Eagles", "Dolphins",
                   "The Dolphins", "Souths", None, "Cronulla Sharks", "Wests Tigers"]


def test_player_alias_exact_match(spark):
    df = spark.createDataFrame([("Nasiah W-Milera",), ("Nasiah W-Milera Jr",)], "n string")
    got = [r[0] for r in df.select(fx.apply_aliases("n")).collect()]
    assert got == ["Nasiah Wanganeen-Milera", "Nasiah W-Milera Jr"]


def test_html_text_helpers(spark):
    assert one(spark, fx.decode_entities(fx.strip_tags("x")), "<b>A &amp; B</b> &lt;3") == "A & B <3"


def test_str_remove_multiline_and_end_anchored(spark):
    text = "J Smith (BRI)\nsecond (x)"
    # '.' does not cross line breaks inside the caller's pattern.
    assert one(spark, fx.str_remove("x", r" \(.*\)"), text) == "J Smith\nsecond (x)"
    assert one(spark, fx.str_replace_first("x", "o", "0"), "a\nfoo") == "a\nf0o"
    # End-anchored fast path equals the first-match form.
    for value in ["Sharks -4.5", "Sharks", "A -1 -2", "Team (+2.5)", "(x) (y)", None]:
        for pattern in (r" [\+\-].*$", r" \(.*\)$"):
            fast = one(spark, fx.str_remove("x", pattern), value)
            slow = one(spark, fx.str_replace_first("x", pattern, ""), value)
            assert fast == slow, (value, pattern)
