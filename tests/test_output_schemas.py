"""Every market table has the column order and types of the published outputs."""

import json

import pytest

from overround import schemas as S
from overround.plans import pipelines as pl
from overround.sources import read_market_csv, write_csv

from .fixtures import LISTING_HTML, SB_EVENT_URL, TAB_DOC, landed_lines, sb_landed


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("schemas")
    (d / "tab").mkdir()
    (d / "tab" / "a.json").write_text(landed_lines([("tab://r", json.dumps(TAB_DOC))]))
    spark.createDataFrame([(1, "u", LISTING_HTML)], "page_id bigint, url string, html string") \
         .write.parquet(str(d / "pages"))
    (d / "sb").mkdir()
    (d / "sb" / "a.json").write_text(landed_lines(sb_landed(9123456)))
    (d / "meta").mkdir()
    (d / "meta" / "a.json").write_text(landed_lines([(SB_EVENT_URL.format(id=9123456), "{}")]))
    out = pl.run_tab(spark, str(d / "tab"), str(d / "out"))
    out.update(pl.run_sportsbet(spark, str(d / "pages"), str(d / "sb"), str(d / "meta"), str(d / "out")))
    return out, d


def test_market_tables_match_declared_schemas(spark, outputs):
    out, _ = outputs
    assert set(out) == set(S.MARKET_TABLES)
    for name, path in out.items():
        got = spark.read.parquet(path).schema
        want = S.MARKET_TABLES[name]
        assert [(f.name, f.dataType) for f in got.fields] == [(f.name, f.dataType) for f in want.fields], name


def test_csv_sink_roundtrip_with_declared_schema(spark, outputs):
    out, d = outputs
    df = spark.read.parquet(out["tab_totals"])
    write_csv(df, str(d / "csv" / "tab_totals"))
    back = read_market_csv(spark, str(d / "csv" / "tab_totals"), "tab_totals")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
