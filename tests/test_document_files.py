"""One document in one file: round trip, validity, and nothing of a failed job."""

import os

import pytest
from pyspark.sql import functions as F

from overround.sources import land_documents, read_landed_documents


def names(path):
    return sorted(f for d, _, files in os.walk(path) for f in files if f.endswith(".json") and "_commits" not in d)


def test_documents_come_back_and_add_up(spark, tmp_path):
    path = str(tmp_path / "land")
    rows = [("a.json", '{"x": "é"}', True), ("b.json", "two\nlines\n", True), ("c.json", "[]", True), ("d.json", "bad", False), ("e.json", "?", None)]
    df = spark.createDataFrame(rows, "name string, body string, ok boolean").repartition(3)
    land_documents(df, path, valid_col="ok")
    assert names(path) == ["a.json", "b.json", "c.json"]
    land_documents(spark.createDataFrame([("f.json", "f")], "name string, body string"), path)
    got = sorted(map(tuple, read_landed_documents(spark, path).collect()))
    assert got == [("a.json", '{"x": "é"}'), ("b.json", "two\nlines\n"), ("c.json", "[]"), ("f.json", "f")]


@pytest.mark.parametrize("bad", ["../up.json", "", None, "x/y.json", "_hidden", "same.json", "empty.json"])
def test_a_failed_job_leaves_no_file(spark, tmp_path, bad):
    path = str(tmp_path / "land")
    land_documents(spark.createDataFrame([("kept.json", "1")], "name string, body string"), path)
    rows = [(f"n{k}.json", str(k)) for k in range(50)] + [("same.json", "s"), (bad, "" if bad == "empty.json" else "!")]
    with pytest.raises(Exception, match="not a file name|two documents|is empty"):
        land_documents(spark.createDataFrame(rows, "name string, body string").repartition(4), path)
    assert [tuple(r) for r in read_landed_documents(spark, path).collect()] == [("kept.json", "1")]
    assert names(path) == ["kept.json"]


def test_rows_that_break_before_the_sink(spark, tmp_path):
    path = str(tmp_path / "land")
    land_documents(spark.createDataFrame([("kept.json", "1")], "name string, body string"), path)
    broken = spark.range(20).select(F.concat(F.col("id").cast("string"), F.lit(".json")).alias("name"),
                                    F.when(F.col("id") == 13, F.raise_error(F.lit("no body"))).otherwise("b").alias("body"))
    with pytest.raises(Exception, match="no body"):
        land_documents(broken, path)
    assert names(path) == ["kept.json"]
