import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
#: Names that operators use inside; as extra columns of an input they must do no harm.
CLASHES = {"id": 1, "node": "x", "n": 2.5, "component": "c", "spans": "s", "row": 3, "cut": "k", "known": 4, "words": "w"}


def with_clashes(spark, rows, schema):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    return df.select("*", *(F.lit(v).alias(k) for k, v in CLASHES.items() if k not in df.columns))


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
