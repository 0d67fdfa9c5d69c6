"""Corpus preparation in stages; each reads what the one before kept.

Toxic documents go, then all but one of each group of near copies, then passages that occurred before, then documents
that hold a benchmark item; what is left is packed into training sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from overround.llm import decontaminate, minhash, packing, substring, toxicity
from overround.llm.queries import fold
from overround.llm.shared import read_table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted to be toxic; the model learns from the labels outside the held-out fold."""
    out = toxicity.score_toxicity(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 3) == 1, out_col="_toxicity")
    return out.where(F.col("_toxicity.predicted") == 0).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, linked at similarity 0.8 or more; rows without an id stay."""
    dropped = minhash.near_duplicates(docs, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that repeat earlier passages; texts without any stay as they are."""
    out = substring.remove_repeats(docs, out_col="_dedup")
    cut = F.col("_dedup.n_removed") > 0
    out = out.withColumn("text", F.when(cut, F.col("_dedup.kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    out = decontaminate.mark_leaks(docs, read_table(spark, sf_dir, "benchmark"), out_col="_leaks")
    return out.where(F.size("_leaks") == 0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each document, with its sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("substring", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: SQL can't express sketches, learned lexicons or tokenisers; tests/llm/test_llm_stages.py compares each stage and
#: run()'s pieces with plain Python (toxicity and leaks with the operators' own marks).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to shared storage and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
