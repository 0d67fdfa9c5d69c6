"""Stages of the pipeline against plain Python."""

import random

import pytest

import corpus_pipeline
from overround.llm import decontaminate, minhash, queries, toxicity
from tests.llm.conftest import SF, with_clashes
from tests.llm.test_llm_dedup import cut, noisy, shingles
from tests.llm.test_llm_packing_leaks import check_packing, ids_of


def kept_at(rows, percent):
    """Ids that brute force keeps: the smallest of each group of linked documents."""
    sets, parent = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            s, t = sets[a], sets[b]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d for d in ids if find(d) == d}


def pairs_around_the_bound(rng):
    """Pairs of texts of their own words, whose similarities lie around 0.8."""
    rows = []
    for k in range(60):
        base = [f"t{k}w{j}" for j in range(150)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, noisy(rng, base, 1 + k % 5))]
    return rows


def test_near_copies_of_similarity_080_are_dropped(spark):
    rows = [*pairs_around_the_bound(random.Random(3)), (900, None), (901, "")]
    assert kept_at(rows, 85) - kept_at(rows, 80)  # pairs in [0.80, 0.85)
    docs = with_clashes(spark, [*rows, (None, rows[0][1])], "doc_id long, text string").repartition(3)
    out = [r["doc_id"] for r in corpus_pipeline.near_duplicates_stage(spark, docs, SF).select("doc_id").collect()]
    assert sorted(d for d in out if d is not None) == sorted(kept_at(rows, 80)) and out.count(None) == 1


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95])
def test_bands_find_sets_at_the_bound(percent):
    rows = minhash.band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** (minhash.BINS // rows) <= minhash.MISSES
    assert percent != 85 or rows == 8


def test_run_equals_plain_python_stage_by_stage(spark, documents):
    """Toxicity and leaks by the operators' marks; near copies, passages and pieces by plain Python."""
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    scored = toxicity.score_toxicity(documents, labels, queries.fold("doc_id", 3) == 1).collect()
    clean = {r["doc_id"]: r["text"] for r in scored if r["toxicity"]["predicted"] == 0}
    single = kept_at(list(clean.items()), 80)
    once = [(d, clean[d]) for d in sorted(single)]
    texts = {d: t if not gone else kept for (d, t), (_, _, gone, kept) in zip(once, cut(once), strict=True)}
    rest = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    leaks = {r["doc_id"] for r in decontaminate.mark_leaks(rest, items, out_col="found").where("size(found) > 0").collect()}
    last = {d: t for d, t in texts.items() if d not in leaks}
    want, docs = [clean, dict(once), texts, last], documents
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        got = docs.select("doc_id", "text").collect()
        assert len(got) == len(expected) and {r["doc_id"]: r["text"] for r in got} == expected, name
    check_packing(corpus_pipeline.run(spark, SF).collect(), dict(zip(last, ids_of(last.values()), strict=True)), 4096)


def test_toxicity_stage_drops_what_the_operator_predicts(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels, queries.fold("doc_id", 3) == 1).collect()
    toxic = {r["doc_id"] for r in scored if r["toxicity"]["predicted"] == 1}
    kept = [r["doc_id"] for r in corpus_pipeline.toxicity_stage(spark, docs, sf).select("doc_id").collect()]
    assert toxic and sorted(kept) == sorted(r["doc_id"] for r in scored if r["doc_id"] not in toxic)
