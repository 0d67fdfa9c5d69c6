"""Quality, language, toxicity and nearest neighbours: gradients, brute force, held-out figures, odd rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from overround.llm import ann, langid, quality, queries, toxicity
from tests.llm.conftest import SF, with_clashes

LONG = "good words of many kinds " * 20000


def test_gradients_of_the_network():
    net = langid.new_network(["a", "b", "c"])
    for d in (net.forward, net.backward):
        d.bytes, d.gates, d.candidate = (w.astype(np.float64) for w in (d.bytes, d.gates, d.candidate))
    words, labels = [b" abc ", b" de ", b" fghij "], np.array([0, 1, 2])
    _, slopes = langid.gradients(net, words, labels)
    rng = np.random.default_rng(0)
    for w, g in zip(net.weights(), slopes, strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if w.shape[0] == 256:
                at = (ord(rng.choice(list(" abcdefghij"))), at[1])
            old, values = w[at], []
            for e in (3e-3, -3e-3):
                w[at] = old + e
                values.append(langid.gradients(net, words, labels)[0])
            w[at] = old
            assert abs((values[0] - values[1]) / 6e-3 - g[at]) < 2e-3


def test_words_pool_like_texts_and_long_words_are_cut():
    net = langid.new_network(["x", "y"], seed=4)
    reader = langid.Reader(net)
    text = "ab cd, ab " + "e" * 100
    parts = [p for w in langid.split_words(text) for p in langid.pieces(w)]
    assert max(map(len, parts)) <= langid.SPAN and b"".join(langid.pieces(b"e" * 100)).strip() == b"e" * 100
    p, live, *_ = langid.label_positions(net, parts)
    want = (p * live[:, :, None]).sum(axis=(0, 1)) / live.sum()
    assert np.allclose(reader.pool([text, None, "...", text])[[0, 3]], want, atol=1e-5)
    assert (reader.pool([None, "1 2"]) == 0).all()


def test_languages_of_held_out_documents(spark):
    out = queries.QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").alias("p")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out and lang is not null").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.95 * len(rows) > 100 and all(0 <= r["score"] <= 1 for r in rows)


def odd_texts(spark, extra=()):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 ... !!", "en"), (None, "the cat", "en"), (4, "the cat", None),
            (5, LONG, "en"), (5, LONG, "en"), (6, "le chat est la", "fr"), (7, "the dog is here", "en"), *extra]
    return with_clashes(spark, rows, "doc_id long, text string, lang string")


def test_language_of_odd_rows(spark):
    docs = odd_texts(spark)
    out = langid.identify_languages(docs, F.coalesce(F.col("doc_id") == 7, F.lit(False)))
    got = [(r["doc_id"], r["language"]["lang_pred"], r["language"]["held_out"]) for r in out.collect()]
    assert len(got) == 9 and {x for d, x, _ in got if d in (1, 2, 3)} == {"und"}
    assert {x for d, x, _ in got if d not in (1, 2, 3)} <= {"en", "fr"} and [h for d, _, h in got if d == 7] == [True]
    assert set(docs.columns) < set(out.columns)
    none = langid.identify_languages(docs, F.lit(True)).select("language.*").distinct().collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    assert langid.identify_languages(docs.limit(0), F.lit(False)).count() == 0


def test_quadratic_discriminant_equals_the_densities():
    rng, p = np.random.default_rng(1), len(quality.STATISTICS)
    x = {k: rng.standard_normal((400, p)) @ rng.standard_normal((p, p)) + 3 * k for k in (0, 1)}
    model = quality.fit({k: (len(v), np.concatenate([v.sum(axis=0), (v.T @ v).ravel()])) for k, v in x.items()})
    point = (x[0][:5] + x[1][:5]) / 2
    z = np.clip((point - model.centre) / model.scale, -quality.REACH, quality.REACH)
    logs = []
    for prior, mean, inverse, _ in model.classes:
        c = np.linalg.inv(inverse.T @ inverse)
        d = z - mean
        logs.append(prior - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(c), d))
    assert np.allclose(model.scores(point), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_quality_of_held_out_documents_and_odd_rows(spark):
    out = queries.QUERIES["op4_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows) > 40
    docs = odd_texts(spark, [(k, "fine words here and there " * (k % 4 + 1), "en") for k in range(20, 40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(20, 40)] + [(1, 0), (None, 1), (6, None), (7, 5), (20, 1)], "doc_id long, quality int")
    got = quality.score_quality(docs, labels, F.lit(False)).collect()
    assert len(got) == 29 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    none = quality.score_quality(docs, labels.limit(0), F.lit(False)).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    assert quality.score_quality(docs.limit(0), labels, F.lit(False)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_automaton_matches_edit_distances():
    rng = random.Random(5)
    terms = ["abcab", "abba", "cabbacabb", "bcbcbcb", "abcabc", "cabbacabc"]
    automaton = toxicity.Automaton(terms)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    words += [w[:k] + rng.choice("abcx") + w[k + rng.randrange(2):] for w in terms * 40 for k in [rng.randrange(len(w))]]
    for w in words:
        near = [(distance(w, t), t) for t in terms if distance(w, t) <= toxicity.edits_allowed(t)]
        want = (min(near)[1], min(near)[0]) if near else None
        assert automaton.match(w) == want, w


def test_contexts_tell_quotation_from_abuse():
    model = toxicity.Model({"scoundrel": 6.0}, {1: 3.0, 2: 3.0}, frozenset({"scoundrels"}), np.array([-4.0, 1.0, 0.5, 0.3, 0.5]))
    reader = toxicity.Reader(model)
    texts = ["you scoundrel!", 'he wrote "scoundrel" there', "she said scoundrel to me", "you sc0undrel", "two scoundrels", "nothing", None]
    scores = reader.scores(texts)
    assert scores[0] > scores[1] == scores[2] > scores[5] and scores[0] > scores[3] > scores[5] == scores[4] == scores[6]
    assert np.allclose(reader.scores(texts[::-1])[::-1], scores)


def test_toxicity_learns_terms_and_catches_misspellings(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(400):
        words = [f"w{rng.randrange(200)}" for _ in range(30)]
        if k % 4 == 0:
            words[rng.randrange(30)] = "rascallion"
        rows.append((k, " ".join(words), "en"))
        labels.append((k, int(k % 4 == 0)))
    rows += [(1000, "you rascalion you", "en"), (1001, "w1 w2 w3", "en"), (1002, None, None), (1003, "", None), (None, "rascallion", None),
             (1004, "w1 " * 50000 + "Rascallion!", None), (1004, "w5", None)]
    docs = with_clashes(spark, rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([*labels, (None, 1), (1001, None), (0, 0)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(docs, marks, F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False)))
    assert set(docs.columns) < set(out.columns)
    got = [(r["doc_id"], r["toxicity"]) for r in out.collect()]
    assert len(got) == len(rows)
    assert all(t["predicted"] == (d % 4 == 0) for d, t in got if d is not None and d < 400)
    by = {(d, t["predicted"]) for d, t in got}
    assert {(1001, 0), (1002, 0), (1003, 0), (None, 1), (1004, 1), (1004, 0)} <= by
    score = {d: t["score"] for d, t in got}
    assert score[1000] > 2 * score[1001]
    clean = toxicity.score_toxicity(docs, marks.limit(0), F.lit(False)).select("toxicity.predicted").distinct().collect()
    assert [r[0] for r in clean] == [0]
    assert toxicity.score_toxicity(docs.limit(0), marks, F.lit(False)).count() == 0


def brute(rows, k=5):
    seen = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    x = np.array([v for _, v in seen])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for n, (i, _) in enumerate(seen):
        if i % 50 == 0:
            order = sorted((round(-float(u[m] @ u[n]), 12), j) for m, (j, _) in enumerate(seen) if j != i)
            out[i] = order[:k]
    return out


def test_neighbours_of_odd_rows_are_exact_where_one_partition_holds_all(spark):
    rng = random.Random(7)
    rows = [(k, [rng.gauss(0, 1) for _ in range(4)]) for k in range(120)]
    rows += [(200 + k, [1.0, 2.0, 0.5, -1.0]) for k in range(70)]          # a hot vector, with queries among its copies
    rows += [(300, [0.0] * 4), (301, None), (302, []), (303, [1.0, None, 2.0, 3.0]), (304, [1.0, float("nan"), 0.0, 0.0]),
             (350, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 2.0, 0.5, -1.0]), (5, rows[5][1]), (400, [1e-200, 2e-200, 0.0, 0.0])]
    df = with_clashes(spark, rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, "id % 50 = 0").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute([r for r in rows if r[0] != 400])
    extra = [(i, v) for i, v in rows if i == 400]
    assert set(got) == set(want) | {400} and len(extra) == 1
    for q, near in brute([r if r[0] != 400 else (400, [1.0, 2.0, 0.0, 0.0]) for r in rows]).items():
        found = sorted(got[q])
        assert [v for _, v, _ in found] == [j for _, j in near], q
        assert [n for n, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s + d) < 1e-9 for (_, _, s), (d, _) in zip(found, near, strict=True))


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, "id % 50 = 0").collect()]
    assert sorted(got) == [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest(df.limit(0), "id % 50 = 0").count() == 0
    assert ann.nearest(df.limit(1), "id % 50 = 0").count() == 0


@pytest.mark.parametrize("parts", [2, 8, 32])
def test_partitions_are_balanced_and_cut_few_edges(parts):
    rng = np.random.default_rng(1)
    x = ann.unit(np.repeat(rng.standard_normal((40, 16)), 30, axis=0) + 0.3 * rng.standard_normal((1200, 16)))
    near = ann.neighbour_graph(x, 10)
    part = ann.balanced_partition(near, parts)
    sizes = np.bincount(part, minlength=parts)
    assert sizes.max() - sizes.min() <= np.log2(parts)
    assert (part[near] == part[:, None]).mean() > 1.5 / parts


def test_recall_with_several_partitions(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 64)
    monkeypatch.setattr(ann, "BLOCK", 50)
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((60, 16)), 25, axis=0) + 0.4 * rng.standard_normal((1500, 16))
    x[700:1200] = x[700]                                                    # a third of all rows are equal
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    router = ann.learn(np.unique(x, axis=0), 1001)
    assert router.probes < router.output.shape[1]
    got = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), "id % 50 = 0").collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    want = brute(rows)
    assert all(len(v) == 5 for v in got.values()) and set(got) == set(want)
    hits = sum(sum(s >= -near[-1][0] - 1e-9 for s in got[q]) for q, near in want.items())
    assert hits >= 0.9 * 5 * len(want)


def test_whole_table_recall(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {}
    for r in queries.QUERIES["op1_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows)
    assert sum(len(got[q] & {j for _, j in near}) for q, near in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_scorers_keep_rows_in_order():
    model = toxicity.Model({"scoundrel": 6.0}, {}, frozenset(), np.array([-4.0, 1.0, 0.5, 0.3, 0.5]))
    column = pa.array(["scoundrel" if k % 7 == 0 else "x" for k in range(2500)])
    scores = next(iter(toxicity._scorer(model)(iter([column])))).to_numpy()
    assert ((scores > 0.5) == (np.arange(2500) % 7 == 0)).all()
