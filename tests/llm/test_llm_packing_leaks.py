"""Packing round trips, benchmark leaks against edit distances, and the pipeline's stages."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from overround.llm import decontaminate, packing, queries, substring
from tests.llm.conftest import SF, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]


def check_packing(rows, docs, length):
    """Every id of every document in exactly one piece; sequences gapless from 0 and within their length."""
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(by) == set(docs)
    for doc, pieces in by.items():
        ids, at = docs[doc], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at:at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length and {r["sequence_length"] for r in pieces} == {at if at & (at - 1) == 0 else length}
        padding += pieces[0]["sequence_length"] - at
    return padding / max(1, sum(map(len, docs.values())))


def test_words_give_the_ids_of_whole_texts():
    rng = random.Random(1)
    texts = ["a b", "İstanbul ǅ ǰ, H̱ ẖ.", "don't it's 's x's, y'll.", "x<|endoftext|>y <|startoftext|> <|ENDOFTEXT|>", "",
             " \n", "a\x1cb", "Σ ΑΣ. Σ, ...,. a., b.. .a ,", "1.5, 3. ４. Ⅷ. ﬀ.", "日本. क़़. ½.", None]
    texts += ["".join(rng.choice("aB é.,'<|>1́Ḁ \n\tsİ") for _ in range(40)) for _ in range(300)]
    got = packing.WordTokens(PATH)(texts)
    assert got == [x[:-1].tobytes() for x in ids_of(texts)]


@pytest.mark.parametrize("length", [16, 64, 4096])
def test_packing_round_trip(spark, length):
    rng = random.Random(length)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "xyzzy"]) for _ in range(rng.randrange(0, 90))) for _ in range(300)]
    texts += [None, "", "word " * 9000]
    rows = [(k, t) for k, t in enumerate(texts)]
    docs = with_clashes(spark, rows, "doc_id long, text string").repartition(7)
    out = packing.pack(docs, PATH, length=length).collect()
    assert check_packing(out, dict(zip(range(len(texts)), ids_of(texts), strict=True)), length) < 0.12


def test_leftovers_merge_over_many_partitions(spark):
    rows = [(k, "the cat sat " * (k % 40)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(70, "doc_id")
    out = packing.pack(docs, PATH).collect()
    assert check_packing(out, dict(zip(range(400), ids_of(t for _, t in rows), strict=True)), 4096) < 0.25
    assert {r["sequence_id"] >> 59 for r in out} >= {1, 2}


def test_packing_of_repeated_null_and_no_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    out = packing.pack(docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in out) == [(0, 2), (1, 3), (1, 3)]
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == 3
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_windows_are_best_fit_and_bounded():
    windows = packing.OpenWindows(10, 2)
    pieces = [(k, 0, size, 0, size) for k, size in enumerate([6, 7, 3, 4, 8, 5])]
    out = [windows.put(p) for p in pieces]
    assert [None if o is None else [p[2] for p in o] for o in out] == [None, None, [7, 3], [6, 4], None, None]
    assert [p[2] for p in windows.put((9, 0, 6, 0, 6))] == [8]


def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (c != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def changed(rng, text, count):
    out = bytearray(text)
    for _ in range(count):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(b"abcdefgh ")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice(b"abcdefgh "))
    return bytes(out)


def test_leaks_are_those_within_the_edit_budget(spark):
    rng = random.Random(4)
    items = [(r["item_id"], decontaminate.normal(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hosts = [decontaminate.normal(r["text"])[:300] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()]
    items += [(900, b"ten bytes!"), (901, b"short"), (902, b"abababababababababababababab")]
    index = decontaminate.build_index(items)
    texts = []
    for _ in range(40):
        item = rng.choice(items)[1]
        host, k = rng.choice(hosts), decontaminate.budget(len(item))
        at = rng.choice([0, len(host) // 2, len(host)])
        texts.append(host[:at] + changed(rng, item, rng.choice([0, 1, max(k, 0), max(k, 0) + 2])) + host[at:])
    found = decontaminate.find_hits(texts, index)
    for text, hits in zip(texts, found, strict=True):
        for number, item in items:
            k = decontaminate.budget(len(item))
            own = [h for h in hits if h[0] == number]
            true = edits(item, text) if len(item) >= decontaminate.Q else 99
            assert bool(own) == (true <= k), (number, true, k)
            for _, a, z, e in own:
                assert e <= k and edits(item, text[a:z]) == e
    assert decontaminate.find_hits([b"", b"x"], index) == [[], []] and decontaminate.find_hits([b"abc"], decontaminate.build_index([])) == [[]]


def test_leaks_of_odd_rows_and_in_blocks(spark, monkeypatch):
    item = "What is the name of the longest river that flows through the plain"
    docs = with_clashes(spark, [(1, f"x {item.upper()}\n y"), (2, None), (3, ""), (None, item.replace(" ", "\n")), (5, "clean text"),
                                (1, f"{item} {item}"), (6, "z " * 200000 + item[:-1] + "s")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, ""), (4, "another question entirely")], "item_id long, text string")
    out = decontaminate.mark_leaks(docs, marks)
    assert set(docs.columns) < set(out.columns)
    got = [(r["doc_id"], len(r["leaks"])) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([(1, 1), (2, 0), (3, 0), (None, 1), (5, 0), (1, 2), (6, 1)], key=repr)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20)
    again = [(r["doc_id"], len(r["leaks"])) for r in decontaminate.mark_leaks(docs, marks).collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr)
    assert decontaminate.mark_leaks(docs, marks.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert decontaminate.mark_leaks(docs.limit(0), marks).count() == 0


def test_query_finds_every_exact_passage(spark):
    sf = "/root/testdata/sf0.01"
    items = [(r["item_id"], decontaminate.normal(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], decontaminate.normal(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: set(r["item_ids"]) for r in queries.QUERIES["op10_decontaminate"](spark, sf).collect()}
    want = {d: {i for i, x in items if x in t} for d, t in docs}
    assert any(want.values()) and all(want[d] <= got[d] for d in want)
    assert sum(bool(got[d]) and not want[d] for d in want) <= 0.01 * len(want)


def test_stages_keep_columns_and_take_effect(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0), (None, "free text", "en", "s", 9)], documents.schema)
    docs, counts = with_clashes_of(documents.union(odd)), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert docs.columns[:5] == documents.columns and "node" in docs.columns
        counts[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        assert {-1, -2, None} <= set(counts[name])
    stages = list(counts.values())
    assert all(set(b) <= set(a) for a, b in zip(stages, stages[1:], strict=False))
    kept = counts["near_duplicates"]
    words = sorted((d, t) for d, t in kept.items() if d is not None and t)
    seen = set()
    for d, t in words:
        w = t.encode().split()
        keys = [tuple(w[i:i + 20]) for i in range(len(w) - 19)]
        assert (len(set(keys)) == len(keys) and not seen & set(keys)) == (counts["substring"][d] == t)
        seen |= set(keys)
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in decontaminate.normal(t) for t in counts["decontamination"].values() for i in items)
    packed = corpus_pipeline.packing_stage(spark, docs, SF).collect()
    last = counts["decontamination"]
    check_packing(packed, dict(zip(last, ids_of(last.values()), strict=True)), 4096)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert corpus_pipeline.written(stage(spark, empty, SF), name).count() == 0


def with_clashes_of(df):
    return df.select("*", F.lit(1).alias("node"), F.lit("x").alias("id"), F.lit(2).alias("dedup"), F.lit(3).alias("leaks"))


def test_run_gives_pieces_of_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.where("length < 1 or length > 4096").count() == 0 and rows.count() > 0
    assert substring.WINDOW == 20


def test_words_that_end_in_marks_are_looked_up_without_them():
    texts = ["word word. word, word!! word*** (word) été été. été; naïve--", "word?\tword.\nword\rword", "x|> y> é× é÷. a's' a'.",
             "<|endoftext|>. b<|endoftext|> c<|x|>", "  lead", "trail  ", ". .. a.b. 1. 2!", "ｗｏｒｄ. ß. ĳ. ŉ. ſ. ª."]
    rng = random.Random(7)
    texts += ["".join(rng.choice("aBéÉ÷ı.,;-'\"<|>≠́ \n\t1ß") for _ in range(50)) for _ in range(500)]
    words = packing.WordTokens(PATH)
    assert words(texts) == [x[:-1].tobytes() for x in ids_of(texts)]
    assert [words([t])[0] for t in texts] == [x[:-1].tobytes() for x in ids_of(texts)]
    words = packing.WordTokens(PATH)
    words(["abc abc. abc!! abc*** abc, abc\n"])
    assert sum(b"abc" in w for w in words.known) == 1
    assert words([]) == [] and words([None, ""]) == [b"", b""]


def test_words_are_forgotten_when_a_task_ends(monkeypatch):
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words here", "and more"]})
    rows = packing._pack(PATH, 64, 2)(iter([batch]))
    assert sum(r.num_rows for r in rows) == 2
    words = packing.word_tokens(PATH)
    assert not words.known and not words.known.aside and not words.known.size
