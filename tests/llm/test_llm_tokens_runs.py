"""Token alignment, byte-level BPE and periodic runs against plain versions over whole texts."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from overround.llm import align, bpe, chunks, queries, runs
from tests.llm.conftest import SF, with_clashes

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "B", " ", "  ", "\n", " \n", "é", "日本", "😀", "▁", " ", " the", ".", "1", "\t", "\x00", "́", "don't", "<s>",
         "<0x41>", "<|endoftext|>", " ", "\x1c", "ﬀ", "İ", "한", "'s", "aaaa", "---", " "]
ODD = [None, "", " ", "  ", "\n", "a", " a ", "x" * 3000, "日" * 500, "a <|endoftext|> b", "▁ b", " \n".join("ab"), "é" * 7 + " é"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


# Chunks -------------------------------------------------------------------------------------------------------------


def test_chunks_give_the_text_again():
    for text in random_texts(2000) + [t for t in ODD if t]:
        assert " ".join(chunks.chunks(text)) == text


def test_remembered_stays_below_its_limit_and_keeps_what_is_asked_for():
    table = chunks.Remembered(20_000, 1)
    for k in range(200):
        wanted = {"the", *(f"w{k}_{i}" for i in range(10))}
        for key in table.missing(wanted):
            table[key] = key
        assert all(table[w] == w for w in wanted) and len(table) + len(table.aside) < 110
    assert not table.missing({"the"})


# BPE ----------------------------------------------------------------------------------------------------------------


def library_ids(texts):
    tokenizer = Tokenizer.from_file(BYTE)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_those_of_the_library():
    texts = random_texts(3000) + ODD
    got = bpe.Encoder(BYTE)(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)


def test_letters_of_any_kind_part_alike():
    characters = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}a {c} {c}{c}1{c}!  {c}" for c in characters]
    got = bpe.Encoder(BYTE)(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)


def merged(v, raw):
    """The merges of one word, replayed one by one."""
    ids = [next(i for i, t in v.tokens.items() if t == bytes([b])) for b in raw]
    while True:
        found = [(v.merges[pair][0], k) for k, pair in enumerate(zip(ids[:-1], ids[1:], strict=True)) if pair in v.merges]
        if not found:
            return ids
        _, k = min(found)
        ids[k:k + 2] = [v.merges[ids[k], ids[k + 1]][1]]


def test_pairs_are_compatible_where_their_merges_give_them_again():
    encoder, rng = bpe.Encoder(BYTE), random.Random(4)
    v, tokens = encoder.vocabulary, sorted(i for i, t in encoder.vocabulary.tokens.items() if len(t) < 9)
    short = [i for i in tokens if set(v.tokens[i]) <= set(b"aeintr ")]
    for a, b in [(rng.choice(short), rng.choice(short)) for _ in range(300)]:
        assert encoder.compatible(a, b) == (merged(v, v.tokens[a] + v.tokens[b]) == [a, b])


def test_long_words_take_linear_work():
    encoder = bpe.Encoder(BYTE)
    for word in ("a" * 50_000, "ab" * 30_000, "abcdefghij" * 5_000):
        tokens = encoder.word(word.encode())
        assert b"".join(encoder.vocabulary.tokens[i] for i in tokens) == word.encode()
    assert encoder.word(b"a" * 3001) == library_ids(["a" * 3001])[0]


def test_encode_texts_round_trip(spark):
    rows = list(enumerate(ODD + random_texts(200, 2))) + [(3, "again"), (None, "no id")]
    out = bpe.encode_texts(with_clashes(spark, rows, "doc_id long, text string"), BYTE).collect()
    want = library_ids([t for _, t in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"], r["n_tokens"]) for r in out), key=key)
    assert got == sorted(((i, ids, t or "", len(ids)) for (i, t), ids in zip(rows, want, strict=True)), key=key)


def test_decode_of_any_ids(spark):
    v, rng = Tokenizer.from_file(BYTE), random.Random(6)
    ids = [[rng.randrange(50257) for _ in range(rng.randint(0, 9))] for _ in range(300)]
    rows = [(k, bytearray(np.array(x, "<u4").tobytes())) for k, x in enumerate(ids)] + [(-1, None)]
    out = bpe.decode_ids(spark.createDataFrame(rows, "k long, ids binary"), BYTE)
    got = {r["k"]: r["decoded"] for r in out.collect()}
    assert got == {k: v.decode(x, skip_special_tokens=False) for k, x in enumerate(ids)} | {-1: None}


def test_op12_whole_table(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    ids = library_ids([r["text"] for r in rows])
    tokenizer = Tokenizer.from_file(BYTE)
    want = {r["doc_id"]: (len(x), sha(np.array(x, "<u4").tobytes()), sha(tokenizer.decode(x, skip_special_tokens=False)))
            for r, x in zip(rows, ids, strict=True)}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_bpe(spark, SF).collect()}
    assert got == want


def test_op12_empty_table(spark):
    assert bpe.encode_texts(spark.createDataFrame([], "doc_id long, text string"), BYTE).collect() == []


# Alignment ----------------------------------------------------------------------------------------------------------


def plain_alignment(texts):
    """(n_a, n_b, links, groups text) of each text, by byte offsets over whole texts."""
    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    to_byte = bpe.byte_characters()
    bytes_a = {i: bytes(to_byte.get(c, 63) for c in t) for t, i in a.get_vocab().items()}
    out = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(raw.decode(), add_special_tokens=False).ids, b.encode(text or "")
        pieces_a = [bytes_a[i] for i in ids_a]
        pieces_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                    for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not text or b"".join(pieces_a) != raw or b"".join(pieces_b) != raw:
            out.append((0, 0, [], ""))
            continue
        spans = []
        for ids, pieces in ((ids_a, pieces_a), (ids_b, pieces_b)):
            ends = np.cumsum([len(p) for p in pieces]).tolist()
            spans.append([(e - len(p), e, i) for i, p, e in zip(ids, pieces, ends, strict=True)])
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for cut in both:
            groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= cut) for side in spans))
            low = cut
        links, first = [], 0
        for s, e, i in spans[0]:
            while spans[1][first][1] <= s:
                first += 1
            k = first
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        out.append((len(ids_a), len(ids_b), links, ";".join(groups)))
    return out


def plain_results(rows):
    found = plain_alignment([t for _, t in rows])
    holders = Counter(p for _, _, links, _ in found for p in set(links))
    highest = defaultdict(int)
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    return [(i, n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(holders[p] == highest[p[0]] for p in links),
             sum(holders[p] for p in links), groups) for (i, _), (n_a, n_b, links, groups) in zip(rows, found, strict=True)]


def test_alignment_of_odd_texts(spark):
    rows = list(enumerate(ODD + random_texts(400, 3))) + [(5, "again a"), (None, "no id a")]
    df = with_clashes(spark, rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in align.align_tokens(df, BYTE, PIECE).collect()), key=str)
    assert got == sorted(plain_results(rows), key=str)


def test_op11_whole_table(spark, documents, monkeypatch):
    monkeypatch.setattr(align, "SLICE", 1 << 15)
    want = plain_results([tuple(r) for r in documents.select("doc_id", "text").collect()])
    got = {tuple(r) for r in queries.op11_token_alignment(spark, SF).collect()}
    assert got == {(*r[:-1], sha(r[-1]) if r[-1] else "") for r in want}


def test_alignment_of_tables_without_tokens(spark):
    assert align.align_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).collect() == []
    out = align.align_tokens(spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string"), BYTE, PIECE).collect()
    assert sorted(map(tuple, out)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


# Periodic runs ------------------------------------------------------------------------------------------------------


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                w = words[i:i + length]
                if not any(all(w[t] == w[t + p] for t in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def random_words(rng):
    out = []
    while rng.random() < 0.85:
        block = [str(rng.randint(0, rng.choice([0, 1, 5]))) for _ in range(rng.randint(1, 12))]
        out += (block * 9)[:rng.randint(1, 9 * len(block))]
    return out


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(400):
        many = [random_words(rng) for _ in range(rng.randint(1, 4))]
        number = defaultdict(lambda: len(number))
        words = np.array([number[w] for d in many for w in d], np.int64)
        got = runs.find_runs(words, np.repeat(np.arange(len(many)), [len(d) for d in many])).tolist()
        starts = np.cumsum([0] + [len(d) for d in many])
        assert got == [[s + at, n, q] for d, at in zip(many, starts.tolist(), strict=False) for s, n, q in plain_runs(d)]


def test_periodic_runs_of_odd_texts(spark):
    rng = random.Random(8)
    texts = [None, "", " \n", "a", "a a a a a a", "a a a a a", "x y x y x y x y", "é é " * 7, "w " * 30_000,
             *(rng.choice([" ", "\t", "\n "]).join(random_words(rng)) for _ in range(150))]
    rows = list(enumerate(texts)) + [(4, "b " * 9), (None, "c " * 6)]
    out = runs.periodic_runs(with_clashes(spark, rows, "doc_id long, text string")).collect()
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out), key=str)
    want = []
    for i, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        found = [(0, len(words), 1)] if len(words) == 30_000 else plain_runs(words)
        want.append((i, len(words), found, plain_collapsed(words, found)))
    assert got == sorted(want, key=str)
    with pytest.raises(ValueError, match="four periods"):
        runs.periodic_runs(spark.createDataFrame(rows[:1], "doc_id long, text string"), exponent=3)


def moved_words(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n or doc_id is None:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_op13_against_plain_python(spark, documents, tmp_path):
    extra = [(k, t) for k, t in enumerate([None, "", " a ", "q w\te r t  y " * 3, "one two three four five"] * 40, 10**6)]
    rows = [tuple(r) for r in documents.where("n_chars < 4000").select("doc_id", "text").collect()] + extra + [(None, "z " * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    want = set()
    for doc_id, text in rows:
        words = moved_words(doc_id, text)
        found = plain_runs(words)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.add((doc_id, len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(plain_collapsed(words, found))))
    assert got == want


def test_op13_empty_and_whole(spark, documents):
    assert queries.op13_periodic_runs(spark, SF).count() == documents.count()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert runs.periodic_runs(queries.periodic_tails(empty)).collect() == []
    assert "Generate" not in queries.periodic_tails(documents)._jdf.queryExecution().executedPlan().toString()
    assert documents.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0).count() > 0
