"""Removal of passages that occur before, by super-k-mer partitioning over words.

A window is ``WINDOW`` consecutive words; its minimiser is the smallest hash among its runs of ``GRAM`` words.
Neighbouring windows mostly share a minimiser, so they travel together as one packed string (a super-k-mer of words)
to the minimiser's bucket, instead of as one string for each window. Equal windows have equal minimisers, so a bucket
sees every occurrence of its windows; sorting them there finds the first one of each exactly.

Two things keep buckets even. Equal packed strings are combined before the shuffle: only the first of them is sent,
since the others repeat it as a whole; what they repeat is merged to spans, which are dealt by a hash of document and
place and pass through without being gathered. And where a minimiser's bin holds far more strings than others (the rim
of a passage that a third of all documents share), the windows are dealt by a hash of all their words instead, each on
its own. Both leave the result the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overround.llm.shared import gram_hashes, joined_words, mix, span_hashes, text_slices, word_spans, written

WINDOW, GRAM = 20, 5
#: Minimisers are counted in so many bins, to find hot ones; a run holds so many windows at most; slices of text.
BINS, MAX_RUN, SLICE = 1 << 16, 512, 2 << 20
#: Spans known to repeat that travel as one row, at most.
MAX_KNOWN = 1 << 12
#: Bytes of packed strings in a bucket, before compression.
BUCKET_BYTES = 6 << 20
_CODEC = pa.Codec("zstd", 5)


def _windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts and, for each window, the text it is from, its first word and its minimiser."""
    data, starts, ends, counts = joined_words(texts)
    words = span_hashes(data, starts, ends)
    low = gram_hashes(words, GRAM)
    reach = 1
    while reach < WINDOW - GRAM + 1:  # smallest of `reach` grams, then of twice as many
        step = min(reach, WINDOW - GRAM + 1 - reach)
        low = np.minimum(low[: max(0, len(low) - step)], low[step:])
        reach += step
    number = np.maximum(counts - WINDOW + 1, 0)
    offsets = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(texts)), number)
    first = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(offsets, number)
    return data, starts, ends, text, first, low[first] if len(first) else np.zeros(0, np.uint64)


def _runs(text: np.ndarray, key: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[from, to) of neighbouring windows of one text that share a key; windows marked ``alone`` have their own."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | alone[1:] | alone[:-1]
    begin = np.flatnonzero(new)
    place = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    begin = np.flatnonzero(new | (place % MAX_RUN == 0))
    return begin, np.append(begin[1:], len(key))


def _count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bin, strings, bytes) of a task's super-k-mers."""
    strings, size = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
    for batch in text_slices(batches, 1, SLICE):
        _, starts, ends, text, first, key = _windows(batch.column(1).to_pylist())
        a, b = _runs(text, key, np.zeros(len(key), bool))
        bins = (key[a] % np.uint64(BINS)).astype(np.int64)
        length = ends[first[b - 1] + WINDOW - 1] - starts[first[a]] if len(a) else a
        strings += np.bincount(bins, minlength=BINS)
        size += np.bincount(bins, length, BINS).astype(np.int64)
    some = np.flatnonzero(strings)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, strings[some], size[some])], ["bin", "strings", "bytes"])


def _pack(ids: np.ndarray, first: np.ndarray, lengths: np.ndarray, raw: bytes, known: np.ndarray) -> bytes:
    """A block of packed strings with their documents, first words and word counts, and of known repeats."""
    head = np.array([len(ids), len(known)], np.int64)
    return _CODEC.compress(b"".join([head.tobytes(), ids.tobytes(), first.tobytes(), lengths.tobytes(),
                                     known.tobytes(), raw]), asbytes=True)


def _unpack(payload: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes, np.ndarray]:
    data = _CODEC.decompress(payload, size, asbytes=True)
    n, k = np.frombuffer(data, np.int64, 2)
    numbers = np.frombuffer(data, np.int64, 3 * (n + k), 16)
    return numbers[:n], numbers[n : 2 * n], numbers[2 * n : 3 * n], data[16 + 24 * (n + k):], numbers[3 * n:].reshape(-1, 3)


def _scatter(hot: np.ndarray, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packed strings by bucket: rows (bucket, size, payload); spans known to repeat have negative buckets."""

    none = np.zeros(0, np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1, SLICE):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, starts, ends, text, first, key = _windows(batch.column(1).to_pylist())
            if not len(key):
                continue
            alone = hot[(key % np.uint64(BINS)).astype(np.int64)]
            if alone.any():
                whole = first[alone]
                key[alone] = span_hashes(data, starts[whole], ends[whole + WINDOW - 1])
            a, b = _runs(text, key, alone)
            text_start = np.searchsorted(text, text[a])  # first window of the same text
            lo, hi = starts[first[a]], ends[first[b - 1] + WINDOW - 1]
            doc, at, n_words = ids[text[a]], first[a] - first[text_start], b - a + WINDOW - 1
            send, known = _combined(data, lo, hi, doc, at, n_words)
            bucket = (key[a] // np.uint64(BINS) % np.uint64(buckets)).astype(np.int64)
            send = send[np.argsort(bucket[send], kind="stable")]
            cuts = np.flatnonzero(np.diff(bucket[send])) + 1
            out: list[tuple[int, int, bytes]] = []
            for part in np.split(send, cuts):
                length = hi[part] - lo[part] + 1  # with the space behind it
                index = np.repeat(lo[part] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                size = 16 + 24 * len(part) + len(index)
                out.append((int(bucket[part[0]]), size, _pack(doc[part], at[part], n_words[part], data[index].tobytes(), known[:0])))
            known = _merged(known)
            for k in range(0, len(known), MAX_KNOWN):
                some = known[k : k + MAX_KNOWN]
                place = mix(mix(some[:1, 0].astype(np.uint64)) + some[:1, 1].astype(np.uint64))
                out.append((-1 - int(place[0] % np.uint64(buckets)), 16 + 24 * len(some), _pack(none, none, none, b"", some)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], pa.binary())], ["bucket", "size", "payload"])

    return rows


def _combined(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray, at: np.ndarray,
              n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which strings to send, and (document, from, to) of those that repeat an earlier one of this slice.

    Strings are compared byte by byte, not only by hash.
    """
    prints = span_hashes(data, lo, hi)
    order = np.lexsort((at, doc, prints))
    new = np.ones(len(order), bool)
    new[1:] = prints[order][1:] != prints[order][:-1]
    leader = np.empty(len(order), np.int64)
    leader[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    send = np.ones(len(order), bool)
    raw = data.tobytes() if not new.all() else b""
    for i in order[~new].tolist():
        j = leader[i]
        later = (doc[i], at[i]) != (doc[j], at[j])
        if later and raw[lo[i] : hi[i]] == raw[lo[j] : hi[j]]:
            send[i] = False
    gone = np.flatnonzero(~send)
    return np.flatnonzero(send), np.stack([doc[gone], at[gone], at[gone] + n_words[gone]], axis=1).astype(np.int64)


def _merged(spans: np.ndarray) -> np.ndarray:
    """The same words of each document as spans (document, from, to) that neither overlap nor touch, in order."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    # Places of different documents are moved apart, so that one running maximum serves all.
    number = np.cumsum(np.append(0, spans[1:, 0] != spans[:-1, 0])) * (spans[:, 2].max() + 1)
    reach = np.maximum.accumulate(spans[:, 2] + number)
    new = np.append(True, spans[1:, 1] + number[1:] > reach[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(spans)) - 1
    return np.stack([spans[begin, 0], spans[begin, 1], reach[last] - number[last]], axis=1)


def _repeats(blocks: list[tuple[int, bytes]]) -> np.ndarray:
    """(document, from, to) of the words that a bucket's windows repeat."""
    parts = [_unpack(payload, size) for size, payload in blocks]
    ids, at, n_words = (np.concatenate([p[k] for p in parts]) for k in range(3))
    raw = b"".join(p[3] for p in parts)
    del parts
    data = np.frombuffer(raw, np.uint8)
    starts, ends = word_spans(data)
    prints = gram_hashes(span_hashes(data, starts, ends), WINDOW)
    number = n_words - WINDOW + 1
    string = np.repeat(np.arange(len(ids)), number)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(number) - number, number)
    first = offset + np.repeat(np.cumsum(n_words) - n_words, number)
    prints, doc, begin = prints[first], ids[string], at[string] + offset

    order = np.lexsort((begin, doc, prints))
    new = np.ones(len(order), bool)
    new[1:] = prints[order][1:] != prints[order][:-1]
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]  # first occurrence, for each place in order
    later = ~new & ((doc[order] != doc[head]) | (begin[order] != begin[head]))
    repeated = np.zeros(len(order), bool)
    odd = []
    for i, j in zip(order[later].tolist(), head[later].tolist(), strict=True):
        p, q = first[i], first[j]
        if raw[starts[p] : ends[p + WINDOW - 1]] == raw[starts[q] : ends[q + WINDOW - 1]]:
            repeated[i] = True
        else:
            odd.append(prints[i])
    for value in set(odd):  # windows that differ and yet share a 64-bit hash: compared by their bytes
        seen: dict[bytes, tuple[int, int]] = {}
        for i in order[prints[order] == value].tolist():
            words = raw[starts[first[i]] : ends[first[i] + WINDOW - 1]]
            repeated[i] = seen.setdefault(words, (doc[i], begin[i])) != (doc[i], begin[i])
    # Neighbouring repeated windows of a string cover one span of words.
    edge = np.ones(len(repeated) + 1, bool)
    if len(repeated):
        edge[1:-1] = (repeated[1:] != repeated[:-1]) | (string[1:] != string[:-1])
    cuts = np.flatnonzero(edge)
    a, b = cuts[:-1], cuts[1:]
    a, b = a[repeated[a]], b[repeated[a]]
    return np.stack([doc[a], begin[a], begin[a] + (b - a) + WINDOW - 1], axis=1) if len(a) else np.zeros((0, 3), np.int64)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; one bucket is held at a time, spans known to repeat go straight through."""
    bucket: int | None = None
    blocks: list[tuple[int, bytes]] = []

    def spans(found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(3)], ["id", "start", "stop"])

    for batch in batches:
        for b, size, payload in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if b < 0:
                yield spans(_unpack(payload, size)[4])
                continue
            if b != bucket and blocks:
                yield spans(_repeats(blocks))
                blocks = []
            bucket = b
            blocks.append((size, payload))
    if blocks:
        yield spans(_repeats(blocks))


def repeated_spans(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): for each document with repeated windows, [start, stop) word spans to remove (they may overlap)."""
    spark = documents.sparkSession
    texts = documents.where(F.col(id_col).isNotNull() & (F.length(text_col) >= 2 * WINDOW - 1)).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # BINS rows at most, whatever the size of the corpus.
    counts = texts.mapInArrow(_count_bins, "bin long, strings long, bytes long").groupBy("bin").agg(
        F.sum("strings").alias("strings"), F.sum("bytes").alias("bytes")).collect()
    total, size = sum(r["strings"] for r in counts), sum(r["bytes"] for r in counts)
    hot = np.zeros(BINS, bool)
    hot[[r["bin"] for r in counts if r["strings"] > max(4 * WINDOW, 8 * total / BINS)]] = True
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, math.ceil(size / BUCKET_BYTES))
    blocks = texts.mapInArrow(_scatter(hot, buckets), "bucket long, size long, payload binary")
    spans = blocks.repartition(max(parts, buckets // 8), "bucket").sortWithinPartitions("bucket").mapInArrow(
        _gather, "id long, start long, stop long")
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
    n_words, n_removed, kept = [], [], []
    for text, cuts in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        words = (text or "").encode().split()
        n_words.append(len(words))
        if cuts:
            change = np.zeros(len(words) + 1, np.int64)
            for cut in cuts:
                change[cut["start"]] += 1
                change[cut["stop"]] -= 1
            gone = np.cumsum(change[:-1]) > 0
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words).decode())
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                      ["n_words", "n_removed", "kept_text"])


def remove_repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   out_col: str = "dedup") -> DataFrame:
    """All rows and columns of ``documents``, and ``out_col``: struct(n_words, n_removed, kept_text).

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window that covers it also starts earlier, in a document of
    smaller id or further up in the same one; windows are judged on the input. ``kept_text`` has the kept words,
    parted by one space. Null texts have no words. Rows with a null id are in no order, so they neither lose words nor
    count as earlier. Rows that share an id stand for one document: an occurrence at the same place isn't earlier. Very
    long texts are processed whole; a column named ``out_col`` is replaced, others stay as they are, whatever their
    names; an empty table gives an empty result.
    """
    spans = written(repeated_spans(documents, id_col=id_col, text_col=text_col), "spans")
    cut = F.arrow_udf(_cut, "n_words long, n_removed long, kept_text string")
    rows = documents.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"))
    joined = rows.join(spans, "id", "left").select("row", cut(F.col(f"row.{text_col}"), F.col("spans")).alias("cut"))
    names = [c for c in documents.columns if c != out_col]
    return joined.select(*(F.col("row").getField(c).alias(c) for c in names), F.col("cut").alias(out_col))
