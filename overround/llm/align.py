"""Alignment of the tokens of two vocabularies, a byte-level one (A) and one of pieces (B), over the same texts.

Both tokenisers say which stretch of the text a token is from: the byte-level one in characters, the one of pieces in
bytes of its proto. These spans are coarse cuts: where a character is dealt over several tokens, every one of them names
the whole character, or the last one only. There the decoded bytes of the tokens (a byte-level token's characters, a
fallback token's one byte) give the exact ends.

Byte offsets where tokens of A and B both end cut a text into groups; within a group the tokens whose bytes overlap are
linked. What links are worth is known only from the whole corpus: how many documents hold a pair of ids linked. Texts
go through in slices. A slice leaves one row: its documents' links as numbers of the slice's distinct pairs, and those
pairs with the number of its documents that hold them. The pairs are summed up by id over all slices, and each slice
gets back the totals of its own pairs, so that no row travels for an occurrence and no table of pairs is held anywhere.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from overround.llm.bpe import byte_characters
from overround.llm.chunks import Remembered, chunks
from overround.llm.shared import text_slices, written

#: Texts of a slice; bytes of known chunks that a worker keeps.
SLICE, REMEMBERED = 3 << 20, 96 << 20
_CODEC = pa.Codec("zstd", 3)
_MARK = "▁"
#: Chunks that are encoded as one text; chunks that are aligned at once.
JOINED, TOGETHER = 64, 1 << 14
#: n_a, n_b, n_groups of a chunk, its links as (id of A << 32 | id of B), its groups as text with a ``;`` behind each.
Chunk = tuple[int, int, int, bytes, str]


class Aligner:
    """Groups and links of texts, put together from those of their chunks."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        to_byte, vocabulary = byte_characters(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(to_byte.get(c, 63) for c in token)
        ids_b = range(self.b.get_piece_size())
        self.fallback = np.array([self.b.is_byte(i) for i in ids_b])
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.fallback[i] else
                        self.b.id_to_piece(i).replace(_MARK, " ").encode() for i in ids_b]
        self.size_a, self.size_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # Text of an id with what may stand behind it in a group.
        self.text_a = np.array([[f"{i},", f"{i}|"] for i in range(len(self.bytes_a))], object)
        self.text_b = np.array([[f"{i},", f"{i};"] for i in ids_b], object)
        self.known = Remembered(REMEMBERED, 6)

    def _tokens(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends of the tokens of A and B over all lines (each with the space before it); None if the
        tokens don't give the lines again."""
        spaced = [" " + line for line in lines]
        raws = [s.encode() for s in spaced]
        ids_a, ids_b, ends_a, ends_b, base = [], [], [], [], 0
        encodings = self.a.encode_batch(spaced, add_special_tokens=False)
        protos = self.b.encode(lines, return_type="proto", num_threads=1)
        for text, raw, encoding, proto in zip(spaced, raws, encodings, protos, strict=True):
            own_a, own_b = encoding.ids, [p.id for p in proto.pieces]
            ends, stops = [stop for _, stop in encoding.offsets], [p.end for p in proto.pieces]
            if len(raw) == len(text):
                ends, stops = np.array(ends, np.int64), np.array(stops, np.int64) + 1
            else:  # characters of several bytes, whose tokens may share them
                starts = np.array([start for start, _ in encoding.offsets], np.int64)
                code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                at = np.append(0, np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)))
                shared = np.append(starts[1:] < ends[:-1], False)
                ends = np.where(shared, np.cumsum(self.size_a[own_a]), at[ends])
                stops = np.where(self.fallback[own_b], np.cumsum(self.size_b[own_b]), np.array(stops) + 1)
            ids_a += own_a
            ids_b += own_b
            ends_a.append(ends + base)
            ends_b.append(stops + base)
            base += len(raw)
        all_a, all_b, whole = np.array(ids_a, np.int64), np.array(ids_b, np.int64), b"".join(raws)
        given = (b"".join([self.bytes_a[i] for i in ids_a]), b"".join([self.bytes_b[i] for i in ids_b]))
        return (all_a, np.concatenate(ends_a), all_b, np.concatenate(ends_b)) if given == (whole, whole) else None

    def _aligned(self, lines: list[str], sizes: list[int]) -> list[Chunk] | None:
        """The chunks of some lines, whose bytes (with the space before each) are ``sizes``; None if a chunk's end is
        no end of tokens on both sides, or the lines aren't given again."""
        tokens = self._tokens(lines)
        if tokens is None:
            return None
        ids_a, ends_a, ids_b, ends_b = tokens
        both, chunk_ends = np.intersect1d(ends_a, ends_b, assume_unique=True), np.cumsum(sizes)
        if not np.isin(chunk_ends, both).all():
            return None
        first = np.searchsorted(ends_b, ends_a - self.size_a[ids_a], "right")
        owner, place = _spread(np.searchsorted(ends_b, ends_a) - first + 1)
        links = ids_a[owner] << 32 | ids_b[first[owner] + place]
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        texts = np.concatenate([self.text_a[ids_a, (ends_a == both[group_a]).astype(int)],
                                self.text_b[ids_b, (ends_b == both[group_b]).astype(int)]])
        texts = texts[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")].tolist()
        raw = links.tobytes()
        a, b, g = (np.searchsorted(x, chunk_ends, "right") for x in (ends_a, ends_b, both))
        n_a, n_b, n_g = (np.diff(x, prepend=0).tolist() for x in (a, b, g))
        t, k = (a + b).tolist(), (8 * np.searchsorted(owner, a)).tolist()
        return [(x, y, z, raw[k0:k1], "".join(texts[t0:t1])) for x, y, z, k0, k1, t0, t1 in
                zip(n_a, n_b, n_g, [0, *k[:-1]], k, [0, *t[:-1]], t, strict=True)]

    def _learn(self, new: set[str]) -> None:
        """Align new chunks, many as one text where they part again at the spaces between them."""
        plain = [c for c in new if not c[0].isspace() and c[-1] != " " and _MARK not in c]
        alone = list(new.difference(plain))
        plain.sort(key=str.isascii)  # in texts of one byte for each character, spans need no refining
        for k in range(0, len(plain), TOGETHER):
            part = plain[k : k + TOGETHER]
            lines = [" ".join(part[i : i + JOINED]) for i in range(0, len(part), JOINED)]
            found = self._aligned(lines, [len(c.encode()) + 1 for c in part])
            if found is None:
                alone += part
            else:
                self.known.update(zip(part, found, strict=True))
        for chunk in alone:
            found = self._aligned([chunk], [len(chunk.encode()) + 1])
            self.known[chunk] = found[0] if found else None

    def __call__(self, texts: list[str | None]) -> tuple[list[np.ndarray | None], list[Chunk]]:
        """For each text the numbers of its chunks (None: it has no tokens), and the chunks."""
        split = [chunks(t) if t else None for t in texts]
        number: dict[str, int] = {}
        numbers = [np.array([number.setdefault(c, len(number)) for c in s], np.int64) if s else None for s in split]
        self._learn(self.known.missing(set(number)))
        found = [self.known[c] for c in number]
        odd = np.array([c is None for c in found], bool)
        none: Chunk = (0, 0, 0, b"", "")
        return ([None if n is None or odd[n].any() else n for n in numbers], [c or none for c in found])


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The worker's aligner, which serves all its tasks."""
    if (byte_path, piece_path) not in _loaded:
        _loaded.clear()
        _loaded[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _loaded[byte_path, piece_path]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of these lengths: the range of each element, and its place there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _slice_links(numbers: list[np.ndarray | None], found: list[Chunk]) -> tuple[np.ndarray, ...]:
    """(pairs, documents that hold each; for each document and pair of it: document, number of the pair, occurrences)."""
    lengths = np.array([len(c[3]) // 8 for c in found], np.int64)
    pairs, of_link = np.unique(np.frombuffer(b"".join(c[3] for c in found), np.int64), return_inverse=True)
    begin = np.cumsum(lengths) - lengths
    count = np.array([0 if n is None else len(n) for n in numbers], np.int64)
    some = [n for n in numbers if n is not None]
    flat = np.concatenate(some) if some else np.zeros(0, np.int64)
    held, times = np.unique(np.repeat(np.arange(len(numbers)), count) * max(1, len(found)) + flat, return_counts=True)
    document, chunk = np.divmod(held, max(1, len(found)))
    owner, place = _spread(lengths[chunk])
    key = document[owner] * max(1, len(pairs)) + of_link[begin[chunk][owner] + place]
    order = np.argsort(key, kind="stable")
    key, weight = key[order], times[owner][order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    occurrences = np.add.reduceat(weight, first) if len(first) else first
    document, pair = np.divmod(key[first], max(1, len(pairs)))
    # Chunks of texts without tokens bring pairs that no document holds; they go.
    holders = np.bincount(pair, minlength=len(pairs))
    renamed = np.cumsum(holders > 0) - 1
    return pairs[holders > 0], holders[holders > 0], document, renamed[pair], occurrences


def _pack(*arrays: np.ndarray) -> tuple[int, bytes]:
    raw = b"".join([np.array([len(a) for a in arrays], np.int64).tobytes(), *(a.tobytes() for a in arrays)])
    return len(raw), _CODEC.compress(raw, asbytes=True)


def _unpack(size: int, payload: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw = _CODEC.decompress(payload, size, asbytes=True)
    at, out = 8 * len(kinds), []
    for n, kind in zip(np.frombuffer(raw, np.int64, len(kinds)).tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def _slices(byte_path: str, piece_path: str, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["slice", "documents", "size", "payload", "pair", "holders"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, number = aligner(byte_path, piece_path), TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, 1, SLICE):
            numbers, found = align(batch.column(1).to_pylist())
            pairs, holders, document, pair, times = _slice_links(numbers, found)
            sums = np.array([c[:3] + (len(c[3]) // 8,) for c in found], np.int64).reshape(-1, 4)
            totals = [np.zeros(4, np.int64).tolist() if n is None else sums[n].sum(axis=0).tolist() for n in numbers]
            texts = [c[4] for c in found]
            groups = ["" if n is None else "".join([texts[k] for k in n.tolist()])[:-1] for n in numbers]
            if not whole:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            size, payload = _pack(np.bincount(document, minlength=len(numbers)).astype("<i4"), pair.astype("<i4"), times.astype("<i4"))
            columns = [pa.array([t[k] for t in totals], pa.int64()) for k in range(4)]
            per_document = pa.StructArray.from_arrays([batch.column(0), *columns, pa.array(groups, pa.string())],
                                                      ["id", "n_a", "n_b", "n_groups", "n_links", "groups"])
            one = [0, len(numbers)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array(one, pa.int32()), per_document),
                 pa.array([size], pa.int64()), pa.array([payload], pa.binary()),
                 *(pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(x, pa.int64())) for x in (pairs, holders))], names)
            number += 1

    return rows


def _worth(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                documents = batch.column(0).slice(k, 1).flatten()
                held, pair, times = _unpack(batch.column(1)[k].as_py(), batch.column(2)[k].as_py(), ("<i4", "<i4", "<i4"))
                totals = batch.column(3).slice(k, 1).flatten()
                place, total, best = (x.to_numpy(zero_copy_only=False) for x in totals.flatten())
                count, is_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                count[place], is_best[place] = total, best
                owner = np.repeat(np.arange(len(held)), held)
                sums = []
                for worth in (is_best, count):
                    out = np.zeros(len(held), np.int64)
                    np.add.at(out, owner, times.astype(np.int64) * worth[pair])
                    sums.append(pa.array(out))
                columns = documents.flatten()
                yield pa.RecordBatch.from_arrays([*columns[:5], *sums, columns[5]], names)

    return rows


def align_tokens(documents: DataFrame, byte_path: str, piece_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 groups_as: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) for every row of ``documents``.

    A encodes a space and the text, B the text, before which it puts a space itself; strings of special tokens are
    ordinary text. ``groups`` is ``a1,a2|b1;a3|b2,b3`` (decimal ids of A and B, in order), or its SHA-256 in lowercase
    hex with ``groups_as="sha256"`` (shorter to move). A pair's count is the number of rows that hold it linked;
    ``count_sum`` adds up the counts of all links of a document, ``n_best`` counts the links whose count is the highest
    that their id of A has anywhere. Null and empty texts, and texts that the tokens of A or B don't give again with the
    space before them (a text that holds U+2581, say), have no tokens: zeros and ''. Null ids and repeated rows count
    like any others; very long texts are aligned whole; other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    if groups_as not in ("text", "sha256"):
        raise ValueError(f"unknown form of groups: {groups_as}")
    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    kind = documents.schema[id_col].dataType.simpleString()
    schema = (f"slice long, documents array<struct<id: {kind}, n_a: long, n_b: long, n_groups: long, n_links: long, groups: string>>,"
              " size long, payload binary, pair array<long>, holders array<long>")
    slices = written(documents.select(F.col(id_col), F.col(text_col)).mapInArrow(
        _slices(byte_path, piece_path, groups_as == "text"), schema), "aligned")
    held = slices.select("slice", F.posexplode(F.arrays_zip("pair", "holders")).alias("place", "held"))
    totals = held.groupBy(F.col("held.pair").alias("pair")).agg(F.sum("held.holders").alias("total"))
    totals = totals.withColumn("a", F.shiftright("pair", 32))
    totals = written(totals, "pairs")
    best = totals.groupBy("a").agg(F.max("total").alias("highest"))
    worth = totals.join(best, "a").select("pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    back = held.select("slice", "place", F.col("held.pair").alias("pair")).join(worth, "pair").groupBy("slice").agg(
        F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "total", "best")).alias("totals"))
    none = F.array().cast("array<struct<place: long, total: long, best: long>>")
    joined = slices.select("slice", "documents", "size", "payload").join(back, "slice", "left").select(
        "documents", "size", "payload", F.coalesce("totals", none).alias("totals"))
    return joined.mapInArrow(_worth(names), f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                             "count_sum long, groups string")
