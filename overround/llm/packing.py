"""Bounded-space online packing of tokenised documents into sequences of equal length.

Each partition keeps a fixed number of open windows. A document's remainder (its whole windows are sequences of their
own) goes into the open window with the least room that holds it. When none does and all windows are open, the fullest
is emitted and a new one opened. What is open at the end is merged across partitions, in rounds of groups of a fixed
number of partitions, each of which passes on a bounded number of its emptiest windows.
"""

from __future__ import annotations

import os
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from overround.llm.chunks import Remembered
from overround.llm.shared import text_slices, written

LENGTH, END = 4096, 2
#: Open windows of a partition; groups merged at once; bytes of the words that a task remembers; slices of text.
OPEN, GROUPS, REMEMBERED, SLICE = 64, 16, 128 << 20, 4 << 20
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"
_SCHEMA = pa.schema([(c.split()[0], pa.int64()) for c in PIECE.split(", ")] + [("part", pa.int64()), ("done", pa.bool_())])
#: (doc_id, start, length, ids_crc32, doc_tokens)
Piece = tuple[int | None, int, int, int, int]


_WHITE = " \t\n\v\f\r"
#: Classes of bytes: white space, ASCII marks but those that end a special token, ASCII letters, any other.
_SPACE, _MARK, _LETTER = 1, 2, 3
_CLASS = np.array([_SPACE if chr(c) in _WHITE else _LETTER if bytes([c]).isalpha() else
                   _MARK if chr(c) in string.punctuation and chr(c) not in "|>" else 0 for c in range(256)], np.uint8)


def _words(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of texts begin, each with the white space before it; ``begins`` has each text's first byte.

    White space stands at each text's start. Marks that end a word behind a letter (of ASCII or Latin-1) are a word of
    their own, as no run of the vocabulary's pattern goes on behind a letter with anything but letters.
    """
    kind = _CLASS[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] == _SPACE) & (kind[:-1] != _SPACE)
    marks = np.flatnonzero(kind == _MARK)
    if len(marks):
        new = np.diff(marks) != 1
        first, last = marks[np.append(True, new)], marks[np.append(new, True)]
        before = data[first - 1]
        letter = (kind[first - 1] == _LETTER) | (data[first - 2] == 0xC3) & (before != 0x97) & (before != 0xB7)
        cut[first[letter & ((last + 1 == len(data)) | (kind[(last + 1) % len(data)] == _SPACE))]] = True
    cut[begins] = True
    return np.flatnonzero(cut)


class WordTokens:
    """Ids of whole texts, put together from those of their words.

    The vocabulary drops white space and lower-cases, so words parted by ASCII white space are tokenised apart from
    each other anyway. Arrow numbers the words of many texts; each different one is looked up once, and the ids are
    put together by number. ASCII capitals are lowered first, which joins more words, unless a text holds combining
    marks (whose composition depends on case) or might spell a special token.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # For lower-case Latin letters alone: nothing to normalise, no runs to find, and words come once, so no cache.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known = Remembered(REMEMBERED, 3)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # whether an id ends a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, new: set[bytes]) -> None:
        """Remember the ids of new words, which may have white space before them."""
        single, names, other = [], [], []
        for raw in new:
            word = raw.decode().strip(_WHITE)
            if word.isalpha() and (word.isascii() or max(word) < "\u0250") and word == word.lower():
                single.append(word)
                names.append(raw)
            else:
                other.append(raw)
        # These are one run each, whose last id ends a word: many are encoded at once.
        for k in range(0, len(single), 512 * 64):
            part = single[k : k + 512 * 64]
            joined = [" ".join(part[i : i + 512]) for i in range(0, len(part), 512)]
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self.plain.encode_batch_fast(joined, add_special_tokens=False)])
            stops = 4 * (np.flatnonzero(self.last[ids]) + 1)
            raw, starts = ids.tobytes(), [0, *stops[:-1].tolist()]
            for name, a, z in zip(names[k : k + 512 * 64], starts, stops.tolist(), strict=True):
                self.known[name] = raw[a:z]
        encoded = self.tokenizer.encode_batch_fast([raw.decode().strip(_WHITE) for raw in other], add_special_tokens=False)
        for name, e in zip(other, encoded, strict=True):
            self.known[name] = np.array(e.ids, "<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not texts:
            return []
        parts = []
        for text in texts:
            raw = (text or "").encode()
            parts.append(raw if b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw else raw.lower())
        data = b" ".join([b"", *parts])
        begins = np.cumsum([0, *(len(raw) + 1 for raw in parts[:-1])])
        starts = _words(np.frombuffer(data, np.uint8), begins)
        offsets = np.append(starts, len(data))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        words = words.dictionary_encode()
        _, places, raw = words.dictionary.buffers()
        places, raw = np.frombuffer(places, np.int64, len(words.dictionary) + 1).tolist(), raw.to_pybytes()
        distinct = [raw[a:z] for a, z in zip(places[:-1], places[1:], strict=True)]
        found = list(map(self.known.get, distinct))
        if unknown := [k for k, ids in enumerate(found) if ids is None]:
            self._learn(self.known.missing({distinct[k] for k in unknown}))
            for k in unknown:
                found[k] = self.known[distinct[k]]
        ids = np.frombuffer(b"".join(found), "<u4")
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        number = words.indices.to_numpy()
        length = counts[number]
        ends = np.cumsum(length)
        index = np.repeat((np.cumsum(counts) - counts)[number] - (ends - length), length)
        index += np.arange(len(index))
        out = ids[index].tobytes()
        at = np.append(0, ends)[np.searchsorted(starts, np.append(begins, len(data)))] * 4
        return [out[a:z] for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The worker's tokeniser for a file, which serves all its tasks; words are remembered within a task."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = WordTokens(path)
    return _loaded[path]


class OpenWindows:
    """Windows that still take pieces, by the room they have left."""

    def __init__(self, length: int, limit: int | None) -> None:
        self.length, self.limit, self.rooms, self.pieces, self.next = length, limit, [], {}, 0

    def put(self, piece: Piece) -> list[Piece] | None:
        """Place a piece best-fit; returns the pieces of a window that this fills or drives out."""
        out, size = None, piece[2]
        at = bisect_left(self.rooms, (size, -1))
        if at == len(self.rooms):
            if self.limit and len(self.rooms) >= self.limit:
                out = self.pieces.pop(self.rooms.pop(0)[1])
            room, window = self.length, self.next
            self.next += 1
            self.pieces[window] = []
        else:
            room, window = self.rooms.pop(at)
        self.pieces[window].append(piece)
        if room > size:
            insort(self.rooms, (room - size, window))
            return out
        return self.pieces.pop(window)  # a window that is new and full at once drives out none: sizes are below length

    def rest(self) -> list[list[Piece]]:
        """Open windows, the fullest first."""
        return [self.pieces[w] for _, w in self.rooms]


def _rows(windows: list[tuple[list[Piece], int]], length: int, part: int, done: bool) -> Iterator[pa.RecordBatch]:
    """A row for each piece of (window, sequence id)."""
    columns: list[list] = [[] for _ in _SCHEMA]
    for pieces, sequence in windows:
        at, used = 0, sum(p[2] for p in pieces)
        for p in pieces:
            for column, value in zip(columns, (*p, sequence, at, used if used & (used - 1) == 0 else length, part, done), strict=True):
                column.append(value)
            at += p[2]
    if columns[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _pack(path: str, length: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, last = word_tokens(path), end.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        windows, sequence = OpenWindows(length, OPEN), part << 32
        try:
            for batch in text_slices(batches, 1, SLICE):
                out: list[tuple[list[Piece], int]] = []
                for doc, ids in zip(batch.column(0).to_pylist(), tokens(batch.column(1).to_pylist()), strict=True):
                    ids += last
                    count = len(ids) // 4
                    for start in range(0, count, length):
                        size = min(length, count - start)
                        piece = (doc, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), count)
                        full = [piece] if size == length else windows.put(piece)
                        if full:
                            out.append((full, sequence))
                            sequence += 1
                yield from _rows(out, length, part, True)
        finally:  # what later tasks of the worker do has the memory
            tokens.known.forget()
        yield from _rows([(w, sequence + k) for k, w in enumerate(windows.rest())], length, part, False)

    return rows


def _merge(level: int, length: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Best-fit of a group's pieces, the longest first. All but the OPEN emptiest windows are done, or all in the end."""

    def close(group: int, pieces: list[Piece]) -> Iterator[pa.RecordBatch]:
        windows, full = OpenWindows(length, None), []
        for piece in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1])):
            if done := windows.put(piece):
                full.append(done)
        rest = windows.rest()
        keep = len(rest) if last else max(0, len(rest) - OPEN)
        sequence = (level << 59) | (group << 32)
        done = [*full, *rest[:keep]]
        yield from _rows([(w, sequence + k) for k, w in enumerate(done)], length, group, True)
        yield from _rows([(w, sequence + len(done) + k) for k, w in enumerate(rest[keep:])], length, group, False)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pieces = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            for g, *piece in zip(*columns, strict=True):
                if g != group and pieces:
                    yield from close(group, pieces)
                    pieces = []
                group = g
                pieces.append(tuple(piece))
        if pieces:
            yield from close(group, pieces)

    return rows


def pack(documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, end_id: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length.

    A document is the ids of its whole text and then ``end_id``; pieces hold each id once. Only documents longer than
    a sequence are cut. ``sequence_length`` is the sequence's length after padding: ``length``, or what it holds where
    that is a power of two. A null or empty text is ``end_id`` alone; null ids and repeated rows are packed like any
    others; other columns are ignored, whatever their names; an empty table gives an empty result. Sequence ids are
    unique, not consecutive.
    """
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"{PIECE}, part long, done boolean"
    rows = written(texts.mapInArrow(_pack(tokenizer_path, length, end_id), schema), "packed")
    out, open_rows, level = rows.where("done"), rows.where("not done"), 0
    while True:
        parts = open_rows.agg(F.max("part")).first()[0]
        if parts is None or level and parts == 0:
            break
        level += 1
        groups = parts // GROUPS + 1
        dealt = open_rows.select((F.col("part") / GROUPS).cast("long").alias("part"), "doc_id", "start", "length",
                                 "ids_crc32", "doc_tokens")
        merged = dealt.repartition(groups, "part").sortWithinPartitions("part").mapInArrow(
            _merge(level, length, groups == 1), schema)
        merged = written(merged, "merged")
        out, open_rows = out.union(merged.where("done")), merged.where("not done")
    return out.drop("part", "done")
