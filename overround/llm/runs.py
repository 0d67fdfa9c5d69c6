"""Periodic runs of words by a dictionary of basic factors.

For each power of two the dictionary names the factors of that length, so that equal factors of one document have equal
names: the name of a factor is made from the names of its two halves. Places whose factor occurs only once in their
document leave the dictionary, so later levels hold repeats alone.

Where a factor's occurrences follow each other at one distance of at most twice its length, they form an arithmetic
progression, and that distance is proposed as a period. In a run of period q and four periods or more, the factors of
the smallest power of two from q on occur again after exactly q words, twice at least, so every run is proposed. The
names then extend each proposal to both sides by binary descent over the levels, and equal runs are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overround.llm.shared import text_slices

#: A run has so many periods at least, and so many words; texts of a slice.
EXPONENT, WORDS, SLICE = 4, 6, 3 << 19
RUNS = "array<struct<start: long, length: long, period: long>>"


def basic_factors(words: np.ndarray, document: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... words at each place; -1 where a factor occurs once in its document.

    ``words`` are numbers of words, ``document`` the number of the document that each stands in. The last level names
    nothing: no factor of its length occurs twice.
    """
    levels = []
    place = np.arange(len(words))
    key = document * (int(words.max(initial=0)) + 1) + words
    while True:
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[name] > 1
        place, name = place[again], name[again]
        level = np.full(len(words), -1, np.int64)
        level[place] = name
        levels.append(level)
        if not len(place):
            return levels
        half = 1 << (len(levels) - 1)
        fits = place + half < len(words)
        place = place[fits]
        first, second = level[place], level[place + half]
        both = second >= 0
        place, key = place[both], first[both] * (int(level.max()) + 1) + second[both]


def proposals(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) where a progression of three occurrences begins; one for each stretch of neighbouring places."""
    places, distances = [], []
    for k, level in enumerate(levels):
        at = np.flatnonzero(level >= 0)
        at = at[np.argsort(level[at], kind="stable")]
        near = np.zeros(len(at), np.int64)
        near[:-1] = np.where(level[at[1:]] == level[at[:-1]], at[1:] - at[:-1], 0)
        # What is at most half as far was proposed a level before.
        steady = (near[:-1] > 0) & (near[:-1] <= 2 << k) & (2 * near[:-1] > 1 << k) & (near[:-1] == near[1:])
        distance = np.zeros(len(level) + 1, np.int64)
        distance[at[:-1][steady] + 1] = near[:-1][steady]
        head = np.flatnonzero((distance[1:] > 0) & (distance[1:] != distance[:-1]))
        places.append(head)
        distances.append(distance[head + 1])
    return np.concatenate(places), np.concatenate(distances)


def extended(levels: list[np.ndarray], place: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, stop) of the words around each place that keep the distance as period."""
    size = len(levels[0])
    right, left = place.copy(), place.copy()
    for k in range(len(levels) - 1, -1, -1):
        level, step = levels[k], 1 << k
        there = right + distance
        name = level[np.minimum(right, size - 1)]
        right += np.where((there + step <= size) & (name >= 0) & (name == level[np.minimum(there, size - 1)]), step, 0)
        before = left - step
        name = level[np.maximum(before, 0)]
        left -= np.where((before >= 0) & (name >= 0) & (name == level[np.minimum(np.maximum(before, 0) + distance, size - 1)]), step, 0)
    return left, right + distance


def find_runs(words: np.ndarray, document: np.ndarray, exponent: int = EXPONENT, least: int = WORDS) -> np.ndarray:
    """(start, length, period) of all runs in order; places count over all documents, no run reaches over two."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    levels = basic_factors(words, document)
    place, period = proposals(levels)
    start, stop = extended(levels, place, period)
    found = np.stack([start, stop - start, period], axis=1)
    found = np.unique(found[found[:, 1] >= np.maximum(least, exponent * period)], axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _numbered(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of the texts, their numbers and counts."""
    split = [(t or "").encode().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    number: dict[bytes, int] = {}
    numbers = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64, int(counts.sum()))
    return split, numbers, counts


def _rows(names: list[str], exponent: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1, SLICE):
            split, numbers, counts = _numbered(batch.column(1).to_pylist())
            begin = np.cumsum(counts) - counts
            document = np.repeat(np.arange(len(counts)), counts)
            found = find_runs(numbers, document, exponent, least)
            owner = document[found[:, 0]]
            change = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(change, found[:, 0] + found[:, 2], 1)
            np.add.at(change, found[:, 0] + found[:, 1], -1)
            gone = np.cumsum(change[:-1]) > 0
            hit = np.zeros(len(counts), bool)
            hit[owner] = True
            kept = []
            for k, words in enumerate(split):
                if hit[k]:
                    words = [w for w, g in zip(words, gone[begin[k] : begin[k] + counts[k]].tolist(), strict=True) if not g]
                kept.append(b" ".join(words).decode())
            offsets = np.searchsorted(owner, np.arange(len(counts) + 1)).astype(np.int32)
            parts = [found[:, 0] - begin[owner], found[:, 1], found[:, 2]]
            runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                [pa.array(p, pa.int64()) for p in parts], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), runs, pa.array(kept, pa.string())], names)

    return rows


def periodic_runs(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
                  least: int = WORDS) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``documents``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of consecutive words with smallest period q, of at least
    ``least`` words and ``exponent`` periods (four or more), that no neighbouring word extends; ``runs`` holds (start,
    length, period) in order of start, then period. ``collapsed`` has the words left, parted by one space, when each
    run keeps its first q words (a word goes if any run drops it). Null and blank texts have no words and no runs.
    Null ids and repeated rows are kept as they come; very long texts are searched whole; other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods aren't all proposed")
    names = [id_col, "n_words", "runs", "collapsed"]
    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(
        _rows(names, exponent, least), f"`{id_col}` {kind}, n_words long, runs {RUNS}, collapsed string")
