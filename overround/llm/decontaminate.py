"""Benchmark decontamination by the q-gram lemma, in diagonal bands, with banded alignment.

Texts and benchmark items are compared in lower case with each run of white space as one space, as UTF-8 bytes. An item
of n bytes leaks into a text if some stretch of it is within k = n * ``EDITS`` edits (insertions, deletions, changes).
Each edit spoils Q of the item's n - Q + 1 q-grams at most, and shifts the diagonal (place in the text less place in
the item) by one at most. So a leak leaves n - Q + 1 - k * Q shared q-grams or more on k + 1 neighbouring diagonals.
Shared q-grams are counted in bands of 2(k + 1) diagonals that overlap by half, which hold any such range as a whole;
regions that reach the bound are aligned within their band, and only those within the budget count.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overround.llm.shared import mix

Q, EDITS = 10, 0.08
_BITS = 22
#: Benchmark bytes that one pass over the documents searches for; a larger benchmark takes several passes.
BLOCK_BYTES = 4 << 20
HIT = "struct<item_id:bigint,start:bigint,stop:bigint,edits:bigint>"


def normal(text: str | None) -> bytes:
    return " ".join((text or "").lower().split()).encode()


def gram_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code for the Q bytes from each place on."""
    count = len(data) - Q + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    code = np.zeros(count, np.uint64)
    for k in range(Q):
        code *= np.uint64(0x9E3779B97F4A7C15)
        code += data[k : k + count]
    return mix(code)


def budget(size: int) -> int:
    """Edits allowed for an item of so many bytes: a share of them, as long as the lemma leaves one q-gram."""
    return min(int(size * EDITS), (size - Q) // Q)


@dataclass
class Index:
    """q-grams of a block of items: a bitmap, the sorted codes, and where each code stands."""

    ids: list[int]
    items: list[bytes]
    edits: np.ndarray
    needed: np.ndarray
    bitmap: np.ndarray
    codes: np.ndarray
    offsets: np.ndarray
    item: np.ndarray
    place: np.ndarray


def build_index(rows: list[tuple[int, bytes]]) -> Index:
    """Items shorter than Q bytes can't be told from chance and aren't searched for."""
    rows = [(i, t) for i, t in rows if len(t) >= Q]
    parts = [gram_codes(np.frombuffer(t, np.uint8)) for _, t in rows]
    code = np.concatenate([*parts, np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    place = np.concatenate([*(np.arange(len(p)) for p in parts), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(code, kind="stable")
    codes, first = np.unique(code[order], return_index=True)
    bitmap = np.zeros(1 << _BITS, bool)
    bitmap[(codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    edits = np.array([budget(len(t)) for _, t in rows], np.int64)
    sizes = np.array([len(t) for _, t in rows], np.int64)
    return Index([i for i, _ in rows], [t for _, t in rows], edits, sizes - Q + 1 - edits * Q, bitmap, codes,
                 np.append(first, len(code)), item[order], place[order])


def align(item: bytes, text: bytes, low: int, high: int) -> tuple[int, int]:
    """(edits, stop): the fewest edits that turn ``item`` into a stretch of ``text`` along diagonals low..high.

    A row of the table holds all diagonals; a step within the row (a text byte that the item lacks) is a running
    minimum. ``stop`` is where the stretch ends, the first such place.
    """
    a, wide = np.frombuffer(item, np.uint8), high - low + 1
    padded = np.full(len(item) + wide + 1, 256, np.int64)  # text[low + k] at k; 256 equals no byte
    start, stop = max(0, low), min(len(text), low + len(padded))
    if stop > start:
        padded[start - low : stop - low] = np.frombuffer(text, np.uint8)[start:stop]
    ramp, far = np.arange(wide), len(item) + wide
    row = np.where((low + ramp >= 0) & (low + ramp <= len(text)), 0, far)
    for i in range(len(a)):
        new = row + (padded[i : i + wide] != a[i])
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        inside = low + ramp + i + 1
        new[(inside < 0) | (inside > len(text))] = far
        row = np.minimum.accumulate(new - ramp) + ramp
    best = int(row.argmin())
    return int(row[best]), len(item) + low + best


def locate(item: bytes, text: bytes, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(start, stop, edits) of the leak along diagonals low..high, if it is within the budget."""
    begin = max(0, low)
    at = text.find(item, begin, high + len(item) + 1)
    if at >= 0:
        return at, at + len(item), 0
    if not edits:
        return None
    low, high = low - edits, high + edits
    found, stop = align(item, text, low, high)
    if found > edits:
        return None
    back = text[max(0, stop - len(item) - edits) : stop][::-1]
    _, length = align(item[::-1], back, -edits, edits)
    return stop - min(length, len(back)), stop, found


def find_hits(texts: list[bytes], index: Index) -> list[list[tuple[int, int, int, int]]]:
    """For each text (as ``normal`` gives it) its (item id, start, stop, edits), in bytes of that text."""
    hits: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    if not index.items:
        return hits
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    codes = gram_codes(np.frombuffer(b"\n".join(texts), np.uint8))  # no item holds a line feed
    at = np.flatnonzero(index.bitmap[(codes >> np.uint64(64 - _BITS)).astype(np.int64)])
    rank = np.searchsorted(index.codes, codes[at])
    real = index.codes[np.minimum(rank, len(index.codes) - 1)] == codes[at]
    at, rank = at[real], rank[real]
    number = index.offsets[rank + 1] - index.offsets[rank]
    total = int(number.sum())
    if not total:
        return hits
    entry = np.arange(total) - np.repeat(np.cumsum(number) - number, number) + np.repeat(index.offsets[rank], number)
    at = np.repeat(at, number)
    doc = np.searchsorted(begin, at, "right") - 1
    item = index.item[entry]
    widest = int(max(map(len, index.items))) + 1
    diagonal = at - begin[doc] - index.place[entry] + widest
    step = index.edits[item] + 1
    band = diagonal // step
    pair = doc * len(index.items) + item
    # An entry is in the band that begins at its own step and in the one that began a step before.
    scale = int(band.max()) + 2
    keys, counts = np.unique(np.concatenate([pair * scale + band + 1, pair * scale + band]), return_counts=True)
    pair, band = keys // scale, keys % scale - 1
    enough = counts >= index.needed[pair % len(index.items)]
    for p, b in zip(pair[enough].tolist(), band[enough].tolist(), strict=True):
        d, i = divmod(p, len(index.items))
        k = int(index.edits[i])
        low = b * (k + 1) - widest
        found = locate(index.items[i], texts[d], low, low + 2 * k + 1, k)
        if found and (index.ids[i], *found) not in hits[d]:
            hits[d].append((index.ids[i], *found))
    return hits


def _slices(texts: list[bytes], size: int = 2 << 20) -> list[tuple[int, int]]:
    out, start, held = [], 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            out.append((start, i))
            start, held = i, 0
        held += len(t)
    return [*out, (start, len(texts))]


def _search(shared: Broadcast[Index]) -> Callable[[pa.Array], pa.Array]:
    names = ("item_id", "start", "stop", "edits")

    def search(column: pa.Array) -> pa.Array:
        texts, out = [normal(t) for t in column.to_pylist()], []
        for a, z in _slices(texts):
            out += find_hits(texts[a:z], shared.value)
        return pa.array([[dict(zip(names, h, strict=True)) for h in hits] for hits in out],
                        pa.list_(pa.struct([(n, pa.int64()) for n in names])))

    return search


def leaks(text: Column, benchmark: DataFrame, *, item_col: str = "item_id", item_text_col: str = "text") -> Column:
    """Expression for a text's leaks: array of (item_id, start, stop, edits) in bytes of the normalised text.

    The benchmark is measured first and collected in blocks of about BLOCK_BYTES, each searched for in a pass of its
    own, so what travels with the tasks has a fixed bound. Rows without an item id or text hold nothing to find.
    """
    spark = benchmark.sparkSession
    items = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("words")).distinct()
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    parts = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b).collect()
        shared = spark.sparkContext.broadcast(build_index([(r["item"], normal(r["words"])) for r in rows]))

        parts.append(F.arrow_udf(_search(shared), f"array<{HIT}>")(text))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def mark_leaks(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", out_col: str = "leaks",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """All rows and columns of ``documents`` and ``out_col``, an array that is empty for a clean document.

    Null and empty texts are clean; so are all, if the benchmark is empty. Rows are judged one by one, so repeated
    ids, null ids and copies need no rule; very long texts are searched whole. A column named ``out_col`` is
    replaced, all others stay as they are. There is no shuffle of documents.
    """
    return documents.withColumn(out_col, leaks(F.col(text_col), benchmark, item_col=item_col, item_text_col=item_text_col))
