"""Helpers that several operators share: table access, shared storage, Arrow slices, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_base: list[str] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor of a cluster can reach.

    Where the setting is missing, a local master gets one temporary folder per process; any
    other master is refused, since its executors couldn't read what the driver names.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="overround-llm-"))
        base = _local_base[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to shared storage and read it back."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, id_col: str, size: int, name: str) -> DataFrame:
    """Rows of ``size`` ids at most, those of the smallest hashes (all rows of each).

    Only ids are ranked; there are ``size`` of them, so they may be broadcast to the rows.
    """
    ids = df.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    ids = written(ids.orderBy(F.xxhash64(id_col), id_col).limit(size), name)
    return df.join(F.broadcast(ids), id_col)


def text_slices(batches: Iterator[pa.RecordBatch], text_index: int,
                max_bytes: int = 3 << 19) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of whole rows of about ``max_bytes`` of text.

    A row is never cut, so a slice holds one longer text at most; this bounds the temporary
    arrays of the vectorised operators, however many rows Spark puts into a batch.
    """
    for batch in batches:
        column = batch.column(text_index)
        lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        if not len(lengths):
            continue
        ends = np.cumsum(lengths.astype(np.int64))
        group = (ends - 1).clip(0) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)


_rng = np.random.default_rng(20240229)
#: Random 64-bit value for each byte and an odd multiplier: words are hashed as polynomials over them.
BYTE_CODE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


_BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
#: Bytes that are hashed at once; the tables of powers have this length, and a processor's cache should hold them.
PIECE = 1 << 18
_power_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _piece_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomials of spans of at most ``PIECE`` bytes of data."""
    if not _power_tables:
        _power_tables.append((_powers(BASE, PIECE + 1), _powers(_BASE_INVERSE, PIECE + 1)))
    up, down = _power_tables[0]
    total = np.zeros(len(data) + 1, np.uint64)
    np.take(BYTE_CODE, data, out=total[1:])
    total[1:] *= up[: len(data)]
    np.cumsum(total, out=total)
    return (total[ends] - total[starts]) * down[starts]


def _long_sum(data: np.ndarray) -> np.uint64:
    """The polynomial of a span of any length, put together from pieces."""
    out = 0
    for at in range(0, len(data), PIECE):
        piece = data[at : at + PIECE]
        own = _piece_sums(piece, np.zeros(1, np.int64), np.array([len(piece)]))
        out += int(own[0]) * pow(int(BASE), at, 2**64)
    return np.uint64(out % 2**64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` (bytes), equal for equal bytes wherever they stand.

    The data are hashed in pieces, so no array but the result grows with them.
    """
    out = np.zeros(len(starts), np.uint64)
    piece = starts // (PIECE // 2)
    order = None if (piece[1:] >= piece[:-1]).all() else np.argsort(piece, kind="stable")
    cuts = np.flatnonzero(np.diff(piece if order is None else piece[order])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)], strict=True):
        at = np.arange(a, b) if order is None else order[a:b]
        if not len(at):
            continue
        low = int(piece[at[0]]) * (PIECE // 2)
        long = ends[at] > low + PIECE
        for k in at[long].tolist():
            out[k] = _long_sum(data[starts[k] : ends[k]])
        at = at[~long]
        if len(at):
            out[at] = _piece_sums(data[low : int(ends[at].max())], starts[at] - low, ends[at] - low)
    return mix(out + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes whose words are parted by one or more spaces."""
    space = np.empty(len(data) + 2, bool)
    space[0] = space[-1] = True
    np.equal(data, 32, out=space[1:-1])
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (len(words) - n + 1 of them)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = words[:count].copy()
    for k in range(1, n):
        out *= BASE
        out += words[k : k + count]
    return mix(out)


def joined_words(texts: list[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of many texts at once, parted at \\x20 and \\x09-\\x0D: (bytes, starts, ends, words of each text).

    In the bytes each word is followed by one space, the texts stand one after the other.
    """
    parts, counts = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        words = (raw.translate(LOWER) if lower else raw).split()
        counts[i] = len(words)
        if words:
            parts.append(b" ".join(words))
    data = np.frombuffer(b" ".join([*parts, b""]) if parts else b"", np.uint8)
    starts, ends = word_spans(data)
    return data, starts, ends, counts
