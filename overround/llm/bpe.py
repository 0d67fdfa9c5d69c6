"""Byte-level BPE: an exact encoder by backtracking over longest matches, and a decoder by an offset table.

The merges of a word never have to be replayed. An automaton (Aho-Corasick) over the reversed vocabulary runs over the
reversed word once and names, for each place, the tokens that start there, the longest first. The encoder takes the
longest one that is compatible with the token before it: two neighbouring tokens are compatible if merging their joined
bytes would give these two tokens again. A sequence whose neighbours are all compatible is the result of the merges,
and there is only one, so a place from which no token leads on is given up for good, and the work is linear.

Compatibility follows from the merge tree alone: while the merges of either token proceed, the piece at its inner edge
changes a few times; the pair is broken if, at a time when two pieces meet at the edge, their own merge comes first.

The pattern that parts a text into words never joins across a space before a word, so chunks that come again are looked
up. Decoding gathers bytes from the joined vocabulary by the tokens' offsets.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overround.llm.chunks import Remembered, chunks
from overround.llm.shared import text_slices

#: Words of byte-level vocabularies (a fixed pattern).
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Bytes of known chunks that a worker keeps; pairs whose compatibility it keeps; texts of a slice.
REMEMBERED, PAIRS, SLICE = 256 << 20, 1 << 19, 2 << 20


@lru_cache(1)
def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes follow from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens of a byte-level BPE file as bytes, their merges, and its special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, to_byte = data["model"], byte_characters()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = {token: i for token, i in model["vocab"].items() if token not in self.special}
        self.tokens: dict[int, bytes] = {i: bytes(map(to_byte.__getitem__, token)) for token, i in ids.items()}
        #: (left, right) to (rank, result): the merges, in order.
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        size = max([*self.tokens, *self.special.values()]) + 1
        table = [self.tokens.get(i, b"") for i in range(size)]
        for content, i in self.special.items():
            table[i] = content.encode()
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a sequence of ids, and how many of them each id gave."""
        length = self.lengths[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.offsets[ids] - (ends - length), length) + np.arange(total)], length


class Encoder:
    """Ids of texts, as the merges of a ``Vocabulary`` give them; special tokens in a text are found as such."""

    def __init__(self, path: str) -> None:
        self.vocabulary = v = Vocabulary(path)
        self.single = {t[0]: i for i, t in v.tokens.items() if len(t) == 1}
        self._spines(v)
        self.whole = {v.tokens[i]: i for i in self.right}  # tokens that their own merges give; others never come out
        self.size = v.lengths.tolist()
        #: The longest other token that a token begins with, -1 for single bytes.
        self.shorter = {i: next((self.whole[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.whole), -1)
                        for t, i in self.whole.items()}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in self.whole.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.heads, self.tails, self.known = (Remembered(REMEMBERED // k, 4) for k in (8, 2, 2))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None

    def _spines(self, v: Vocabulary) -> None:
        """For each token the pieces at its right and left edge while its merges proceed, with the rank that ends each.

        The last piece is the token itself, which no merge of its own ends.
        """
        never = len(v.merges)
        self.right, self.left = ({i: [(i, never)] for i in self.single.values()} for _ in range(2))
        for (a, b), (rank, token) in v.merges.items():
            if token not in self.right and a in self.right and b in self.right and self._meets(a, b, rank):
                self.right[token] = [*self.right[b][:-1], (b, rank), (token, never)]
                self.left[token] = [*self.left[a][:-1], (a, rank), (token, never)]

    def _meets(self, a: int, b: int, rank: int) -> bool:
        """Whether tokens a and b, side by side, both come to be and are first merged with each other by ``rank``."""
        return self._crossing(a, b) == rank

    def _crossing(self, a: int, b: int) -> int | None:
        """Rank of the first merge over the edge between a and b, if there is one."""
        merges, left, right = self.vocabulary.merges, self.right[a], self.left[b]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            found = merges.get((x, y))
            # Merges go by rank, and from left to right within one: at equal ranks x is already taken by its left
            # neighbour, while y isn't yet by its right one.
            if found and found[0] < x_ends and found[0] <= y_ends:
                return found[0]
            last = (i == len(left) - 1, j == len(right) - 1)
            if all(last):
                return None
            if last[1] or not last[0] and x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._crossing(a, b) is None
        return known

    def word(self, raw: bytes) -> list[int]:
        """Ids of one word of the pattern."""
        if raw in self.whole:
            return [self.whole[raw]]
        # Of the matches that end at a place of the reversed word, the longest comes first; here it is kept.
        longest = dict(reversed(list(self.automaton.iter(raw[::-1].decode("latin-1")))))
        return self._backtracked(len(raw), longest)

    def _backtracked(self, end: int, longest: dict[int, int]) -> list[int]:
        """Ids of a word of ``end`` bytes, whose longest token from place k on is ``longest[end - 1 - k]``."""
        size, shorter, pairs = self.size, self.shorter, self.pairs
        dead: set[int] = set()
        out: list[int] = []
        base = end - 1
        at, last, token = 0, -1, longest[base]
        while at < end:
            while token >= 0:
                to = at + size[token]
                if to not in dead:
                    if last < 0:
                        break
                    fits = pairs.get((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last, token = to, token, longest.get(base - to, -1)
            else:  # nothing leads on from here: back to the last token, which then must be shorter
                dead.add(at)
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
                token = shorter[token]
        return out

    def _learn(self, table: Remembered, new: set[str], lead: str) -> None:
        found = {chunk: WORDS.findall(lead + chunk) for chunk in new}
        words = self.known
        for w in words.missing(set().union(*found.values())):
            words[w] = array("I", self.word(w.encode())).tobytes()
        get = words.__getitem__
        for chunk, parts in found.items():
            table[chunk] = get(parts[0]) if len(parts) == 1 else b"".join(map(get, parts))

    def _plain(self, texts: list[str]) -> list[bytes]:
        split = [chunks(t) for t in texts]
        for table, lead, want in ((self.heads, "", {s[0] for s in split}), (self.tails, " ", set().union(*(s[1:] for s in split)))):
            self._learn(table, table.missing(want), lead)
        head, tail = self.heads.__getitem__, self.tails.__getitem__
        return [head(s[0]) + b"".join(map(tail, s[1:])) for s in split]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; none for null."""
        parts = [self.cut.split(t) if self.cut and self.cut.search(t) else [t] for t in (x or "" for x in texts)]
        plain = iter(self._plain([p for split in parts for p in split[::2]]))
        special = self.vocabulary.special
        return [b"".join(next(plain) if k % 2 == 0 else special[p].to_bytes(4, "little") for k, p in enumerate(split))
                for split in parts]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, which serves all its tasks."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _strings(pieces: list[bytes]) -> pa.Array:
    return pa.array([p.decode(errors="replace") for p in pieces], pa.string())


def _code(path: str, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in text_slices(batches, 1, SLICE):
            ids = encode(batch.column(1).to_pylist())
            data, length = encode.vocabulary.decode(np.frombuffer(b"".join(ids), "<u4"))
            ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0] + [len(x) // 4 for x in ids])].tolist()
            raw = data.tobytes()
            decoded = _strings([raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)])
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(ids, pa.binary()), decoded], names)

    return rows


def encode_texts(documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) for every row of ``documents``.

    ``ids`` are the token ids of the whole text as little-endian unsigned 32-bit integers, ``decoded`` the text that
    they give again (bytes that are no UTF-8 as U+FFFD). A null text is an empty one: no ids. Special tokens spelt in a
    text become their ids. Null ids and repeated rows are kept as they come; very long texts are encoded whole; other
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    names = [id_col, "n_tokens", "ids", "decoded"]
    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col), F.col(text_col)).mapInArrow(
        _code(tokenizer_path, names), f"`{id_col}` {kind}, n_tokens long, ids binary, decoded string")


def decode_ids(tokens: DataFrame, tokenizer_path: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All rows and columns of ``tokens`` and the text of ``ids_col`` (as ``encode_texts`` gives them; null: null).

    Ids outside the vocabulary give nothing; bytes that are no UTF-8 become U+FFFD. A column named ``out_col`` is replaced.
    """

    def texts(column: pa.Array) -> pa.Array:
        vocabulary = encoder(tokenizer_path).vocabulary
        out: list[str | None] = []
        for raw in column.to_pylist():
            ids = np.frombuffer(raw or b"", "<u4")
            ids = ids[ids < len(vocabulary.lengths)]
            out.append(None if raw is None else vocabulary.decode(ids)[0].tobytes().decode(errors="replace"))
        return pa.array(out, pa.string())

    return tokens.withColumn(out_col, F.arrow_udf(texts, "string")(F.col(ids_col)))
