"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word with the spaces around it, byte by byte in both directions, and labels every position
(digits and ASCII punctuation are read as spaces); a
document's probabilities are the mean over all positions of all its words. Words are read apart, so each distinct word
of a slice of texts runs through the network once. It is trained in numpy by backpropagation through time on a bounded
sample of words of labelled documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overround.llm.shared import hashed_sample, mix, span_hashes, text_slices

#: Units in each direction, bytes of a word read at once (longer ones are read in pieces), steps of training.
UNITS, SPAN, EPOCHS, BATCH = 12, 24, 3, 1024
#: Documents and words of each that the network is trained on, at most; words that a worker remembers.
MAX_DOCS, MAX_WORDS, REMEMBERED = 2_000, 40, 300_000
#: Bytes as the network reads them: in ASCII all but letters are spaces.
READ = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(READ).split()


def pieces(word: bytes) -> list[bytes]:
    """A word with its spaces, in pieces of SPAN bytes at most."""
    if len(word) <= SPAN - 2:
        return [b" " + word + b" "]
    word = b" " + word + b" "
    return [word[k : k + SPAN] for k in range(0, len(word), SPAN)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """A gated recurrent layer: input weights by byte, recurrent weights of the gates and of the candidate."""

    bytes: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray

    def run(self, codes: np.ndarray, live: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (steps, rows, units) for codes (rows, steps); a row past its end keeps its state."""
        rows, steps = codes.shape
        h = np.zeros((rows, UNITS), np.float32)
        out = np.empty((steps, rows, UNITS), np.float32)
        for t in range(steps):
            x = self.bytes[codes[:, t]]
            g = _sigmoid(x[:, : 2 * UNITS] + h @ self.gates)
            z, r = g[:, :UNITS], g[:, UNITS:]
            n = np.tanh(x[:, 2 * UNITS :] + (r * h) @ self.candidate)
            m = live[:, t : t + 1]
            if trace is not None:
                trace.append((h, z, r, n, m))
            h = h + m * z * (n - h)
            out[t] = h
        return out

    def back(self, codes: np.ndarray, trace: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of the three weights from those of the states, backwards through the steps."""
        d_bytes, d_gates, d_candidate = (np.zeros_like(w) for w in (self.bytes, self.gates, self.candidate))
        dh = np.zeros_like(d_out[0])
        for t in range(len(trace) - 1, -1, -1):
            h, z, r, n, m = trace[t]
            dh = dh + d_out[t]
            dn = dh * m * z * (1 - n * n)
            dz = dh * m * (n - h) * z * (1 - z)
            drh = dn @ self.candidate.T
            dr = drh * h * r * (1 - r)
            dg = np.concatenate([dz, dr], axis=1)
            d_candidate += (r * h).T @ dn
            d_gates += h.T @ dg
            np.add.at(d_bytes, codes[:, t], np.concatenate([dg, dn], axis=1))
            dh = dh * (1 - m * z) + drh * r + dg @ self.gates.T
        return d_bytes, d_gates, d_candidate


@dataclass
class Network:
    """Both directions, the output layer, and the languages that its outputs stand for."""

    forward: Direction
    backward: Direction
    output: np.ndarray
    bias: np.ndarray
    languages: list[str]

    def weights(self) -> list[np.ndarray]:
        return [w for d in (self.forward, self.backward) for w in (d.bytes, d.gates, d.candidate)] + [self.output, self.bias]


def new_network(languages: list[str], seed: int = 1) -> Network:
    rng = np.random.default_rng(seed)

    def weights(rows: int, columns: int, scale: float) -> np.ndarray:
        return (rng.standard_normal((rows, columns)) * scale).astype(np.float32)

    def direction() -> Direction:
        return Direction(weights(256, 3 * UNITS, 0.3), weights(UNITS, 2 * UNITS, 0.25), weights(UNITS, UNITS, 0.25))

    return Network(direction(), direction(), weights(2 * UNITS, len(languages), 0.2), np.zeros(len(languages), np.float32), languages)


def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes and live marks, padded at the end, and the same for the reversed words."""
    lengths = np.array([len(w) for w in words])
    steps = int(lengths.max())
    codes = np.frombuffer(b"".join(w.ljust(steps, b"\0") for w in words), np.uint8).reshape(-1, steps)
    live = np.arange(steps) < lengths[:, None]
    mirror = np.where(live, lengths[:, None] - 1 - np.arange(steps), np.arange(steps))
    return codes, live, np.take_along_axis(codes, mirror, axis=1), mirror


def label_positions(net: Network, words: list[bytes], trace: list | None = None) -> tuple[np.ndarray, ...]:
    """(probabilities (rows, steps, languages), live, joined states, codes, reversed codes, mirror)."""
    codes, live, reverse, mirror = encode(words)
    mask = live.astype(np.float32)
    traces: list[list | None] = [[], []] if trace is not None else [None, None]
    a = net.forward.run(codes, mask, traces[0]).transpose(1, 0, 2)
    b = net.backward.run(reverse, mask, traces[1]).transpose(1, 0, 2)
    b = np.take_along_axis(b, mirror[:, :, None], axis=1)
    states = np.concatenate([a, b], axis=2)
    logits = states @ net.output + net.bias
    e = np.exp(logits - logits.max(axis=2, keepdims=True))
    if trace is not None:
        trace += traces
    return e / e.sum(axis=2, keepdims=True), live, states, codes, reverse, mirror


def gradients(net: Network, words: list[bytes], labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradient for each weight."""
    trace: list = []
    p, live, states, codes, reverse, mirror = label_positions(net, words, trace)
    total = live.sum()
    at = np.take_along_axis(p, labels[:, None, None].repeat(p.shape[1], axis=1), axis=2)[:, :, 0]
    loss = float(-(np.log(at + 1e-9) * live).sum() / total)
    d = p.copy()
    d[np.arange(len(labels)), :, labels] -= 1
    d *= live[:, :, None] / np.float32(total)
    d_output = np.einsum("rsu,rsl->ul", states, d, optimize=True)
    d_states = d @ net.output.T
    da = d_states[:, :, :UNITS].transpose(1, 0, 2)
    db = np.take_along_axis(d_states[:, :, UNITS:], mirror[:, :, None], axis=1).transpose(1, 0, 2)
    return loss, [*net.forward.back(codes, trace[0], da), *net.backward.back(reverse, trace[1], db), d_output, d.sum(axis=(0, 1))]


def train(words: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Adam steps over batches of words of like length; the languages are those of ``labels``."""
    languages = sorted(set(labels))
    net, rng = new_network(languages, seed), np.random.default_rng(seed)
    number = {x: k for k, x in enumerate(languages)}
    y = np.array([number[x] for x in labels])
    order = np.argsort([len(w) for w in words], kind="stable")
    batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    step, last = 0, epochs * len(batches)
    for _ in range(epochs):
        for k in rng.permutation(len(batches)):
            rows = batches[k]
            _, slopes = gradients(net, [words[i] for i in rows], y[rows])
            step += 1
            rate = 0.02 * (1 - step / (last + 1)) + 0.001
            for w, g, m, v in zip(net.weights(), slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


class Reader:
    """Pools texts' position probabilities; remembers the sums of words, as far as its bound allows."""

    def __init__(self, net: Network) -> None:
        self.net, self.rows = net, {}
        self.sums = np.zeros((0, len(net.languages) + 1), np.float32)

    def _learn(self, new: list[bytes]) -> None:
        """Sums over each word's positions: probabilities, and the number of positions."""
        parts = [(p, k) for k, w in enumerate(new) for p in pieces(w)]
        parts.sort(key=lambda x: len(x[0]))
        sums = np.zeros((len(new), self.sums.shape[1]), np.float32)
        for k in range(0, len(parts), 2048):
            part = parts[k : k + 2048]
            p, live, *_ = label_positions(self.net, [x[0] for x in part])
            rows = np.concatenate([(p * live[:, :, None]).sum(axis=1), live.sum(axis=1, keepdims=True)], axis=1)
            np.add.at(sums, [x[1] for x in part], rows)
        base = len(self.sums)
        self.sums = np.concatenate([self.sums, sums])
        self.rows.update((w, base + k) for k, w in enumerate(new))

    def pool(self, texts: list[str | None]) -> np.ndarray:
        """Mean probabilities of each text; zeros without words."""
        split = [split_words(t) for t in texts]
        new = set().union(*split) - self.rows.keys() if split else set()
        if len(self.rows) + len(new) > REMEMBERED:
            self.rows, self.sums = {}, self.sums[:0]
            new = set().union(*split)
        if new:
            self._learn(sorted(new))
        out = np.zeros((len(texts), len(self.net.languages)))
        for k, words in enumerate(split):
            if words:
                total = self.sums[list(map(self.rows.__getitem__, words))].sum(axis=0, dtype=np.float64)
                out[k] = total[:-1] / total[-1]
        return out


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, words): the words of the smallest hashes of each text, MAX_WORDS at most, from the whole of it."""
    for batch in text_slices(batches, 1):
        out = []
        for text in batch.column(1).to_pylist():
            words = sorted(set(split_words(text)))
            data = np.frombuffer(b" ".join(words), np.uint8)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0, np.int64)
            hashes = mix(span_hashes(data, ends - [len(w) for w in words], ends) if words else np.zeros(0, np.uint64))
            out.append([words[k].decode() for k in np.argsort(hashes)[:MAX_WORDS]])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["lang", "words"])


def fit(documents: DataFrame, label: str, text: str, identity: str) -> Network | None:
    """Network from (label, text) of MAX_DOCS documents at most, those whose ids have the smallest hashes; None
    without any. Documents without an id aren't learned from; equal samples count once."""
    known = documents.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(identity, label, text)
    some = hashed_sample(known, identity, MAX_DOCS, "sample").select(label, text)
    rows = some.mapInArrow(_sample_rows, "lang string, words array<string>").groupBy("lang", "words").count().orderBy(
        "lang", "words").limit(2 * MAX_DOCS).collect()
    parts = [(p, r["lang"]) for r in rows for w in r["words"] for p in pieces(w.encode())]
    return train([p for p, _ in parts], [x for _, x in parts]) if parts else None


def _predictor(net: Network | None) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(net) if net else None
        for column in columns:
            names, scores = [], []
            for k in range(0, len(column), 1000):
                texts = column.slice(k, 1000).to_pylist()
                pooled = reader.pool(texts) if reader else None
                for i, text in enumerate(texts):
                    if pooled is None or text is None or not any(map(str.isalpha, text)):
                        names.append("und")
                        scores.append(0.0)
                    else:
                        best = int(pooled[i].argmax())
                        names.append(net.languages[best])
                        scores.append(min(1.0, float(pooled[i, best])))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict


def identify_languages(documents: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "lang", out_col: str = "language") -> DataFrame:
    """All rows and columns of ``documents``, and ``out_col``: struct(held_out, lang_pred, score).

    The network is trained on rows with a language and a text for which ``held_out``, an expression over the id, is
    false. ``lang_pred`` is one of their languages (ties: the first by name), or ``und`` with score 0 if the text is
    null or has no letter, or nothing could be learned; ``score`` is the mean probability of that language over all
    positions. Rows with null or repeated ids are judged one by one; very long texts are read whole. A column named
    ``out_col`` is replaced, others stay as they are, whatever their names. Prediction shuffles nothing.
    """
    known = documents.select(F.col(id_col).alias("known_id"), F.col(label_col).alias("label"), F.col(text_col).alias("words"),
                             held_out.alias("held_out")).where("not held_out")
    net = fit(known, "label", "words", "known_id")
    predict = F.arrow_udf(_predictor(net), "lang_pred string, score double")(F.col(text_col))
    return documents.withColumn(out_col, predict).withColumn(out_col, F.struct(
        held_out.alias("held_out"), F.col(out_col)["lang_pred"].alias("lang_pred"), F.col(out_col)["score"].alias("score")))
