"""Toxicity by a learned lexicon, met through Levenshtein automata, and scores of the context around each hit.

The lexicon comes from labelled documents: words whose documents are toxic far more often than chance explains. Its
trie is intersected with the Levenshtein automaton of one or two edits, state by state as texts ask for them, so a word
is read once, letter by letter, and most words leave the automaton after a few. Words near a term that labelled
documents show to be innocent are cleared. Each hit is weighed by the words around it: inside quotation marks or after
a verb of report it counts as quotation, otherwise as abuse. A logistic model with prior means turns both into a score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overround.llm.minhash import shingle_sets
from overround.llm.shared import text_slices, written

#: Labelled rows that the model is fitted on, at most; letters of a term, at least.
MAX_ROWS, LETTERS = 40_000, 3
#: Words to either side of a hit that its context takes in; words that a worker remembers.
CONTEXT, REMEMBERED = 8, 300_000
#: Marks of quotation and verbs of report (fixed values).
QUOTES = frozenset("\"“”„«»‹›")
REPORT = frozenset((
    "said says called calls quoted quote quotes wrote writes reported word words term terms insult insults "
    "sagte sagt nannte nennt schrieb zitat wort wörter begriff dit appelé appelle écrit citation mot mots "
    "terme dijo dice llamó llama escribió cita palabra palabras término").split())
#: Weights that the fit starts from and is held to: none, abuse, further abuse, quotation, near words.
PRIOR_MEAN = np.array([-3.0, 0.8, 0.5, 0.25, 0.4])
PRIOR_STRENGTH = np.array([0.01, 0.5, 0.5, 0.5, 0.5])


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The lexicon's trie intersected with a Levenshtein automaton, made deterministic as it is used.

    A state is the set of (trie node, edits so far) that the letters read can have led to; of two entries for a node
    only that of fewer edits is kept.
    """

    LIMIT = 50_000

    def __init__(self, terms: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.reach = [0]
        for term in terms:
            node, allowed = 0, edits_allowed(term)
            self.reach[0] = max(self.reach[0], allowed)
            for letter in term:
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.ends):
                    self.children.append({})
                    self.ends.append(None)
                    self.reach.append(0)
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node] = term
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state for nodes and their edits, with the letters that a text may leave out; -1 if empty."""
        queue = sorted(nodes, key=nodes.get)
        for node in queue:
            if nodes[node] < self.reach[node]:
                for child in self.children[node].values():
                    if nodes[node] + 1 <= self.reach[child] and nodes[node] + 1 < nodes.get(child, 99):
                        nodes[child] = nodes[node] + 1
                        queue.append(child)
        key = frozenset(nodes.items())
        if not key:
            return -1
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            ends = [(e, self.ends[n]) for n, e in key if self.ends[n] is not None and e <= edits_allowed(self.ends[n])]
            self.found.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, edits in self.sets[state]:
            for other, child in self.children[node].items():
                now = edits + (other != letter)
                if now <= self.reach[child] and now < nodes.get(child, 99):
                    nodes[child] = now
            if edits < self.reach[node] and edits + 1 < nodes.get(node, 99):
                nodes[node] = edits + 1  # a letter that the term lacks
        return self._state(nodes)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its edits, and how many (ties: the first in order of letters)."""
        if len(self.sets) > self.LIMIT:
            self._reset()
        state = self.start
        for letter in word:
            steps = self.steps[state]
            if letter not in steps:
                steps[letter] = self._step(state, letter)
            state = steps[letter]
            if state < 0:
                return None
        return self.found[state]


def bare(token: str) -> str:
    """A lower-case token without what isn't a letter or digit at its ends."""
    a, z = 0, len(token)
    while a < z and not token[a].isalnum():
        a += 1
    while z > a and not token[z - 1].isalnum():
        z -= 1
    return token[a:z]


@dataclass
class Model:
    """Weights of terms, of near words by edits, words that are cleared, and the logistic weights."""

    terms: dict[str, float] = field(default_factory=dict)
    near: dict[int, float] = field(default_factory=dict)
    cleared: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: PRIOR_MEAN.copy())


class Reader:
    """Features of texts under a model; remembers words, as far as its bound allows."""

    def __init__(self, model: Model) -> None:
        self.model, self.automaton = model, Automaton(sorted(model.terms))
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[float, int]] = {}

    def _weigh(self, token: str) -> tuple[float, int] | None:
        word = bare(token)
        found = self.automaton.match(word) if word else None
        if not found or found[1] and word in self.model.cleared:
            return None
        term, edits = found
        weight = self.model.terms[term] if not edits else min(self.model.terms[term], self.model.near.get(edits, 0.0))
        return (weight, edits) if weight > 0 else None

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Rows of (1, strongest abuse, log of further abuse, strongest quotation, strongest near word)."""
        split = [(t or "").lower().split() for t in texts]
        new = set().union(*split) - self.seen if split else set()
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen, self.hits = set(), {}
            new = set().union(*split)
        for token in new:
            if weight := self._weigh(token):
                self.hits[token] = weight
        self.seen |= new
        out = np.zeros((len(texts), 5))
        out[:, 0] = 1
        for row, tokens in zip(out, split, strict=True):
            if self.hits.keys().isdisjoint(tokens):
                continue
            total = 0.0
            for i, token in enumerate(tokens):
                if token in self.hits:
                    weight, edits = self.hits[token]
                    k = 4 if edits else 3 if quoted(tokens, i) else 1
                    row[k] = max(row[k], weight)
                    total += weight * (k == 1)
            row[2] = math.log1p(max(0.0, total - row[1]))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.model.weights, -60, 60)))


def quoted(tokens: list[str], i: int) -> bool:
    """Whether token i stands in quotation marks that open and close near it, or near behind a verb of report."""
    def marks(part: list[str]) -> int:
        return sum(c in QUOTES for t in part for c in t)

    token = tokens[i]
    word = bare(token)
    at = token.find(word)
    before = marks(tokens[max(0, i - CONTEXT) : i]) + marks([token[:at]])
    behind = marks(tokens[i + 1 : i + 1 + CONTEXT]) + marks([token[at + len(word):]])
    if before % 2 and behind:
        return True
    return any(bare(t) in REPORT for t in tokens[max(0, i - CONTEXT // 2) : i])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic) for each distinct word of each document."""
    for batch in text_slices(batches, 1):
        words, toxic = [], []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = set(map(bare, set((text or "").lower().split()))) - {""}
            words += own
            toxic += [label] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(known, signature): the smallest hash among a document's five-word shingles, which its copies mostly share."""
    for batch in text_slices(batches, 1):
        sets = shingle_sets(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [int(s[0].view(np.int64)) if len(s) else None for s in sets], pa.int64())], ["known", "signature"])


def _near_rows(terms: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counted words that are near a term without being one, with the edits."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, exact = Automaton(terms), set(terms)
        for batch in batches:
            words = batch.column(0).to_pylist()
            found = [None if w in exact else automaton.match(w) for w in words]
            keep = [k for k, f in enumerate(found) if f]
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([found[k][1] for k in keep], pa.int64())],
                                             ["word", "n", "t", "edits"])

    return rows


def _log_tail(base: float) -> Column:
    """Upper bound (Chernoff) for the log of the chance of t toxic documents or more among n, where t / n > base."""
    p = F.col("t") / F.col("n")
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    return F.when(p > base, -F.col("n") * (p * F.log(p / base) + rest)).otherwise(0.0)


def _log_odds(t: float, n: float, base: float) -> float:
    return math.log((t + 0.5) / (n - t + 0.5)) - math.log(base / (1 - base))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Model from (id, text) and (id, label): MAX_ROWS labelled ids at most, those of the smallest hashes.

    Their words are counted and tested in Spark; only terms and cleared words come here, all of them, which the words
    of MAX_ROWS documents bound.
    """
    known = labels.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(MAX_ROWS)
    known = written(known, "labelled")  # at most MAX_ROWS rows, so it may be broadcast

    def among(ids: DataFrame) -> DataFrame:
        return documents.join(F.broadcast(ids.withColumnRenamed("id", "known")), F.col("id") == F.col("known"))

    # A text that was copied many times would make its chance words look like evidence: copies count once.
    ids = known.schema["id"].dataType.simpleString()
    copies = among(known).select("known", "text").mapInArrow(_signature_rows, f"known {ids}, signature long")
    single = copies.where("signature is not null").groupBy("signature").agg(F.min("known").alias("id")).select("id").distinct()
    known = written(known.join(single, "id"), "labelled")
    train = among(known).select("label", "text")
    counts = written(train.mapInArrow(_word_rows, "word string, toxic int").groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("t")), "words")
    size = known.agg(F.count("*"), F.sum("label")).first()
    if not size[1] or size[1] == size[0]:
        return Model()
    base, vocabulary = size[1] / size[0], counts.count()
    rows = counts.where((F.col("t") >= 3) & (2 * F.col("t") > F.col("n")) & (F.length("word") >= LETTERS)
                        & (_log_tail(base) < math.log(0.5 / vocabulary))).collect()
    chosen = {r["word"]: _log_odds(r["t"], r["n"], base) for r in sorted(rows)}
    # Near words: innocent ones are cleared; words met once tell what unseen ones are worth.
    near = written(counts.mapInArrow(_near_rows(sorted(chosen)), "word string, n long, t long, edits long"), "near")
    cleared = frozenset(r["word"] for r in near.where("t < 0.5 * n or n > 1 and t < 0.8 * n").select("word").collect())
    once = {r["edits"]: (r["n"], r["t"]) for r in near.where("n = 1").groupBy("edits").agg(
        F.count("*").alias("n"), F.sum("t").alias("t")).collect()}
    weights = {}
    for e in (1, 2):  # as if 3 of 4 more had been seen to be toxic
        n, t = once.get(e, (0, 0))
        weights[e] = _log_odds(t + 3.0, n + 4.0, base)
    model = Model(chosen, weights, cleared)

    def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in text_slices(batches, 1):
            x = reader.features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"])

    # Equal rows of features (mostly documents without a hit) come as one row with a count.
    found = train.mapInArrow(feature_rows, "label int, x array<double>").groupBy("label", "x").count().collect()
    x, y = np.array([r["x"] for r in found]), np.array([r["label"] for r in found], float)
    number = np.array([r["count"] for r in found], float)
    model.weights = _logistic(x, y, number)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Newton steps for logistic weights with Gaussian priors."""
    w = PRIOR_MEAN.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        slope = x.T @ (number * (p - y)) + PRIOR_STRENGTH * (w - PRIOR_MEAN)
        curve = (x * (number * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(PRIOR_STRENGTH)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(documents: DataFrame, labels: DataFrame, held_out: Column, *, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", threshold: float = 0.7,
                   out_col: str = "toxicity") -> DataFrame:
    """All rows and columns of ``documents``, and ``out_col``: struct(held_out, score, predicted).

    The model is fitted on labelled rows for which ``held_out``, an expression over the id, is false. Labels that are
    null or neither 0 nor 1, or have no id, aren't used; several labels of an id count as the largest. Without both
    classes the prior model holds, which finds no terms. Null and empty texts have no hits and are scored like other
    texts without hits; rows with null or repeated ids are scored one by one; very long texts are read whole. A column
    named ``out_col`` is replaced, others stay as they are, whatever their names. Scoring shuffles nothing.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    model = fit(documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), known)
    return documents.withColumn(out_col, F.struct(
        held_out.alias("held_out"), F.arrow_udf(_scorer(model), "double")(F.col(text_col)).alias("score"))).withColumn(
        out_col, F.col(out_col).withField("predicted", (F.col(out_col)["score"] >= threshold).cast("int")))


def _scorer(model: Model) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model)
        for column in columns:
            parts = [reader.scores(column.slice(k, 1000).to_pylist()) for k in range(0, len(column), 1000)]
            yield pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())

    return score
