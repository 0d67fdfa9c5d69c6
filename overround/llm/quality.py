"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over the statistics. Its covariance is shrunk towards the pooled one and that towards a
multiple of the identity, so it stays well conditioned for small classes. A document's score is the posterior of the
good class from the difference of the Mahalanobis log-densities, for which the Cholesky factors are computed once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overround.llm.shared import text_slices, written

STATISTICS = ("words", "capitals", "types", "top_word", "repeats", "word_length", "symbols", "digits", "line_words",
              "same_lines", "odd_ends", "no_letters", "marks", "worst_line")
#: Shares below this can't be told apart; standardised statistics are cut at so many deviations.
SMALL, REACH = 0.002, 6.0
#: Weight of the pooled covariance in each class's, and of the identity in the result.
POOLED, IDENTITY = 0.1, 0.02
_PLAIN = frozenset(".,;:'\"-()")


def _share(part: float, whole: float) -> float:
    """A share on a log-odds scale, finite at 0 and 1."""
    p = part / whole if whole else 0.0
    return float(np.log((p + SMALL) / (1 - p + SMALL)))


def statistics(text: str | None) -> list[float]:
    """The STATISTICS of a whole text; a null or empty one has those of no words."""
    text = text or ""
    words = text.split()
    n, counts = len(words), Counter(words)
    letters = sum(map(str.isalpha, text))
    odd = sum(not w[-1].isalnum() and w[-1] not in _PLAIN for w in words)
    marks = Counter(c for c in text if not (c.isalnum() or c.isspace() or c in _PLAIN))
    lines = [line for line in text.split("\n") if line.strip()]
    worst = 0.0
    for line in lines:
        parts = line.split()
        if len(parts) >= 8:
            same = sum(a == b for a, b in zip(parts, parts[1:], strict=False)) / len(parts)
            shout = sum(map(str.isupper, line)) / len(line)
            rare = sum(not w[-1].isalnum() and w[-1] not in _PLAIN for w in parts) / len(parts)
            worst = max(worst, same, shout, rare)
    return [
        np.log1p(n), _share(sum(map(str.isupper, text)), letters), _share(len(counts), n),
        _share(counts.most_common(1)[0][1] if n > 4 else 0, n), _share(sum(a == b for a, b in zip(words, words[1:], strict=False)), n),
        np.log1p(sum(map(len, words)) / n) if n else 0.0, _share(sum(marks.values()), len(text)),
        _share(sum(map(str.isdigit, text)), len(text)), np.log1p(n / len(lines)) if lines else 0.0,
        _share(len(lines) - len(set(lines)), len(lines)), _share(odd, n),
        _share(sum(not any(map(str.isalpha, w)) for w in words), n), np.log1p(len(marks)), _share(worst, 1.0)]


def _statistic_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 1):
        rows = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(
            pa.array(rows.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))], ["id", "x"])


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's (label, n, sums, sums of products)."""
    p = len(STATISTICS)
    total = {y: [0, np.zeros(p), np.zeros((p, p))] for y in (0, 1)}
    for batch in batches:
        x = np.array(batch.column(0).to_pylist(), np.float64).reshape(-1, p)
        y = batch.column(1).to_numpy(zero_copy_only=False)
        for k, t in total.items():
            part = x[y == k]
            t[0] += len(part)
            t[1] += part.sum(axis=0)
            t[2] += part.T @ part
    for k, (n, s, q) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([n], pa.int64()), pa.array([[*s.tolist(), *q.ravel().tolist()]])],
                                         ["label", "n", "sums"])


@dataclass
class Discriminant:
    """Standardisation and, for the classes 0 and 1, log prior, mean, inverse Cholesky factor and log determinant."""

    centre: np.ndarray
    scale: np.ndarray
    classes: list[tuple[float, np.ndarray, np.ndarray, float]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -REACH, REACH)
        logs = []
        for prior, mean, factor, log_det in self.classes:
            d = (z - mean) @ factor.T
            logs.append(prior - 0.5 * (log_det + (d * d).sum(axis=1)))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def fit(sums: dict[int, tuple[int, np.ndarray]]) -> Discriminant | None:
    """From each class's count and sums; None if a class has no rows."""
    p = len(STATISTICS)
    if any(not sums.get(k, (0, None))[0] for k in (0, 1)):
        return None
    n = sum(s[0] for s in sums.values())
    whole = sums[0][1] + sums[1][1]
    centre = whole[:p] / n
    scale = np.sqrt(np.maximum(np.diag(whole[p:].reshape(p, p)) / n - centre**2, 1e-6))
    means, covariances = [], []
    for k in (0, 1):
        count, s = sums[k]
        mean = s[:p] / count
        covariances.append((s[p:].reshape(p, p) / count - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = sum(sums[k][0] * covariances[k] for k in (0, 1)) / n
    classes = []
    for k in (0, 1):
        weight = max(POOLED, 3 * p / (3 * p + sums[k][0]))  # more for a class of few rows
        c = (1 - weight) * covariances[k] + weight * pooled
        c = (1 - IDENTITY) * c + IDENTITY * np.eye(p) * max(np.trace(c) / p, 1e-3)
        factor = np.linalg.cholesky(c)
        classes.append((float(np.log(sums[k][0] / n)), means[k], np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum())))
    return Discriminant(centre, scale, classes)


def _score_rows(model: Discriminant | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, len(STATISTICS))
            score = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["id", "score"])

    return rows


def score_quality(documents: DataFrame, labels: DataFrame, held_out: Column, *, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``documents``.

    ``held_out`` is an expression over the id; the model is fitted on all labelled rows for which it is false, by
    sums that each task adds up. A label that is null or neither 0 nor 1 isn't used; several labels of an id count
    as its largest. Without rows of both classes every score is 0.5. Null and empty texts have the statistics of no
    words and are scored; null ids are scored, and ``held_out`` says what the expression gives for them; repeated
    rows are scored one by one (and each counts, if labelled); very long texts are read whole. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = written(texts.mapInArrow(_statistic_rows, f"id {texts.schema['id'].dataType.simpleString()}, x array<double>"), "statistics")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "label in (0, 1) and id is not null").groupBy("id").agg(F.max("label").alias("label"))
    fold = rows.select("id", "x", held_out.alias("held_out")) if id_col == "id" else rows.withColumn(
        id_col, F.col("id")).select("id", "x", held_out.alias("held_out"))
    train = fold.where("not held_out").join(known, "id").select("x", "label")
    size = len(STATISTICS) * (len(STATISTICS) + 1)
    sums = train.mapInArrow(_sum_rows, "label int, n long, sums array<double>").groupBy("label").agg(
        F.sum("n"), F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(size)))).collect()
    model = fit({r[0]: (r[1], np.array(r[2])) for r in sums})
    ids = fold.select(F.struct("id", "held_out").alias("id"), "x")
    scored = ids.mapInArrow(_score_rows(model), f"id {ids.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id.id").alias(id_col), F.col("id.held_out").alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
