"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text gives a vector of statistics, transformed so that they are roughly normal. For each class the labelled
rows give mean and covariance; sums and products are added up per task, so that the driver receives one small matrix per
class. The covariance is shrunk, Sigma = (1 - a) * own + a * pooled + r * diag(pooled), and factorised once (Cholesky).
A document's score is the logistic function of the tempered difference of the two log densities, that is of Mahalanobis
distances by the cached factors and of log determinants, plus the log ratio of the classes.

Labels are learned only from rows outside the held-out fold, crc32(doc_id as text) mod 5 = 0. Only the text enters a
score.

Defined cases: a null text counts as empty and gets the score of an empty text; a null id is never held out and never
labelled; null labels and labels other than 0 and 1 are passed over; a document labelled twice counts twice; with no
labelled row of one class every score is the share of class 1 (0.5 with no label at all); rows repeat as in the input;
an empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import own_columns
from fiscalmill.sources.staging import stage

SHRINKAGE = 0.15
RIDGE = 0.02
TEMPER = 0.25
"""Factor on the difference of log densities. Statistics are dependent, so the plain difference is far too sure."""
THRESHOLD = 0.3
FOLDS = 5

FEATURES = [
    "log_words", "word_length", "symbols", "capitals", "digits", "exclamations", "stops", "commas", "pipes",
    "distinct_words", "distinct_pairs", "doubled_words", "words_per_line", "long_words", "other_bytes",
]


def _byte_set(characters: bytes) -> np.ndarray:
    return np.array([b in characters for b in range(256)], np.float64)


BYTES = np.stack([
    _byte_set(b"#*$%&<>@~^_=+\\{}[]"), _byte_set(bytes(range(65, 91))), _byte_set(b"0123456789"), _byte_set(b"!?"),
    _byte_set(b"."), _byte_set(b",;:"), _byte_set(b"|"), _byte_set(b"\n"), _byte_set(bytes(range(128, 256))),
])
"""Classes of bytes whose shares are statistics."""


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    symbols, capitals, digits, exclamations, stops, commas, pipes, lines, other = BYTES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    n = len(words)
    pairs = max(1, n - 1)
    per_word = lambda x: np.log1p(10.0 * x / (n + 1))
    characters = sum(map(len, words))
    return np.array([
        np.log1p(n), np.log1p(characters / max(1, n)), per_word(symbols), np.sqrt(capitals / (len(raw) + 1)), per_word(digits),
        per_word(exclamations), per_word(stops), per_word(commas), per_word(pipes),
        len(set(words)) / max(1, n) ** 0.85, len(set(zip(words, words[1:]))) / pairs,
        np.sqrt(sum(map(operator.eq, words, words[1:])) / pairs), np.log1p(n / (lines + 1)),
        np.sqrt(sum(len(w) > 20 for w in words) / max(1, n)), np.sqrt(other / (len(raw) + 1)),
    ])


def _featurise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        x = np.array([statistics(t) for t in part["text"]]) if len(part) else np.zeros((0, len(FEATURES)))
        yield pd.DataFrame({"doc_id": part["doc_id"], "x": list(x)})


def features(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every text, as a written table: texts are read once for training and scoring."""
    return stage(own_columns(docs, "doc_id", "text").mapInPandas(_featurise, "doc_id long, x array<double>"), "text-statistics")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log determinants by class; log ratio of class 1 to class 0."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    determinants: list[float]
    log_ratio: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of statistics; without both classes the same for all."""
        if not self.means:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_ratio)))
        density = [
            -0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.determinants, strict=True)
        ]
        return 1 / (1 + np.exp(-np.clip(TEMPER * (density[1] - density[0]) + self.log_ratio, -30, 30)))


def fit(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Model:
    """Model from (rows, sums, sums of products) by class."""
    rows = {c: moments[c][0] if c in moments else 0 for c in (0, 1)}
    log_ratio = float(np.log((rows[1] + 0.5) / (rows[0] + 0.5))) if sum(rows.values()) else 0.0
    if min(rows.values()) < 2:
        return Model([], [], [], log_ratio)
    means = [moments[c][1] / rows[c] for c in (0, 1)]
    own = [moments[c][2] / rows[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (rows[0] * own[0] + rows[1] * own[1]) / (rows[0] + rows[1])
    factors, determinants = [], []
    for c in (0, 1):
        shrunk = (1 - shrinkage) * own[c] + shrinkage * pooled + np.diag(ridge * np.diag(pooled) + 1e-6)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        determinants.append(float(2 * np.log(np.diag(lower)).sum()))
    return Model(means, factors, determinants, log_ratio)


MOMENTS = "quality int, n long, s array<double>, p array<double>"


def _moments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, sums and sums of products by class of one task."""
    size = len(FEATURES)
    sums = {c: [0, np.zeros(size), np.zeros((size, size))] for c in (0, 1)}
    for part in parts:
        for c in (0, 1):
            own = part["x"][part["quality"] == c]
            if len(own):
                x = np.stack(own.to_list())
                sums[c][0] += len(x)
                sums[c][1] += x.sum(axis=0)
                sums[c][2] += x.T @ x
    rows = [(c, n, s, p.ravel()) for c, (n, s, p) in sums.items() if n]
    yield pd.DataFrame(rows, columns=["quality", "n", "s", "p"])


def train(vectors: DataFrame, labels: DataFrame) -> Model:
    """Fits on the labelled rows outside the held-out fold. The driver receives sums of fixed size, no rows."""
    known = own_columns(labels, "doc_id", "quality").where("quality in (0, 1) and doc_id is not null")
    known = known.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("quality"))
    per_task = vectors.join(known, "doc_id").select("quality", "x").mapInPandas(_moments, MOMENTS)
    size = len(FEATURES)
    added = lambda c, n: [F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for i in range(n)]
    summed = per_task.groupBy("quality").agg(F.sum("n").alias("n"), *added("s", size), *added("p", size * size))
    moments = {}
    for row in summed.collect():
        values = np.array(row[2:], np.float64)
        moments[row["quality"]] = (row["n"], values[:size], values[size:].reshape(size, size))
    return fit(moments)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    vectors = features(docs)
    model = train(vectors, labels)

    def scored(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = np.stack(part["x"].to_list()) if len(part) else np.zeros((0, len(FEATURES)))
            yield pd.DataFrame({"doc_id": part["doc_id"], "score": model.score(x)})

    found = vectors.mapInPandas(scored, "doc_id long, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
