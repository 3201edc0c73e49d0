"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text gives twelve statistics, transformed to be roughly normal. Per class the mean and covariance come
from sums that Spark aggregates over all labelled rows that may be learned from. A class covariance is
shrunk towards the diagonal of the pooled one, factored once by Cholesky, and the factor's inverse is
shipped to the tasks; a score is the logistic of the difference of Mahalanobis log-densities plus log priors.

Null texts count as empty; empty texts have statistics (zeros) and so a score. Rows without an id are
scored, never learned from. Labels that contradict each other for one id are left out. With fewer than two
classes known every score is the smoothed share of label 1. Repeated rows each give a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomgrid.llm.common import per_text, store, training_labels

SHRINKAGE = 0.1
RIDGE = 1e-3
KEEP_AT = 0.7

_SYMBOLS = b"#*$%&|<>~^{}[]=+_"
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_SENTENCE_ENDS = b".?"

STATISTICS = (
    "words",
    "word_length",
    "capitals",
    "symbols",
    "digits",
    "shouts",
    "wordless",
    "echoes",
    "variety",
    "ends",
    "line_words",
    "repeated_lines",
)


def statistics(text: bytes) -> tuple[float, ...]:
    """Transformed statistics of one text: logarithms of sizes, square roots of shares."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    size = len(text)
    solid = sum(map(len, words))
    distinct = set(words)
    lines = [x for x in text.split(b"\n") if x.strip()]

    def count(kind: bytes) -> int:
        return size - len(text.translate(None, kind))

    wordless = sum(1 for w in distinct if not w.translate(None, _WORDLESS))
    if wordless:
        wordless = sum(1 for w in words if not w.translate(None, _WORDLESS))
    echoes = sum(map(bytes.__eq__, words[1:], words[:-1]))
    return (
        math.log1p(n),
        math.log1p(solid / n),
        math.sqrt(count(_CAPITALS) / solid),
        math.sqrt(count(_SYMBOLS) / solid),
        math.sqrt(count(_DIGITS) / solid),
        math.sqrt(min(1.0, count(b"!") / n)),
        math.sqrt(wordless / n),
        math.sqrt(echoes / n),
        math.log1p(len(distinct)) / math.log1p(n),
        math.sqrt(min(1.0, count(_SENTENCE_ENDS) / n)),
        math.log1p(n / len(lines)),
        math.sqrt((len(lines) - len(set(lines))) / len(lines)),
    )


_WORDLESS = bytes(b for b in range(128) if b not in _LETTERS and b not in _DIGITS)


def _prepare() -> Callable[[bytes], tuple]:
    return statistics


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and one column per statistic; texts are read once and go no further."""
    columns = ", ".join(f"{s} double" for s in STATISTICS)
    return per_text(docs, f"doc_id bigint, {columns}", _prepare, "doc_id")


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, inverse Cholesky factor, log determinant and log prior; or one constant."""

    classes: tuple[tuple[np.ndarray, np.ndarray, float, float], ...]
    constant: float

    def differences(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 minus that of class 0, priors included."""
        found = []
        for mean, inverse, logdet, prior in self.classes:
            z = (x - mean) @ inverse.T
            found.append(prior - logdet / 2 - (z * z).sum(axis=1) / 2)
        return found[1] - found[0]

    def score(self, columns: tuple[str, ...] = STATISTICS) -> Column:
        def run(*parts: pa.Array) -> pa.Array:
            x = np.column_stack([p.to_numpy(zero_copy_only=False) for p in parts])
            if not self.classes:
                return pa.array(np.full(len(x), self.constant))
            return pa.array(1.0 / (1.0 + np.exp(-np.clip(self.differences(x), -700, 700))))

        return F.arrow_udf(run, T.DoubleType(), F.ArrowUDFType.SCALAR)(*(F.col(c) for c in columns))


def fit(measured: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """`measured` has doc_id and statistics; `labels` has doc_id and label 0 or 1."""
    width = len(STATISTICS)
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    sums = (
        measured.join(labels, "doc_id")
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*(F.sum(s) for s in STATISTICS)).alias("s"),
            F.array(*(F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])) for i, j in pairs)).alias("p"),
        )
        .collect()
    )
    by = {r["label"]: r for r in sums}
    rows = sum(r["n"] for r in sums)
    constant = ((by[1]["n"] if 1 in by else 0) + 1) / (rows + 2)
    if len(by) < 2:
        return Discriminant((), constant)
    moments = {}
    for label, r in by.items():
        mean = np.array(r["s"]) / r["n"]
        square = np.zeros((width, width))
        for (i, j), v in zip(pairs, r["p"], strict=True):
            square[i, j] = square[j, i] = v / r["n"]
        moments[label] = (r["n"], mean, square - np.outer(mean, mean))
    pooled = sum(n * np.diag(c) for n, _, c in moments.values()) / rows
    classes = []
    for label in (0, 1):
        n, mean, covariance = moments[label]
        weight = max(shrinkage, width / (width + n))
        shrunk = (1 - weight) * covariance + weight * np.diag(pooled) + RIDGE * np.eye(width)
        factor = np.linalg.cholesky(shrunk)
        logdet = 2 * float(np.log(np.diag(factor)).sum())
        classes.append((mean, np.linalg.inv(factor), logdet, math.log(n / rows)))
    return Discriminant(tuple(classes), constant)


def quality(docs: DataFrame, labels: DataFrame, held_out: Column, keep_at: float = KEEP_AT) -> DataFrame:
    """doc_id, held_out, score, predicted per row of `docs`; `held_out` is an expression over doc_id."""
    measured = store(document_statistics(docs), "statistics")
    model = fit(measured, training_labels(labels, "quality", held_out))
    scored = measured.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= keep_at).cast("int"))
