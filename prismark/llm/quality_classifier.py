"""Operator 8: regularised quadratic discriminant.

Every text becomes a vector of transformed statistics.  Per class, Spark sums
the vectors and their products over the labelled rows; from these sums (two
small matrices, whatever the input) come class means and covariances, which
are shrunk towards a multiple of the identity on standardised statistics.  A
score is the logistic of the difference of the two log densities: Mahalanobis
distances by triangular solves with the Cholesky factors, computed once on the
driver and shipped with the function.

Defined cases: null text counts as empty and is scored like any other; labels
other than 0 and 1, null labels and labels of unknown rows are not learned; a
repeated label counts as often as it occurs; with a class of fewer than two
rows every score is 0.5; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from prismark.llm.docstats import FEATURES, with_stats
from prismark.llm.runtime import stored


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def class_sums(rows: DataFrame, label: str, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: count, sum of ``x`` and sum of its outer products."""
    x = F.col("x")
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*(F.sum(x[i]) for i in range(d))).alias("s"),
        F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("p"),
    )
    out = {}
    for r in sums.collect():  # at most two rows
        square = np.zeros((d, d))
        for (i, j), v in zip(pairs, r["p"]):
            square[i, j] = square[j, i] = v
        out[int(r[label])] = float(r["n"]), np.array(r["s"]), square
    return out


class Discriminant:
    """Class means and Cholesky factors on standardised statistics."""

    def __init__(self, sums: dict, shrink: float, floor: float):
        n = sum(s[0] for s in sums.values())
        mean = sum(s[1] for s in sums.values()) / n
        spread = np.diag(sum(s[2] for s in sums.values())) / n - mean**2
        self.mean, self.scale = mean, np.sqrt(np.maximum(spread, 0)) + floor
        self.classes = {}
        for k, (m, s, p) in sums.items():
            mu = s / m
            cov = (p / m - np.outer(mu, mu)) / np.outer(self.scale, self.scale)
            cov = (1 - shrink) * cov + shrink * max(np.trace(cov) / len(cov), floor) * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            self.classes[k] = (mu - mean) / self.scale, factor, 2 * np.log(np.diag(factor)).sum()

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        log = {}
        for k, (mu, factor, det) in self.classes.items():
            u = np.linalg.solve(factor, (z - mu).T)
            log[k] = -0.5 * ((u**2).sum(axis=0) + det)
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0], -700, 700)))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", shrink: float = 0.1, floor: float = 1e-3):
    """The discriminant of labelled rows that are not held out; None if a class has fewer than two."""
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("_label"))
    rows = stats.where(~held_out()).select("doc_id", "x").join(known, "doc_id")
    sums = class_sums(rows, "_label", len(FEATURES))
    if len(sums) < 2 or min(s[0] for s in sums.values()) < 2:
        return None
    return Discriminant(sums, shrink, floor)


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, shrink: float = 0.1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    stats = stored(with_stats(docs, id_col, text_col).select("doc_id", "x"), "classifier-stats")
    model = fit(stats, labels, label, shrink)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if model is None or not len(x):
            return pd.Series(np.full(len(x), 0.5))
        return pd.Series(model.score(np.stack(x.to_numpy())))

    return stats.select("doc_id", held_out().alias("held_out"), score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
