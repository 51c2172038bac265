"""Bounded samples of labelled rows, and the small models fitted on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str, folds: int = 5) -> Column:
    """True for the documents whose labels are never learned from; false for a null id."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(fold == 0, F.lit(False))


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, *, doc_id: str, text: str
) -> DataFrame:
    """``key, text, y`` of at most ``per_class`` ids of each label 0 and 1, one row an id.

    Those with the least hash of their id are taken among the distinct ids that are
    labelled so and not held out. Ids are sampled first, so what is broadcast has at most
    ``2 * per_class`` rows, and only texts of the sample are shuffled: of an id with several
    the least is taken. A label with no document, or a document without text, gives no row.
    """
    known = labels.select(F.col(doc_id).alias("key"), F.col(label).cast("int").alias("y"))
    known = known.where("key is not null").where(~held_out("key"))
    picked = [
        known.where(F.col("y") == v).distinct().orderBy(F.xxhash64("key"), "key").limit(per_class) for v in (0, 1)
    ]
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    source = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")).where("text is not null")
    return source.join(ids, "key").groupBy("key", "y").agg(F.min("text").alias("text")).select("key", "text", "y")


class Logistic:
    """Logistic regression on standardised features, their squares and products."""

    def __init__(self, x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 60):
        self.prior = float(y.mean()) if len(y) else 0.5
        self.weights = None
        if len(set(y.tolist())) < 2:
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._expand(x)
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = z.T @ (p - y) / len(y) + l2 * w
            hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + l2 * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        self.weights = w

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        n = z.shape[1]
        products = [z[:, i] * z[:, j] for i in range(n) for j in range(i, n)]
        return np.column_stack([np.ones(len(z)), z, *products])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; the share of label 1 if only one label was seen."""
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._expand(x) @ self.weights, -30, 30)))
