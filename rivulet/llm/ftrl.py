"""Follow-the-regularised-leader for linear models over hashed features.

Per-coordinate step sizes (each weight slows down by the gradients it has
seen) and elastic-net penalties: a weight whose accumulated gradient stays
within ``l1`` is exactly zero, so the trained weights are sparse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row


class Ftrl:
    """``outputs`` linear scores over ``dim`` features: softmax over several
    outputs, a logistic function of a single one. Feature 0 is the bias."""

    def __init__(self, dim: int, outputs: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((dim, outputs))
        self.n = np.zeros((dim, outputs))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One example: distinct features ``at`` with values ``x``; ``label``
        is the output's index, or 0 or 1 for a single output."""
        w = self.weights(at)
        p = probabilities(x @ w)
        p[label if len(p) > 1 else 0] -= 1 if len(p) > 1 else label
        g = x[:, None] * p
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Softmax of the last axis, or the logistic function of a single score."""
    if scores.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(scores, -60, 60)))
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_in_one_task(sample: DataFrame, order: list[str], schema: str,
                      fit: Callable[[Iterator[pa.RecordBatch]], pa.RecordBatch]) -> list[Row]:
    """Run ``fit`` over a sample of bounded size, in a fixed order, in one
    task; the rows of the fitted model."""
    one = sample.repartition(1).sortWithinPartitions(*order)
    return one.mapInArrow(lambda batches: iter([fit(batches)]), schema).collect()
