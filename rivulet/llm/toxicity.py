"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text, each counted once: its words, their stems (first
letters, so that an inflected form not met in training still counts), word
pairs and skip-grams with one or two words between. L1 sparsity leaves few
weights, which are broadcast.

The regression is fitted on a bounded sample (``SAMPLE`` labelled rows, those
of the smallest hash) of the labelled rows that are not held out, with one
text each: of a document's several rows the one of the smallest text hash.

Defined results: null and empty texts have the bias alone and get its score.
Null labels and null ids teach nothing; of several labels of a document the
highest counts. Without labels every score is 0.5 - the model knows nothing.
Repeated rows are scored alike; texts of any length count whole; extra
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import blocks, map_texts
from rivulet.llm.ftrl import Ftrl, probabilities, train_in_one_task

BITS = 20  # hashed features; feature 0 is the bias
HALF = 1 << (BITS - 1)
STEMS = (4, 6)
SKIPS = (0, 1, 2)  # words between the two of a pair
SAMPLE = 12_000  # labelled rows that are fitted on, at most
EPOCHS = 3
# Single words and stems count 1; a pair is rarer and noisier, and counts less.
PAIR = 0.4
FTRL = {"alpha": 0.5, "beta": 1.0, "l1": 4.0, "l2": 1.0}
WORDS_PER_TABLE = 200_000
CHARS_PER_TABLE = 8_000_000  # of its words
_WORD = re.compile(r"\w+")


class Hasher:
    """Features of texts. The hashes of words are kept in a bounded table.

    Words and stems are hashed into the lower half of the features, pairs
    into the upper."""

    def __init__(self, limit: int = WORDS_PER_TABLE):
        self.limit = limit
        self.row: dict[str, int] = {}
        self.hashes: list[tuple[int, ...]] = []
        self.chars = 0

    def _add(self, words: set[str]) -> None:
        if len(self.row) > self.limit or self.chars > CHARS_PER_TABLE:
            self.row, self.hashes, self.chars = {}, [], 0
        for w in words:
            if w not in self.row:
                self.row[w] = len(self.hashes)
                self.chars += len(w)
                self.hashes.append((zlib.crc32(w.encode("utf-8", "surrogatepass")),
                                    *[zlib.crc32(f"{n}:{w[:n]}".encode("utf-8", "surrogatepass"))
                                      for n in STEMS]))

    def features(self, text: str) -> np.ndarray:
        """The distinct features of a text, bias first."""
        words = _WORD.findall(text.lower())
        if not words:
            return np.zeros(1, np.int64)
        self._add(set(words))
        h = np.array([self.hashes[self.row[w]] for w in words], np.uint64)
        word = h[:, 0]
        pairs = [word[:-1 - skip] * np.uint64(0x9E3779B97F4A7C15)
                 + word[1 + skip:] * np.uint64(2 * skip + 3) for skip in SKIPS]
        single = np.maximum(_bucket(h.ravel()), 1)
        pair = _bucket(np.concatenate(pairs)) + HALF
        return np.concatenate([[0], np.unique(single), np.unique(pair)]).astype(np.int64)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(65 - BITS)).astype(np.int64)


def values(at: np.ndarray) -> np.ndarray:
    return np.where(at < HALF, 1.0, PAIR)


def training_labels(labels: DataFrame, label: str, id_col: str, sample: int) -> DataFrame:
    """(id, label) of at most ``sample`` labelled rows, the smallest by hash."""
    return (labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label"))
            .orderBy(F.xxhash64("id"), "id").limit(sample))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic",
                 id_col: str = "doc_id", sample: int = SAMPLE) -> dict[int, float]:
    """Sparse weights from the texts of the rows that ``labels`` names."""
    picked = training_labels(labels, label, id_col, sample)
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
            .join(F.broadcast(picked), "id")
            .groupBy("id", "label").agg(one.alias("one")).select("id", "label", "one.text"))

    def fit(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        hasher, learner = Hasher(), Ftrl(1 << BITS, 1, **FTRL)
        seen = []
        for block, texts in blocks(batches, "text"):
            for t, y in zip(texts, block.column("label").to_pylist()):
                seen.append((hasher.features(t).astype(np.int32), y))
        for _ in range(EPOCHS):
            for at, y in seen:
                learner.learn(at, values(at), y)
        w = learner.weights(slice(None))[:, 0] * values(np.arange(1 << BITS))
        at = np.flatnonzero(w)
        return pa.RecordBatch.from_arrays([pa.array([at.tolist()]), pa.array([w[at].tolist()])],
                                          ["at", "w"])

    fitted = train_in_one_task(rows, [F.xxhash64("id"), F.col("id"), F.col("text")],
                               "at array<bigint>, w array<double>", fit)
    return dict(zip(fitted[0]["at"], fitted[0]["w"])) if fitted else {}


def toxicity(docs: DataFrame, weights: dict[int, float], text: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row of ``docs``, and ``score`` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    d = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{c}` {t}" for c, t in d.dtypes if c != "__text"] + ["score double"])

    def make():
        hasher, w = Hasher(), np.zeros(1 << BITS)
        for at, weight in shared.value.items():
            w[at] = weight

        def block(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            scores = np.array([w[hasher.features(t)].sum() for t in texts])  # w holds PAIR
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(probabilities(scores[:, None])[:, 0])],
                [*batch.schema.names[:-1], "score"])
        return block

    return map_texts(d, "__text", schema, make)
