"""Language of a text: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with FTRL and elastic-net penalties, then
calibrated with a temperature.

Document frequencies are counted over all training texts. The regression is
fitted on a bounded sample of them (about ``SAMPLE`` documents, as many of
each language, drawn by hash); every fifth document of the sample is left
out of it and sets the temperature.

Defined results: a text that is null, empty or without a letter is ``und``
with score 0. Rows with a null label or a null id teach nothing. With no
label at all every text is ``und``; with one label it is that one. Repeated
rows are predicted alike; a text of any length counts whole; extra columns
are ignored (or carried by ``keep_languages``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import blocks, filter_texts, map_texts, sample_by_hash
from rivulet.llm.ftrl import Ftrl, probabilities, train_in_one_task

UNKNOWN = "und"
BUCKETS = 1 << 14  # hashed n-grams; bucket 0 is the bias
SAMPLE = 8_000  # documents that the regression is fitted on; never over twice as many
EPOCHS = 2
CALIBRATION = 5  # every fifth document of the sample
FTRL = {"alpha": 0.5, "beta": 1.0, "l1": 0.02, "l2": 0.02}
_MIX = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def letters_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed 1-, 2- and 3-grams of the lowered letters of a
    text, other runs as one space; None if it has no letter."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[c]
    if not is_letter.any():
        return None
    c = np.where(is_letter, c, np.uint32(32))
    c = c[np.append(True, is_letter[1:] | is_letter[:-1])]
    one = c * _MIX[0]
    two = one[:-1] ^ (c[1:] * _MIX[1] + np.uint32(1))
    three = two[:-1] * _MIX[2] ^ (c[2:] * _MIX[0] + np.uint32(2))
    counts = np.zeros(BUCKETS, np.int64)
    for h in (one, two, three):
        h = (h ^ (h >> np.uint32(15))) * _MIX[1]
        counts += np.bincount((h >> np.uint32(11)) % np.uint32(BUCKETS - 1) + 1,
                              minlength=BUCKETS)
    return counts


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bias and unit TF-IDF vector, as (features, values)."""
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(x @ x)
    x = x / norm if norm > 0 else x
    return np.append(0, at), np.append(1.0, x)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (BUCKETS, languages)
    temperature: float

    def plain(self) -> tuple:
        """The fields, for a broadcast."""
        return self.languages, self.idf, self.weights, self.temperature

    def predict(self, text: str, letters: np.ndarray) -> tuple[str, float]:
        counts = ngram_counts(text, letters) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        at, x = features(counts, self.idf)
        p = probabilities(x @ self.weights[at] / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def document_frequencies(train: DataFrame, text: str) -> np.ndarray:
    """Texts that have each bucket, over all training texts: each task sums
    its own, so one row per task and bucket is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, df = letters_table(), np.zeros(BUCKETS, np.int64)
        for _, texts in blocks(batches, text):
            for t in texts:
                counts = ngram_counts(t, letters)
                if counts is not None:
                    df += counts > 0
                    df[0] += 1  # all texts with letters
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["bucket", "n"])

    rows = (train.select(text).mapInArrow(count, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    df = np.zeros(BUCKETS, np.int64)
    for r in rows:
        df[r["bucket"]] = r["n"]
    return df


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    def loss(log_t: float) -> float:
        p = probabilities(scores / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    lo, hi, cut = np.log(0.2), np.log(20), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - cut * (hi - lo), lo + cut * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit_language_model(train: DataFrame, text: str = "text", label: str = "lang",
                       id_col: str = "doc_id", sample: int = SAMPLE) -> LanguageModel:
    """Fit on the rows of ``train``: statistics on all, weights on a sample."""
    train = train.filter(F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label"),
        F.col(id_col).alias("id"))
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    languages = sorted(counts)
    if len(languages) < 2:
        return LanguageModel(languages, np.zeros(BUCKETS), np.zeros((BUCKETS, 1)), 1.0)
    df = document_frequencies(train, "text")
    idf = np.log((1 + df[0]) / (1 + df)) + 1
    shares = F.create_map(*[F.lit(v) for x in languages
                            for v in (x, sample / len(languages) / counts[x])])
    rows = sample_by_hash(train.filter("id IS NOT NULL"), F.col("id"),
                          F.element_at(shares, F.col("label")), 2 * sample)

    def fit(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        letters, number = letters_table(), {x: k for k, x in enumerate(languages)}
        seen: list[tuple[np.ndarray, np.ndarray, int]] = []
        for block, texts in blocks(batches, "text"):
            for t, y in zip(texts, block.column("label").to_pylist()):
                counts = ngram_counts(t, letters)
                if counts is not None:
                    at, x = features(counts, idf)
                    seen.append((at.astype(np.uint16), x.astype(np.float32), number[y]))
        left_out = seen[::CALIBRATION]
        taught = [e for k, e in enumerate(seen) if k % CALIBRATION] or seen
        learner = Ftrl(BUCKETS, len(languages), **FTRL)
        for _ in range(EPOCHS):
            for at, x, y in taught:
                learner.learn(at, x, y)
        w = learner.weights(slice(None))
        scores = np.array([x @ w[at] for at, x, _ in left_out])
        t = _temperature(scores, np.array([y for *_, y in left_out])) if left_out else 1.0
        at = np.flatnonzero(np.any(w != 0, axis=1))
        return pa.RecordBatch.from_arrays(
            [pa.array([at.tolist()]), pa.array([w[at].ravel().tolist()]), pa.array([t])],
            ["at", "w", "t"])

    model = train_in_one_task(rows, [F.xxhash64("id"), F.col("id"), F.col("text")],
                              "at array<bigint>, w array<double>, t double", fit)
    weights = np.zeros((BUCKETS, len(languages)))
    if not model:  # every label's id is null
        return LanguageModel(languages, idf, weights, 1.0)
    weights[model[0]["at"]] = np.array(model[0]["w"]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, model[0]["t"])


def language_id(docs: DataFrame, model: LanguageModel, text: str = "text",
                keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row of ``docs``, ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    d = docs.select(*keep, F.col(text).alias("__text"))
    schema = ", ".join([f"`{c}` {t}" for c, t in d.dtypes if c != "__text"]
                       + ["lang_pred string", "score double"])

    def make():
        letters, m = letters_table(), LanguageModel(*shared.value)

        def block(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            made = [m.predict(t, letters) for t in texts]
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([a for a, _ in made]),
                 pa.array([b for _, b in made], pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])
        return block

    return map_texts(d, "__text", schema, make)


def keep_languages(docs: DataFrame, model: LanguageModel, least_score: float = 0.5,
                   text: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, in a language that the model
    knows with a score of at least ``least_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def make():
        letters, m = letters_table(), LanguageModel(*shared.value)

        def keep(texts: list[str]) -> list[bool]:
            made = [m.predict(t, letters) for t in texts]
            return [lang != UNKNOWN and score >= least_score for lang, score in made]
        return keep

    return filter_texts(docs, text, make)
