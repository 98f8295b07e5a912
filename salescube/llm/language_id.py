"""Language identification.

Sparse multinomial logistic regression on TF-IDF weights of hashed character
n-grams (1 to 3 code points), trained by follow-the-regularised-leader with
elastic-net penalties, with a temperature fitted afterwards.

Document frequencies come from every training document. The classifier is
fitted on a bounded sample: ``sample_per_language`` documents of each language,
or fewer of each where they would be more than ``sample_rows`` in all, chosen by
the hash of the id, of which a fifth only calibrates the temperature. Every label
is learned. What reaches the driver is that sample and a count for each n-gram
bucket and label. The model, a row of weights for each bucket with a number for
each label, is broadcast for prediction, which is one pass without a shuffle.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescube.llm.common import releasing, small

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 15
    sample_per_language: int = 500   # documents of a language in the fitting sample, on average
    sample_rows: int = 100_000       # bound of the fitting sample, spread over all labels, at least some of each
    least_per_language: int = 20
    epochs: int = 3
    alpha: float = 0.5               # FTRL learning rate
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.001


@functools.cache
def _letters() -> np.ndarray:
    """Every code point itself if it is a letter, else a blank."""
    every = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    alpha = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, len(every))
    return np.where(alpha, every, 32).astype(np.uint32)


def ngrams(text: str, buckets: int) -> np.ndarray:
    """Bucket of every n-gram of 1 to 3 code points of the whole lower-cased text.

    Everything but letters counts as a blank, and n-grams of blanks alone are
    left out. No letters give no n-grams.
    """
    c = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)].astype(np.uint64)
    c = c[(c != 32) | (np.roll(c, 1) != 32)]  # a run of blanks is one
    if not len(c) or not (c != 32).any():
        return np.empty(0, np.int64)
    c = np.concatenate([[np.uint64(32)], c, [np.uint64(32)]])
    two = c[:-1] * np.uint64(0x1F123BB5) + c[1:]
    three = two[:-1] * np.uint64(0x1F123BB5) + c[2:]
    grams = np.concatenate([c[c != 32], two, three])
    grams *= np.uint64(0x9E3779B97F4A7C15)
    return (grams >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64)


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of unit length; both empty if there are no letters."""
    counts = np.bincount(ngrams(text, len(idf)), minlength=len(idf))
    at = np.flatnonzero(counts)
    w = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt(w @ w)
    return (at, w / norm) if norm > 0 else (at[:0], w[:0])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader with per-coordinate rates and L1 and L2 penalties."""

    def __init__(self, buckets: int, classes: int, s: Settings):
        self.s = s
        self.z = np.zeros((buckets + 1, classes))
        self.n = np.zeros((buckets + 1, classes))

    def weights(self, at) -> np.ndarray:
        s, z = self.s, self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)  # the last row is the bias
        w = self.weights(at)
        p = _softmax(x @ w)
        p[label] -= 1.0
        g = x[:, None] * p[None, :]
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = more


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets + 1 rows, the last is the bias
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); ``und`` with 0 for null or no letters."""
        at, x = tfidf(text, self.idf) if text and self.languages else ((), ())
        if not len(at):
            return UNDETERMINED, 0.0
        p = _softmax((x @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on a grid of factors of 1.05 from 0.05 to 20."""
    if not len(labels):
        return 1.0
    grid = 0.05 * 1.05 ** np.arange(123)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def document_frequencies(docs: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Documents that have each bucket, over all rows; with their number at the end."""
    @releasing()
    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, np.int64)
        for frame in small(frames, text_col):
            for text in frame.column(0).to_pylist():
                if text:
                    total[np.unique(ngrams(text, buckets))] += 1
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "docs"])

    counted = (docs.select(text_col).mapInArrow(count, "bucket long, docs long")
               .groupBy("bucket").agg(F.sum("docs").alias("docs")).toPandas())
    out = np.zeros(buckets + 1, np.int64)
    out[counted["bucket"].to_numpy(np.int64)] = counted["docs"].to_numpy(np.int64)
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          settings: Settings = Settings()) -> Model:
    """Learn from all rows of ``docs`` with a label. No labels give a model that knows no language.

    Null and empty texts and texts without letters teach nothing. However rare,
    every label is among those learned and predicted.
    """
    s = settings
    labelled = docs.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    sizes = labelled.groupBy("label").count().collect()
    languages = sorted(r["label"] for r in sizes)
    if not languages:
        return Model([], np.ones(s.buckets), np.zeros((s.buckets + 1, 1)), 1.0)
    frequency = document_frequencies(labelled, "text", s.buckets)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1.0

    # The hash of the id picks a share of each language that makes about the bound.
    quota = max(s.least_per_language, min(s.sample_per_language, s.sample_rows // len(languages)))
    shares = docs.sparkSession.createDataFrame(
        [(r["label"], min(1.0, quota / r["count"])) for r in sizes], "label string, share double")
    draw = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = labelled.join(F.broadcast(shares), "label").where(draw < F.col("share"))  # a row for each label

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [tfidf(t or "", idf) for t in frame["text"]]
            yield pd.DataFrame({"order": frame["order"], "label": frame["label"],
                                "at": [a.astype(np.int32).tobytes() for a, _ in got],
                                "x": [x.astype(np.float32).tobytes() for _, x in got]})

    sample = (rows.select(F.xxhash64(F.lit(13), "id").alias("order"), "label", "text")
              .mapInPandas(vectors, "order long, label string, at binary, x binary").toPandas())
    sample = sample.sort_values(["order", "label", "at", "x"], kind="stable", ignore_index=True)
    names = {name: i for i, name in enumerate(languages)}
    labels = sample["label"].map(names).to_numpy(int)
    at = [np.frombuffer(b, np.int32) for b in sample["at"]]
    x = [np.frombuffer(b, np.float32).astype(float) for b in sample["x"]]
    used = np.array([len(a) > 0 for a in at], bool)
    calibrate = used & (np.arange(len(labels)) % 5 == 4)
    model = Ftrl(s.buckets, len(languages), s)
    for _ in range(s.epochs):
        for i in np.flatnonzero(used & ~calibrate):
            model.learn(at[i], x[i], labels[i])
    w = model.weights(slice(None))
    held = np.flatnonzero(calibrate)
    logits = np.array([x[i] @ w[at[i]] + w[-1] for i in held]).reshape(len(held), len(languages))
    return Model(languages, idf, w, fit_temperature(logits, labels[held]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` with the prediction; columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in (pred_col, score_col)]

    @releasing()
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in small(frames, text_col):
            got = [shared.value.predict(t) for t in frame.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [frame.column(c) for c in kept]
                + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                kept + [pred_col, score_col])

    schema = docs.select(*kept).schema.add(pred_col, "string").add(score_col, "double")
    return docs.select(*kept).mapInArrow(batches, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """One document in five, by the checksum of its id as text; null ids are never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_predictions(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out()))
    return (predict(docs.select("doc_id", "text", held_out().alias("held_out")), model)
            .select("doc_id", "held_out", "lang_pred", "score"))
