"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct words, their first four letters (which
stand for inflected forms), word pairs, and pairs with one word between. The
model is learned from at most ``max_rows`` labelled rows, a repeatable sample;
L1 keeps only weights that labels support, and just those are sent around.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import held_out, slices, texts

BUCKET_BITS = 20
THRESHOLD = 0.7
#: labelled rows a model is learned from, at most
MAX_TRAIN_ROWS = 12_000
EPOCHS = 3

_WORDS = re.compile(r"\w+").findall


def features(text: str) -> np.ndarray:
    """Hashed features of a text, repeats included."""
    words = _WORDS(text.lower())
    crc = zlib.crc32
    h = np.array([crc(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    stems = np.array([crc(w[:4].encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    skip = h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    mixed = np.concatenate([h, stems + np.uint64(1 << 40), pair, skip + np.uint64(1 << 41)])
    return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


class Ftrl:
    """Per-coordinate learning rates and L1 sparsity; the bias is not penalised."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
        self.bias, self.bias_n = 0.0, 1.0

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, index: np.ndarray, label: int) -> None:
        w = self.weights(index)
        g = sigmoid(self.bias + w.sum()) - label
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + g * g
        self.bias_n += g * g
        self.bias -= self.alpha * g / np.sqrt(self.bias_n)


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


@dataclass
class Model:
    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BUCKET_BITS, np.float32)
        w[self.index] = self.weight
        return w


def score_of(text: str, bias: float, dense: np.ndarray) -> float:
    index = features(text)
    index = np.unique(index[dense[index] != 0])
    return sigmoid(bias + float(dense[index].sum()))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task: the sample is bounded. Rows are taken in an order of their own."""
    rows = []
    for batch in slices(batches):
        for doc_id, label, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "label", "text"))):
            rows.append((zlib.crc32(b"order %d" % doc_id), label, np.unique(features(text)).astype(np.int32)))
    rows.sort(key=lambda row: (row[0], row[1], len(row[2]), row[2].tobytes()))
    positive = sum(label for _, label, _ in rows)
    model = Ftrl()
    # without both labels there is nothing to tell apart: 0 stands for all
    if 0 < positive < len(rows):
        model.bias = float(np.log(positive / (len(rows) - positive)))
        for _ in range(EPOCHS):
            for _, label, index in rows:
                model.learn(index, label)
        index = np.flatnonzero(np.abs(model.z) > model.l1)
    else:
        model.bias, index = -40.0 if not positive else 40.0, np.zeros(0, np.int64)
    columns = [np.append(index, -1), np.append(model.weights(index), model.bias)]
    yield pa.record_batch([pa.array(c) for c in columns], ["bucket", "weight"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Model of ``labels.toxic``, from rows that are not held out.

    Rows with a NULL id or label teach nothing. A label that repeats an id
    counts by its largest value.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").alias("label"))
    known = known.filter(~held_out(F.col("doc_id"))).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    share = int(1e9 * min(1.0, max_rows / max(1, n)))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_000)) < share)
    # max_rows ids, some hundred kilobytes; a tenth more for the draw
    rows = texts(docs).join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id", "text"])
    rows = rows.select("doc_id", F.col("label").cast("int").alias("label"), "text")
    # the scan stays spread out; only the sample meets in one task
    learned = rows.repartition(1).mapInArrow(_learn, "bucket bigint, weight double").collect()
    found = [r for r in learned if r.bucket >= 0]
    bias = next((r.weight for r in learned if r.bucket < 0), -40.0)
    index = np.array([r.bucket for r in found], np.int64)
    return Model(bias, index, np.array([r.weight for r in found], np.float32))


def _scorer(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)
    dense: list[np.ndarray] = []

    def scores(column: pa.Array) -> list[float]:
        if not dense:
            dense.append(shared.value.dense())
        return [score_of(text or "", shared.value.bias, dense[0]) for text in column.to_pylist()]

    return scores


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    NULL and empty texts get the score of no features. Repeated rows and rows
    without an id are scored like others; an empty table gives no rows.
    """
    scores = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.record_batch([batch["doc_id"], pa.array(scores(batch["text"]), pa.float64())], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` the model does not reject, all columns kept."""
    scores = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pc.less(pa.array(scores(batch[text_col]), pa.float64()), THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
