"""Quality by supervised subword embeddings: hashed word and character n-gram vectors, averaged per document, softmax.

The vectors and the output layer are learned by numpy stochastic gradient descent (step sizes by the sum of squared
gradients), in one task, from a bounded sample of labelled rows: ``SAMPLE_ROWS`` per class, those with the smallest hashes.
The sample is even between classes; the share of each class among all learnable labels moves the output's bias back.
Scoring needs no vectors: with two classes, each bucket adds its vector's share of the difference of the two outputs.

A null text is empty and gets the score of no features, the bias. Without labels every score is 0.5, with labels of one
class only it is that class. Labels are used as often as they occur; rows that repeat an id are scored each; rows with a
null id are scored and never learned from; other columns and their names have no influence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgauge.llm.common import held_out, pieces
from weirgauge.llm.ngrams import Groups

#: Labelled rows per class that the task learns from, at most.
SAMPLE_ROWS = 1000
BITS, ORDERS, SIZE, EPOCHS, RATE = 16, (3, 4, 5), 8, 8, 0.1


def _groups(texts: pa.Array) -> Groups:
    return Groups(texts, BITS, ORDERS, words=True, pairs=True, repeats=True)


@dataclass
class Model:
    """``table``: what each bucket adds to the difference of the outputs; ``bias``: that difference without features."""

    table: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = np.clip(_groups(texts).means(self.table) + self.bias, -700, 700)
        return 1 / (1 + np.exp(-z))


def train(rows: list[tuple[object, np.ndarray, np.ndarray]], share: float, seed: int = 0) -> Model:
    """From (label 0 or 1, buckets, weights); ``share``: of label 1 among all learnable labels."""
    rng = np.random.default_rng(seed)
    labels = np.array([int(r[0]) for r in rows])
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0 if not len(labels) else 30.0 * (2 * labels[0] - 1))
    vectors = rng.uniform(-1 / SIZE, 1 / SIZE, (1 << BITS, SIZE)).astype(np.float32)
    output, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    seen_v, seen_o, seen_b = np.full(1 << BITS, 1e-8, np.float32), np.full((SIZE, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            label, buckets, weights = rows[i]
            mean = weights @ vectors[buckets]
            logits = mean @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[int(label)] -= 1  # the loss's gradient by the logits
            back = output @ p
            grad_o = np.outer(mean, p)
            seen_o += grad_o**2
            seen_b += p**2
            output -= rate * grad_o / np.sqrt(seen_o)
            bias -= rate * p / np.sqrt(seen_b)
            seen_v[buckets] += weights**2 * (back @ back) / SIZE
            vectors[buckets] -= (rate * weights / np.sqrt(seen_v[buckets]))[:, None] * back
    even = labels.mean()
    prior = math.log(share / (1 - share)) - math.log(even / (1 - even)) if 0 < share < 1 else 0.0
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]) + prior)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, buckets and weights of each (label, text) row."""
    for batch in pieces(batches, limit=1 << 20):
        made = _groups(batch.column("text")).sparse()
        yield pa.RecordBatch.from_arrays([batch.column("label"), *(pa.array([x[i].tobytes() for x in made], pa.binary()) for i in (0, 1))], ["label", "buckets", "weights"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, seed: int = 0) -> Model:
    """Learns from the labels of rows that are not held out, in one task; the driver gets the model only."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
    share = known.agg(F.avg("label")).first()[0] or 0.0
    per_class = [known.where(F.col("label") == c).orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(sample_rows) for c in (0, 1)]
    # the sample has 2 * sample_rows ids, so it is broadcast and the texts stay where they are until they are features
    sample = docs.select("doc_id", "text").join(F.broadcast(per_class[0].unionByName(per_class[1])), F.col("doc_id") == F.col("_id"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(x, np.frombuffer(b, np.uint32), np.frombuffer(w, np.float32)) for batch in batches for x, b, w in zip(*(batch.column(c).to_pylist() for c in ("label", "buckets", "weights")), strict=True)]
        model = train(sorted(rows, key=lambda r: (r[0], r[1].tobytes())), share, seed)
        yield pa.RecordBatch.from_arrays([pa.array([model.table.tobytes()], pa.binary()), pa.array([float(model.bias)])], ["weights", "bias"])

    features = sample.select("label", "text").mapInArrow(_sparse, "label int, buckets binary, weights binary")
    made = features.repartition(1).mapInArrow(learn, "weights binary, bias double").collect()
    return Model(np.frombuffer(made[0].weights, np.float32), made[0].bias) if made else train([], share, seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row; the model is broadcast (2 ** BITS numbers)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(batch.column("text")))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from 0.5)."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of at least 0.5, with all their columns; texts do not leave their tasks."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=1 << 20):
            yield batch.filter(pa.array(model.value.scores(batch.column("text")) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
