"""Language by error-correcting output codes: each language has a codeword, binary n-gram classifiers predict its bits.

Up to seven languages get the exhaustive code (every split of the languages into two groups), more a random code of
fifteen bits per doubling. The classifiers are logistic, over hashed character n-grams and words, learned on the driver
by stochastic gradient descent from at most ``SAMPLE_ROWS`` rows per language (those with the smallest hashes).
Decoding sums over the bits the logistic loss of the codeword's bit, weighed by how well the bit was learned; the
codeword with the least loss wins, and a small lead over the next is flagged as ambiguous.

Texts that are null or hold no letter are ``und`` with score 0, and so are all texts if no language was learned. Null
languages and ids are never learned from; rows that repeat an id are predicted each; other columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgauge.llm.common import held_out, pieces
from weirgauge.llm.ngrams import Groups

SAMPLE_ROWS = 300
#: Shares that the rows of a language are ranked in first.
SHARES = 64
BITS, ORDERS, EPOCHS, RATE = 15, (1, 2, 3), 5, 0.5
#: A lead below this share of the probability marks a text as ambiguous.
AMBIGUOUS = 0.2
NONE = "und"


def _groups(texts: pa.Array) -> Groups:
    return Groups(texts, BITS, ORDERS, words=True)


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """A codeword of +1 and -1 for each of n languages."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:  # every split, the first language always on the same side
        splits = np.arange(2 ** (n - 1) - 1)
        return np.array([np.ones(len(splits))] + [np.where(splits >> i & 1, 1.0, -1.0) for i in range(n - 1)])
    rng, width = np.random.default_rng(seed), 15 * int(np.ceil(np.log2(n)))
    made = [rng.choice([-1.0, 1.0], (n, width)) for _ in range(32)]

    def nearest(code: np.ndarray) -> float:
        agree = code @ code.T
        return -float((agree - 3 * width * np.eye(n)).max())

    return max(made, key=nearest)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    table: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, score (its probability by the losses) and the lead over the next, for each text."""
        z = _groups(texts).means(self.table) + self.bias
        loss = np.logaddexp(0, -z[:, None, :] * self.codes[None]) @ self.trust
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        ranked = np.sort(p, axis=1)
        return loss.argmin(axis=1), ranked[:, -1], ranked[:, -1] - (ranked[:, -2] if p.shape[1] > 1 else 0)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 0) -> Model:
    """From (language, buckets, weights)."""
    languages = sorted({r[0] for r in rows})
    codes = codewords(len(languages), seed)
    width = codes.shape[1]
    place = {name: i for i, name in enumerate(languages)}
    table, seen = np.zeros((1 << BITS, width), np.float32), np.full((1 << BITS, width), 1e-6, np.float32)
    bias = np.zeros(width)
    rng = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            name, buckets, weights = rows[i]
            want = codes[place[name]]
            z = weights @ table[buckets] + bias
            grad = -want / (1 + np.exp(np.clip(want * z, -50, 50)))
            step = weights[:, None] * grad.astype(np.float32)
            seen[buckets] += step**2
            table[buckets] -= rate * step / np.sqrt(seen[buckets])
            bias -= 0.01 * rate * grad
    right = np.zeros(width)
    for name, buckets, weights in rows:
        right += (weights @ table[buckets] + bias) * codes[place[name]] > 0
    trust = np.maximum(2 * right / max(len(rows), 1) - 1, 0.01)
    return Model(languages, codes, table, bias, trust / trust.sum() if width else trust)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 0) -> Model:
    """Learns from text and language of the rows that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    # a language may hold most rows: its first ones are found among those of each of its shares
    picked = known.withColumn("_share", F.pmod(F.xxhash64(F.lit(seed + 1), "_id"), F.lit(SHARES)))
    for within in (["_lang", "_share"], ["_lang"]):
        by_hash = Window.partitionBy(*within).orderBy(F.xxhash64(F.lit(seed), "_id"), "_id")
        picked = picked.withColumn("_rank", F.row_number().over(by_hash)).where(F.col("_rank") <= sample_rows).drop("_rank")
    picked = picked.drop("_share")
    sample = docs.select("doc_id", "text", "lang").join(F.broadcast(picked.dropDuplicates()), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=1 << 20):
            made = _groups(batch.column("text")).sparse()
            yield pa.RecordBatch.from_arrays([batch.column("_lang"), *(pa.array([x[i].tobytes() for x in made], pa.binary()) for i in (0, 1))], ["lang", "buckets", "weights"])

    rows = sample.select("_lang", "text").mapInArrow(run, "lang string, buckets binary, weights binary").collect()
    made = [(r.lang, np.frombuffer(r.buckets, np.uint32).astype(np.int64), np.frombuffer(r.weights, np.float32)) for r in rows]
    return train(sorted(made, key=lambda r: (r[0], r[1].tobytes())), seed)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, limit=1 << 20):
            letters = batch.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
            names, score, lead = np.full(len(letters), NONE, object), np.zeros(len(letters)), np.zeros(len(letters))
            if model.languages:
                best, score, lead = model.predict(batch.column("text"))
                names = np.where(letters, np.array(model.languages, object)[best], NONE)
            score = np.where(letters, score, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(lead < AMBIGUOUS)], ["doc_id", "lang_pred", "score", "ambiguous"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    return docs.select("doc_id", "text", letters).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
