"""Quality classifier: supervised subword embeddings.

Words, pairs of adjacent words and character n-grams of two to four bytes are hashed to rows of an
embedding table; all pairs of a word with itself share a row, as repetition matters and not of what.
A document is the average of its rows; a softmax over two classes reads it. Both parts are learned
by plain stochastic gradient descent in numpy on a bounded sample of labelled documents. At scoring
time the averaged vector enters the softmax linearly, so each row of the table is first multiplied
with the difference of the output weights: a document then needs one number per feature, and its
score is the same as with the vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.llm.features import RangeHash, joined, mix, words_of
from hourlake.llm.tables import as_bytes, bounded, labelled_sample, remainder

BITS = 18
SIZES = (2, 3, 4)
DIMENSIONS = 16
SCALE = np.float32(25)
#: Bounds of the sample to learn from: documents of either class, and bytes of a document in it.
PER_CLASS = 1500
#: Passes over the sample, and the least number of steps: few documents are gone through more often.
EPOCHS, LEAST_STEPS = 12, 6000
MAX_TRAIN_BYTES = 100_000


def features(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature ids, offsets of the pieces in them) for each kind of feature of a buffer of texts."""
    hashes = RangeHash(data)
    shift = np.uint64(64 - BITS)
    for size in SIZES:
        n = len(data) - size + 1
        if n < 1:
            continue
        ids = hashes(slice(0, n), slice(size, size + n))
        # A range that reaches into the next piece starts in the newline or before it.
        keep = np.ones(n, bool)
        for back in range(1, size + 1):
            at = starts[1:] - back
            keep[at[(at >= 0) & (at < n)]] = False
        places = np.flatnonzero(keep)
        yield (ids[places] >> shift).astype(np.int64), np.searchsorted(places, starts)
    first, last = words_of(data)
    if len(first):
        words = hashes(first, last)
        bounds = np.searchsorted(first, starts)
        yield (mix(words + np.uint64(7)) >> shift).astype(np.int64), bounds
        pairs = mix(words[:-1] * np.uint64(31) + words[1:])
        pairs[words[:-1] == words[1:]] = 0
        keep = np.ones(len(pairs), bool)
        at = bounds[1:-1] - 1
        keep[at[(at >= 0) & (at < len(pairs))]] = False
        places = np.flatnonzero(keep)
        yield (pairs[places] >> shift).astype(np.int64), np.searchsorted(places, bounds)


@dataclass(frozen=True)
class QualityModel:
    """Worth of each feature towards class 1, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for data, starts, owners in joined(texts):
            for ids, bounds in features(data, starts):
                sums = np.concatenate([[0.0], np.cumsum(self.weights[ids], dtype=np.float64)])
                np.add.at(total, owners, sums[bounds[1:]] - sums[bounds[:-1]])
                np.add.at(count, owners, np.diff(bounds))
        margin = total / np.maximum(count, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(
    rows: list[tuple[int, bytes, int]], epochs: int = EPOCHS, rate: float = 0.2, seed: int = 3
) -> QualityModel:
    """Stochastic gradient descent on the cross entropy of the softmax, one document at a time.

    Without rows of both classes there is nothing to learn: the score is the share of class 1, or
    one half without any row.
    """
    labels = np.array([y for _, _, y in rows])
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return QualityModel(np.zeros(1 << BITS, np.float32), float(np.clip(200 * share - 100, -100, 100)))
    bags = []
    for _, text, _ in rows:
        ids = [x for data, starts, _ in joined([text]) for x, _ in features(data, starts)]
        bags.append(np.unique(np.concatenate(ids) if ids else np.zeros(0, np.int64), return_counts=True))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    epochs = max(epochs, -(-LEAST_STEPS // len(rows)))
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        for i in rng.permutation(len(rows)):
            ids, counts = bags[i]
            share = (counts / max(1, counts.sum())).astype(np.float32)
            vector = share @ table[ids] if len(ids) else np.zeros(DIMENSIONS, np.float32)
            logits = output @ vector + bias
            chances = np.exp(logits - logits.max())
            error = (chances / chances.sum()).astype(np.float32)
            error[labels[i]] -= 1
            back = error @ output
            output -= step * np.outer(error, vector)
            bias -= step * error * np.float32(0.1)
            if len(ids):
                table[ids] -= np.outer(share * (step * SCALE), back)
    return QualityModel((table @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


def learn_rows(column: str = "doc_id") -> Column:
    """Rows that may be learned from."""
    return remainder(column, 3) != 1


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    return train(labelled_sample(documents, labels, "quality", learn_rows(), per_class, MAX_TRAIN_BYTES))


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _score_task(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.value.scores(batch.column("_data").to_pylist())
            names = [*batch.schema.names[:-2], "score"]
            columns = [*batch.columns[:-2], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return score


def _keep_task(model, column: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.value.scores(_texts(batch, column)) >= 0.5))

    return keep


def with_scores(documents: DataFrame, model: QualityModel) -> DataFrame:
    """``documents`` with a ``score`` of the whole text, 0 to 1; higher: class 1 is likelier.

    A null or empty text gets the score of the bias alone. Nothing but the text is looked at. A
    column ``score`` of the input is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop("score").withColumn("_data", as_bytes("text")).withColumn("score", F.lit(0.0))
    schema = rows.drop("_data").schema
    return bounded(rows).mapInArrow(_score_task(shared), schema)


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of every document; ``held_out`` rows were not learned from."""
    model = fit(documents, labels)
    return with_scores(documents.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(~learn_rows(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with the columns they came with.

    A null or empty text gets the score of the bias alone; rows are judged one by one, so repeated rows
    stay or go together, and an empty table stays one.
    """
    model = fit(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    column = documents.columns.index("text")
    return bounded(documents).mapInArrow(_keep_task(shared, column), documents.schema)
