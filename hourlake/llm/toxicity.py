"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score over its hashed words and their
first few bytes, so that inflected forms are known by their stem; a document is toxic if any
sentence is: P = 1 - product(1 - p). Only documents carry labels; the gradient of that noisy-or
shares a document's label out over its sentences. The learned sentence scores then locate the
offending sentences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.features import IS_SPACE, RangeHash, joined, mix, words_of
from hourlake.llm.tables import as_bytes, bounded, labelled_sample, remainder

BITS = 20
#: Lengths in bytes of the word beginnings that are features beside the words.
STEMS = (5, 6, 7, 8)
#: Bounds of the sample to learn from: documents of either class, and bytes of a document in it.
PER_CLASS = 2000
MAX_TRAIN_BYTES = 50_000
#: L1 penalty, in pulls of one toxic document.
PENALTY = 0.5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True
#: Words are runs of letters, digits and bytes of other alphabets.
_BREAKS = np.array([not (b >= 0x80 or chr(b).isalnum()) for b in range(256)]) | IS_SPACE

SENTENCES = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType(), False),
            T.StructField("end", T.LongType(), False),
            T.StructField("score", T.DoubleType(), False),
        ]
    ),
    False,
)


def sentences(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a buffer of texts: feature ids, sentence number of each feature, first byte and the byte
    after the last of each sentence with a word, piece number of each sentence. A sentence runs up
    to ``.``, ``!``, ``?`` or a line end."""
    lower = _LOWER[data]
    first, last = words_of(lower, _BREAKS)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    hashes = RangeHash(lower)
    number = np.cumsum(_ENDS[data])[first]
    new = np.concatenate([[True], number[1:] != number[:-1]])
    opens = np.flatnonzero(new)
    closes = np.append(opens[1:], len(first)) - 1
    piece = np.searchsorted(starts, first[opens], side="right") - 1
    number = np.cumsum(new) - 1
    ids, numbers = [hashes(first, last)], [number]
    for size in STEMS:
        longer = last - first > size
        ids.append(mix(hashes(first[longer], first[longer] + size) + np.uint64(size)))
        numbers.append(number[longer])
    features = (np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int64)
    return features, np.concatenate(numbers), first[opens], last[closes], piece


@dataclass(frozen=True)
class ToxicityModel:
    """Weight of each hashed feature in a sentence's logit, and the bias."""

    weights: np.ndarray
    bias: float

    def judge(self, texts: list[bytes], locate: float = 0.5) -> tuple[np.ndarray, list[list[dict]]]:
        """Document scores; byte spans and scores of the sentences of at least ``locate``."""
        clean = np.zeros(len(texts))
        spans: list[list[dict]] = [[] for _ in texts]
        base = np.zeros(len(texts), np.int64)
        for data, starts, owners in joined(texts):
            ids, number, first, last, piece = sentences(data, starts)
            if len(ids):
                logits = np.bincount(number, self.weights[ids]) + self.bias
                owner = owners[piece]
                clean -= np.bincount(owner, np.logaddexp(0, logits), minlength=len(texts))
                chances = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
                for s in np.flatnonzero(chances >= locate):
                    at = base[owner[s]] - starts[piece[s]]
                    span = {"start": int(first[s] + at), "end": int(last[s] + at)}
                    spans[owner[s]].append(span | {"score": float(chances[s])})
            # Pieces of one text follow each other: what comes next starts behind them.
            for p, owner_of in enumerate(owners):
                base[owner_of] += starts[p + 1] - starts[p] - 1
        return -np.expm1(clean), spans


def train(
    rows: list[tuple[int, bytes, int]],
    toxic_share: float | None = None,
    rounds: int = 200,
    rate: float = 0.3,
) -> ToxicityModel:
    """Proximal gradient descent on the noisy-or likelihood of the document labels, with steps
    scaled by the recent size of each weight's gradient, and shrinking to nothing.

    ``toxic_share`` is that of all labelled documents; the sample's classes are weighed to it. Most
    words are met once or twice and say nothing: only features of two toxic documents are learned,
    and an L1 penalty leaves those with repeated evidence. The bias starts where a document of
    average length has the chance that its class has. Without rows of both classes the score of a
    sentence is a constant near the seen class.
    """
    labels = np.array([y for _, _, y in rows])
    weights = np.zeros(1 << BITS)
    if len(set(labels.tolist())) < 2:
        return ToxicityModel(weights, 8.0 if len(labels) and labels[0] == 1 else -8.0)
    seen_in = np.zeros(1 << BITS, np.int32)
    for _, text, y in rows:
        if y == 1:
            ids = [sentences(data, starts)[0] for data, starts, _ in joined([text])]
            seen_in[np.unique(np.concatenate(ids))] += 1
    word_ids, word_sentence, sentence_document = [], [], []
    seen = 0
    for document, (_, text, _) in enumerate(rows):
        for data, starts, _ in joined([text]):
            ids, number, first, *_ = sentences(data, starts)
            known = seen_in[ids] > 1
            word_ids.append(ids[known])
            word_sentence.append(number[known] + seen)
            sentence_document.append(np.full(len(first), document))
            seen += len(first)
    ids, where = np.unique(np.concatenate(word_ids), return_inverse=True)
    sentence, document = np.concatenate(word_sentence), np.concatenate(sentence_document)
    toxic = labels.mean() if toxic_share is None else toxic_share
    share = np.where(labels == 1, toxic / labels.sum(), (1 - toxic) / (1 - labels).sum())
    held, bias = np.zeros(len(ids)), float(np.log(toxic * len(rows) / max(1, seen)))
    past, past_bias = np.full(len(ids), share.min() ** 2), share.min() ** 2
    for turn in range(rounds):
        penalty = PENALTY * share[labels == 1].max()
        logits = np.bincount(sentence, held[where], minlength=seen) + bias
        chances = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        clean = np.exp(-np.bincount(document, np.logaddexp(0, logits), minlength=len(rows)))
        pull = share * np.where(labels == 1, -clean / np.maximum(1 - clean, 1e-6), 1.0)
        slope = chances * pull[document]
        total = slope.sum()
        slope = np.bincount(where, slope[sentence], minlength=len(ids))
        past = 0.9 * past + 0.1 * slope**2
        past_bias = 0.9 * past_bias + 0.1 * total**2
        pace = rate * (1 - turn / rounds)
        step = pace / np.sqrt(past)
        held -= step * slope
        held = np.sign(held) * np.maximum(np.abs(held) - step * penalty, 0)
        bias -= pace * total / np.sqrt(past_bias)
    weights[ids] = held
    return ToxicityModel(weights, float(bias))


def learn_rows(column: str = "doc_id") -> Column:
    """Rows that may be learned from."""
    return remainder(column, 5) != 0


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    share = labels.where(learn_rows() & F.col("toxic").isin(0, 1)).agg(F.avg("toxic")).first()[0]
    rows = labelled_sample(documents, labels, "toxic", learn_rows(), per_class, MAX_TRAIN_BYTES)
    return train(rows, share)


def _in_characters(text: bytes, spans: list[dict]) -> list[dict]:
    if not spans:
        return spans
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    characters = np.concatenate([[0], np.cumsum(begins)])
    return [s | {k: int(characters[s[k]]) for k in ("start", "end")} for s in spans]


def _judge_task(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_data").to_pylist()
            scores, spans = model.value.judge(texts)
            found = [_in_characters(t, s) for t, s in zip(texts, spans, strict=True)]
            kind = batch.schema.field("offending").type
            columns = [*batch.columns[:-3], pa.array(scores, pa.float64()), pa.array(found, kind)]
            names = [*batch.schema.names[:-3], "score", "offending"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return judge


def with_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``documents`` with the ``score`` of the whole text, 0 to 1, and ``offending``: start and end
    (in characters of the text) and score of each sentence that is toxic rather than not.

    A text without words scores 0. Nothing but the text is looked at. Columns ``score`` and
    ``offending`` of the input are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = (
        documents.drop("score", "offending")
        .withColumn("_data", as_bytes("text"))
        .withColumn("score", F.lit(0.0))
        .withColumn("offending", F.array().cast(SENTENCES))
    )
    return bounded(rows).mapInArrow(_judge_task(shared), rows.drop("_data").schema)


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score, verdict and offending sentences of every document; ``held_out`` rows were not
    learned from."""
    model = fit(documents, labels)
    return with_toxicity(documents.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(~learn_rows(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").cast("bigint").alias("n_offending"),
        F.to_json("offending").alias("offending"),
    )
