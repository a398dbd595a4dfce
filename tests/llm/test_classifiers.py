import zlib

import pytest
from llm_cases import SCHEMA, clashing, documents, prose, rows
from pyspark.sql import functions as F

from hourlake.llm import quality_model, toxicity


def labelled(spark, n=240):
    """Shouted texts are of low quality; texts with one of three insults somewhere are toxic."""
    texts, labels = [], []
    for i in range(n):
        bad, toxic = i % 5 == 0, i % 4 == 1
        words = prose(1000 + i, 60).split()
        if bad:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            words[20 + i % 30] = ("blorg", "snarfel", "gromp")[i % 3]
        sentences = [" ".join(words[k : k + 10]) + "." for k in range(0, 60, 10)]
        texts.append((i, " ".join(sentences), "en", "s", 1))
        labels.append((i, int(not bad), int(toxic)))
    return (
        spark.createDataFrame(texts, SCHEMA),
        spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT"),
    )


@pytest.mark.parametrize(
    "run, label, modulus, held",
    [
        (quality_model.quality_scores, "quality", 3, 1),
        (toxicity.toxicity_scores, "toxic", 5, 0),
    ],
)
def test_held_out_documents_are_told_apart(spark, run, label, modulus, held):
    texts, labels = labelled(spark)
    found = run(texts, labels).join(labels, "doc_id").collect()
    assert len(found) == 240
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    judged = [r["predicted"] == r[label] for r in found if r["held_out"]]
    assert len(judged) > 30 and sum(judged) >= 0.9 * len(judged)


@pytest.mark.parametrize("run", [quality_model.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows_and_labels(spark, run):
    # Ids of their own, apart from those of the awkward rows.
    texts, labels = (f.withColumn("doc_id", F.col("doc_id") + 1000) for f in labelled(spark, 60))
    broken = spark.createDataFrame(
        [(3, None, None), (None, 1, 1), (4, 7, 7)], "doc_id BIGINT, quality INT, toxic INT"
    )
    frame = clashing(documents(spark).unionByName(texts), "score", "predicted", "y")
    found = run(frame, labels.union(broken))
    scores = {r["doc_id"]: r["score"] for r in found.collect() if r["doc_id"] in (1, 2, 6)}
    assert found.count() == 70
    assert scores[1] == scores[2] and all(0 <= s <= 1 for s in scores.values())
    # One class only, no labels, no documents.
    for some in (labels.where("quality = 1 AND toxic = 0"), labels.limit(0)):
        constant = run(frame, some)
        assert constant.count() == 70
        assert all(0 <= r["score"] <= 1 for r in constant.collect())
    assert run(frame.limit(0), labels).count() == 0


def test_labels_are_learned_only_from_their_rows(spark):
    texts, labels = labelled(spark, 90)
    flipped = labels.withColumn(
        "quality",
        F.when(quality_model.learn_rows(), F.col("quality")).otherwise(1 - F.col("quality")),
    )
    assert rows(quality_model.quality_scores(texts, labels)) == rows(
        quality_model.quality_scores(texts, flipped)
    )


def test_rejected_documents_go_and_columns_stay(spark):
    texts, labels = labelled(spark)
    frame = clashing(texts, "score", "_row")
    kept = quality_model.keep_good(frame, labels)
    assert kept.columns == frame.columns
    good = labels.where("quality = 1").count()
    assert abs(kept.count() - good) <= 5
    assert kept.join(labels.where("quality = 1"), "doc_id").count() >= good - 2


def test_offending_sentences_are_located(spark):
    texts, labels = labelled(spark)
    model = toxicity.fit(texts, labels)
    text = "Ä\U0001f600 harmless words. Then gromp was said! Nothing more"
    found = toxicity.with_toxicity(documents(spark, [(1, text, None, None, 0)]), model).first()
    spans = [text[s["start"] : s["end"]] for s in found["offending"]]
    assert spans == ["Then gromp was said"]


def test_long_texts_are_scored_in_pieces_like_whole_ones():
    rows_ = [(i, f"{'bad' if i % 2 else 'fine'} {prose(i, 30)}".encode(), i % 2) for i in range(80)]
    model = toxicity.train(rows_)
    text = b"fine words. " * 200_000 + b"bad words."
    score, spans = model.judge([text, b"bad words."])
    assert score[0] >= score[1] > 0.5
    last = spans[0][-1]
    assert text[last["start"] : last["end"]] == b"bad words"
