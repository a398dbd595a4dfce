"""The corpus pipeline against plain versions of its stages, one after the other."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import SCHEMA, awkward, prose
from plain_scores import quality_score, toxicity_score
from test_decontaminate import brute as leaks
from test_near_dedup import brute as components
from test_packing_and_tokens import library

import corpus_pipeline
from hourlake.llm import quality_model, toxicity

PASSAGE = prose(70, 60)
ITEMS = [(1, prose(71, 30)), (2, None), (3, ""), (4, "never said by anyone")]


def sentences(words):
    return " ".join(" ".join(words[k : k + 10]) + "." for k in range(0, len(words), 10))


def corpus():
    """Good and bad texts; then awkward rows, copies, near copies, repeated passages, benchmark passages."""
    rows, labels = [], []
    for i in range(160):
        words = prose(1000 + i, 60).split()
        if i % 4 == 0:
            words = [w.upper() + "!!" for w in words]
        if i % 6 == 1:
            words += PASSAGE.split()
        if i % 20 == 3:
            words += ITEMS[0][1].split()[5:25]
        rows.append((1000 + i, sentences(words), "en", "s", 1))
        labels.append((1000 + i, int(i % 4 != 0), int(i % 7 == 0)))
    near = sentences(prose(1001, 59).split() + ["changed"])
    rows += [(3000 + i, rows[9][1], "en", "s", 1) for i in range(5)] + [(4000, near, "de", "t", 2)]
    return rows + awkward(), labels


def without_repeats(rows):
    """Each byte covered by a 50-byte string that also starts in a document with a smaller id goes."""
    late, first = float("inf"), {}
    texts = [(late if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for i, t in sorted(texts):
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    for r, (i, t) in zip(rows, texts, strict=True):
        goes = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                goes[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, goes, strict=True) if not g)
        yield (r[0], kept.decode(), *r[2:]) if any(goes) else r


def pieces(doc_id, text, ids):
    found = [*ids(text), 2]
    start, number = 0, 0
    while start < len(found):
        length = (len(found) - start) % 1024 or 1024
        data = np.array(found[start : start + length], "<u4").tobytes()
        yield doc_id, number, start, length, zlib.crc32(data)
        start, number = start + length, number + 1


def test_run_equals_the_stages_plain_versions(spark, tmp_path):
    rows, labels = corpus()
    frame = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    items = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    for name, table in (("documents", frame), ("labels", marks), ("benchmark", items)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")

    model = quality_model.fit(frame, marks)
    sizes = [len(rows)]
    rows = [r for r in rows if quality_score(model, (r[1] or "").encode()) >= 0.5]
    sizes.append(len(rows))
    gone = {i for i, _, _, kept in components([r[:2] for r in rows]) if not kept}
    rows = [r for r in rows if r[0] not in gone]
    sizes.append(len(rows))
    rows = list(without_repeats(rows))
    rows = [r for r in rows if not leaks(r[1], ITEMS)[-1]]
    sizes.append(len(rows))
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 4
    ids = library("byte_bpe_50k.json")
    wanted = sorted((p for r in rows for p in pieces(r[0], r[1], ids)), key=repr)

    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == wanted
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for place in places.values():
        ends = np.cumsum([0, *(length for _, length in sorted(place))])
        assert [offset for offset, _ in sorted(place)] == ends[:-1].tolist() and ends[-1] <= 1024


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_run_on_an_empty_table(spark, tmp_path, empty):
    rows, labels = corpus()
    tables = {
        "documents": spark.createDataFrame(rows[::9], SCHEMA),
        "labels": spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT"),
        "benchmark": spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING"),
    }
    for name, table in tables.items():
        (table.limit(0) if name == empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).count()
    assert (found == 0) == (empty == "documents")


TEXTS = ["", "one", "a a a b", "Ähnlich grüßen. Viele!\nZeilen?\n\n", prose(5, 80), prose(6, 30).upper() + "!! x\x0by\x1cz"]


def test_scores_equal_plain_ones():
    rows, labels = corpus()
    known = [(i, t.encode(), y) for (i, t, *_), (_, y, _) in zip(rows, labels, strict=False)]
    model = quality_model.train(known[:60])
    texts = [t.encode() for t in TEXTS]
    wanted = [quality_score(model, t) for t in texts]
    assert np.allclose(model.scores(texts), wanted, atol=1e-6)
    said = [(i, t + b" gromp!" * y, y) for (i, t, _), (_, _, y) in zip(known, labels, strict=False)]
    judge = toxicity.train(said)
    texts += [b"well. then gromp was said! more", b"gromp gromp"]
    assert np.allclose(judge.judge(texts)[0], [toxicity_score(judge, t) for t in texts], atol=1e-9)
    assert judge.judge(texts)[0][-1] > 0.5 > judge.judge(texts)[0][0]
