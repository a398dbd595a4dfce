import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import LONG, clashing, documents, prose, rows

from hourlake.llm import suffix_dedup as op


def brute(found):
    """(doc_id, text) in any order → report rows, by a table of all 50-byte strings."""
    late = float("inf")
    texts = [(late if i is None else i, (t or "").encode()) for i, t in found]
    first = {}
    for i, t in sorted(texts):
        for p in range(len(t) - 49):
            first.setdefault(t[p : p + 50], i)
    out = []
    for (doc_id, _), (i, t) in zip(found, texts, strict=True):
        goes = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                goes[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(t, goes, strict=True) if not g)
        spans = sum(1 for j, g in enumerate(goes) if g and not (j and goes[j - 1]))
        out.append((doc_id, len(t), sum(goes), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repetitive():
    """Passages that start and end anywhere, runs of one byte, exact copies, short ties."""
    draw = random.Random(4)
    passages = [prose(i, 30) for i in range(4)] + ["ab" * 60, "é" * 40, "x" * 130]
    out = [(4, LONG[:20_000], None, None, 0), (3, LONG[100:15_000] + "!", None, None, 0)]
    for i in range(60):
        p = draw.choice(passages)
        cut = draw.randrange(0, len(p) // 2)
        text = prose(100 + i, draw.randrange(1, 25)) + p[cut : cut + draw.randrange(40, 140)]
        out.append((1000 - i, text + prose(200 + i, 3), "en", "s", len(text)))
    return out + [(2000 + i, out[2][1], "en", "s", 1) for i in range(3)] + [(2, "y" * 49, "en", "s", 1)]


@pytest.mark.parametrize("many", [20_000, 1])
def test_report_equals_brute_force(spark, many, monkeypatch):
    monkeypatch.setattr(op, "MANY", many)
    monkeypatch.setattr(op, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(op, "BUCKET_BYTES", 8192)
    short = documents(spark).where("doc_id IS NULL OR doc_id <> 4")
    frame = documents(spark, repetitive()).union(short).union(short.where("doc_id IS NULL"))
    wanted = brute([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])
    assert rows(op.removal_report(clashing(frame, "block", "payload", "_kept"))) == wanted
    assert sum(w[2] > 0 for w in wanted) > 20


@pytest.mark.parametrize("many", [20_000, 1])
def test_phrase_again_in_its_document_loses_all_its_strings(spark, many, monkeypatch):
    monkeypatch.setattr(op, "MANY", many)
    line = prose(1, 20)
    found = [
        (1, prose(2, 20) + line + prose(3, 20), "en", "s", 1),
        (2, "\n".join([line] * 6), "en", "s", 1),
        # Rows with one id, each with the line twice and the same in between.
        (3, line + prose(4, 9) + line + prose(4, 9) + line, "en", "s", 1),
        (3, prose(4, 9) + line + prose(4, 9) + line, "en", "s", 1),
    ]
    wanted = brute([(i, t) for i, t, *_ in found])
    assert rows(op.removal_report(documents(spark, found))) == wanted
    assert wanted[1][2] == 6 * len(line)


def test_suffixes_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(op, "_string_hashes", lambda data, starts: np.zeros((2, len(starts)), np.uint64))
    texts = [b"a" * 60 + b"b", b"a" * 61, bytes(range(200, 250)) + b"a" * 50, b"b" * 50, b"a" * 49 + b"b"]
    ids = np.array([7, 3, 9, 1, 8])
    bits = []
    for t, i in zip(texts, ids, strict=True):
        for p in range(len(t) - 49):
            bits.append(any(t[p : p + 50] in u for u, j in zip(texts, ids, strict=True) if j < i))
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.uint32)
    blob = op._pack(data, sizes, np.arange(5, dtype=np.uint32), ids)
    asked = pa.Table.from_batches([op._entry_batch([(0, 1, blob)])])
    answer = op._suffixes((pa.scalar(0),), asked).column("data")[0].as_py()
    assert np.unpackbits(op._unpack(answer)[0], count=len(bits)).astype(bool).tolist() == bits


def test_very_long_text_is_parsed_in_segments(monkeypatch):
    data = np.frombuffer(LONG.encode(), np.uint8)
    whole = op.parse(data, np.array([len(data)]))
    monkeypatch.setattr(op, "SEGMENT", 5000)
    parts = op.parse(data, np.array([len(data)]))
    covered = np.zeros(len(data), np.int64)
    for first, last in zip(parts.first, parts.last, strict=True):
        covered[first : last + 1] += 1
    assert set(covered[: len(data) - 49]) == {1} and not covered[len(data) - 49 :].any()
    assert set(whole.trigger.tolist()) == set(parts.trigger.tolist())
    assert (np.diff(whole.first) <= 35).all()


def test_texts_without_repeats_keep_columns(spark):
    cut = "Ö" + prose(7, 40)[:60]
    frame = documents(
        spark, [(1, cut, "en", "a", 61), (2, "vorher " + cut + " nachher", "de", "b", 99), (3, None, None, None, 7)]
    )
    frame = clashing(frame, "_whole", "_text")
    found = op.without_repeats(frame)
    assert found.columns == frame.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    # The blank behind the repeat isn't part of it: no string of 50 bytes of document 1 ends in it.
    assert texts == {1: (cut, 61), 2: ("vorher  nachher", 15), 3: (None, 7)}
    assert op.without_repeats(frame.limit(0)).collect() == []
