import hashlib
import re

import pytest
from llm_cases import clashing, documents, prose, rows

from hourlake.llm import decontaminate as op


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items):
    words, hit, ids = words_of(text), set(), set()
    for item_id, item in items:
        w = words_of(item)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(words), len(hit), len(ids), digest, bool(hit)


ITEMS = [
    (1, prose(1, 30)),
    (2, "Grüße, an ALLE!"),
    (10, prose(1, 30)[40:]),
    (3, ""),
    (4, None),
    (5, "?!"),
    (6, "x x x"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_report_equals_brute_force(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(op.find_leaks, "__defaults__", (10, block_bytes))
    passage = " ".join(prose(1, 30).upper().split()[3:18])
    texts = [
        f"{prose(2, 50)} -- {passage}; {prose(3, 9)}",
        "viele grüße an alle und x X,x x y",
        prose(1, 30).split(maxsplit=21)[-1],
        "GRÜßE an alle",
    ]
    extra = [(20 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    frame = documents(spark).union(documents(spark, extra))
    items = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    found = op.leak_report(frame, items)
    wanted = sorted(((r.doc_id, *brute(r.text, ITEMS)) for r in frame.collect()), key=repr)
    assert rows(found) == wanted
    assert sum(w[-1] for w in wanted) == 2


def test_spans_are_offsets_of_the_original_text(spark):
    text = "Ä\U0001f600 -- Viele  Grüße,AN\nalle?!"
    items = spark.createDataFrame([(2, "grüße an alle")], "item_id BIGINT, text STRING")
    found = op.find_leaks(documents(spark, [(1, text, None, None, 0)]), items).first()["leaks"]
    first, last = found["spans"]
    assert text[first:last] == "Grüße,AN\nalle"


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    items = spark.createDataFrame([(1, "one")], "item_id BIGINT, text STRING")
    frame = clashing(documents(spark), "item_id", "spans", "n_hit", "leaks", "_data")
    kept = op.decontaminate(frame, items)
    assert kept.columns == frame.columns
    assert rows(kept) == rows(frame.where("doc_id IS NULL OR doc_id <> 8"))
    assert rows(op.decontaminate(frame, items.limit(0))) == rows(frame)
    assert rows(op.decontaminate(frame.limit(0), items)) == []
