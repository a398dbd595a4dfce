import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import awkward, clashing, documents, prose, rows

from hourlake.llm import periodic_runs as op


def brute_runs(words):
    """By definition: for each period, the maximal stretches; those whose smallest period it is."""
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(words[i : i + length - d] == words[i + d : i + length] for d in range(1, q))
            if length >= max(24, 3 * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return doc_id, len(runs), *four, sha(lines.encode()), sha(kept)


def texts():
    draw = random.Random(11)
    for seed in range(160):
        letters = "abc"[: draw.choice([1, 2, 2, 3, 3])]
        parts = []
        for _ in range(draw.randrange(1, 5)):
            unit = [draw.choice(letters) for _ in range(draw.choice([1, 2, 3, 5, 8, 11, 16, 17, 31, 40]))]
            parts += unit * draw.randrange(1, 7) + unit[: draw.randrange(len(unit) + 1)]
            parts += [f"x{draw.randrange(3)}"] * draw.randrange(2)
        yield " ".join(parts)
    yield from (" ".join(draw.choice("ab") for _ in range(n)) for n in (23, 24, 25, 300))
    yield "a b c d e f g h " * 3
    yield "word " * 24
    yield "word " * 23
    # Period 31: a long plain stretch and one odd word; period 11 with a plain part inside.
    yield " ".join((["a"] * 30 + ["b"]) * 4)
    yield " ".join("abababababcababababab"[:11] * 6)
    yield (prose(3, 50) + " ") * 4 + prose(4, 30)


@pytest.mark.parametrize("group", [1 << 18, 1])
def test_runs_equal_brute_force(monkeypatch, group):
    monkeypatch.setattr(op, "ROOM", 1000 if group == 1 else op.ROOM)
    every = [t.encode().split() for t in texts()]
    found = [op.text_runs([t])[0] for t in every] if group == 1 else op.text_runs(every)
    assert found == [brute_runs(t) for t in every]


def test_transform_finds_equal_places():
    draw = np.random.default_rng(2)
    blocks = draw.integers(0, 3, (50, 16)).astype(np.uint64)
    windows = draw.integers(0, 3, (50, 31)).astype(np.uint64)
    windows[::2, 7:23] = blocks[::2]
    equal = op.zero_shifts(blocks, windows)
    for row, (b, w) in enumerate(zip(blocks, windows, strict=True)):
        assert equal[row].tolist() == [bool((w[s : s + 16] == b).all()) for s in range(16)]


def test_report_equals_brute_force(spark):
    more = [(100 + i, t, "en", "s", 1) for i, t in enumerate([*texts(), *(prose(i, 120) for i in range(60))])]
    table = [r for r in awkward() if r[0] != 4] + more
    frame = clashing(documents(spark, table), "runs", "key", "words", "h")
    wanted = sorted((brute(r[0], r[1]) for r in table), key=repr)
    assert rows(op.run_report(frame)) == wanted
    assert op.run_report(documents(spark, [])).collect() == []


def test_long_texts(spark):
    equal = "again " * 200_000
    twice = prose(7, 20_000, 100_000)
    table = [(1, equal, "en", "s", 1), (2, f"{twice} {twice} {twice} end", "en", "s", 1)]
    found = {r["doc_id"]: r for r in op.find_runs(documents(spark, table)).collect()}
    assert [tuple(r) for r in found[1]["runs"]] == [(0, 200_000, 1)]
    assert [tuple(r) for r in found[2]["runs"]] == [(0, 60_000, 20_000)]
    assert found[1]["collapsed"] == "again" and found[2]["collapsed"] == f"{twice} end"
