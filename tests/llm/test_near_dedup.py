import random
import re

import numpy as np
from llm_cases import clashing, documents, prose, rows

from hourlake.llm import near_dedup as op
from hourlake.llm.components import components


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(found):
    sets = {}
    for i, t in found:
        sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    flat = [(i, s) for i, many in sets.items() if i is not None for s in many if s]
    for n, (i, s) in enumerate(flat):
        for j, o in flat[:n]:
            if 100 * len(s & o) >= 85 * len(s | o):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted(
        (
            (i, len(s), None if i is None else root(i), i is None or root(i) == i)
            for i, many in sets.items()
            for s in many
        ),
        key=repr,
    )


def families():
    """Chains of edits, in which neighbours are similar and ends are not, and groups of copies."""
    draw = random.Random(6)
    out = []
    for family in range(6):
        words = prose(family, 150).split()
        for step in range(8):
            out.append((draw.randrange(10**6), " ".join(words), "en", "s", 1))
            at = draw.randrange(len(words))
            words[at : at + 1] = [f"edit{family}x{step}"]
    out += [(10**7 + i, out[3][1].upper(), "en", "s", 1) for i in range(15)]
    out += [(10**8 + i, t, "en", "s", 1) for i, t in enumerate(["a b c", "A b C", "a b d", "a b c d e", "e"])]
    return out


def test_components_equal_brute_force(spark):
    frame = documents(spark, families()).union(documents(spark))
    wanted = brute([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])
    assert rows(op.near_duplicates(clashing(frame, "component", "bands", "n"))) == wanted
    assert sum(not w[-1] for w in wanted) > 40


def test_a_large_group_of_far_and_near_copies(spark):
    """Copies with few edits link up; those with many link with nothing and cost no pairs."""
    draw = random.Random(8)
    base = prose(77, 200).split()
    rows_ = []
    for i in range(120):
        words = list(base)
        for at in draw.sample(range(200), draw.choice([0, 1, 1, 2, 3, 5, 12, 20])):
            words[at] = f"own{i}x{at}"
        rows_.append((i, " ".join(words), "en", "s", 1))
    frame = documents(spark, rows_)
    assert rows(op.near_duplicates(frame)) == brute([(r[0], r[1]) for r in rows_])


def test_keep_first_keeps_columns(spark):
    frame = clashing(documents(spark, families()).union(documents(spark)), "kept", "component_id")
    kept = op.keep_first(frame)
    assert kept.columns == frame.columns
    ids = {r["doc_id"] for r in op.near_duplicates(frame).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == ids
    assert op.keep_first(frame.limit(0)).collect() == []
    assert op.near_duplicates(documents(spark, [(1, None, "", "", 0)])).count() == 1


def test_sketches_fill_and_agree_as_the_sets_do():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 4000, dtype=np.uint64)
    for size, shared in ((1, 1), (7, 6), (300, 270), (3000, 2900)):
        a, b = np.sort(pool[:size]), np.sort(pool[size - shared : 2 * size - shared])
        sketch = op.sketches_of(np.concatenate([a, b]), np.array([0, size, 2 * size]))
        assert (sketch != op._NONE).all()
        similarity = shared / (2 * size - shared)
        agreed = (sketch[0] == sketch[1]).mean()
        assert abs(agreed - similarity) < 5 * (similarity * (1 - similarity) / op.BINS) ** 0.5 + 1e-9


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40, 60)] + [(7, x) for x in range(100, 130)] + [(3, 3), (130, 131)]
    frame = spark.createDataFrame([(b, a) if a % 2 else (a, b) for a, b in edges], "a BIGINT, b BIGINT")
    found = {r["vertex"]: r["component"] for r in components(frame).collect()}
    assert found == {x: 40 for x in range(41, 61)} | {x: 7 for x in range(100, 130)} | {131: 130}
    assert components(frame.limit(0)).collect() == []
