import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from llm_cases import clashing, rows

from hourlake.llm import turn_repair as op

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
STATES = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}


def brute_damage(turns):
    known = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in turns:
        fault = zlib.crc32(f"{known(conv)}:{known(turn)}".encode()) % 20
        role, text = known(role), known(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)


def brute(turns):
    """(cost, audit) by a search over all edits, from the end; the repaired rows from the audit."""
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    found = []
    damaged = list(brute_damage(turns))
    for conv in {r[0] for r in turns}:
        own = sorted((r for r in damaged if r[0] == conv), key=order)
        faults, seen = [], set()
        for _, _, role, text in own:
            last = text.strip(" \t\n\x0b\f\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
            faults.append(fault)
            seen.add((role, text))

        @cache
        def best(i, state, room, own=own, faults=tuple(faults)):
            options = []
            if i == len(own):
                if state in ("", "a"):
                    options.append((0, "", ()))
            else:
                cost, audit, made = best(i + 1, state, 2)
                options.append((cost + 3, "D" + audit, made))
                if faults[i] in ("", "truncated"):
                    extra, role = faults[i] == "truncated", own[i][2]
                    after = STATES.get(role[:1], {}).get(state)
                    if after:
                        cost, audit, made = best(i + 1, after, 2)
                        options.append((cost + extra, "K" + audit, (f"{role}:{own[i][3]}", *made)))
                    for name in ("user", "assistant"):
                        after = STATES[name[0]].get(state)
                        if after:
                            cost, audit, made = best(i + 1, after, 2)
                            options.append((cost + 2 + extra, "R" + audit, (f"{name}:{own[i][3]}", *made)))
            for name in ("user", "assistant") if room else ():
                after = STATES[name[0]].get(state)
                if after:
                    cost, audit, made = best(i, after, room - 1)
                    options.append((cost + 2, "I" + audit, (f"{name}:", *made)))
            return min(options, default=(10**9, "", ()))

        cost, audit, made = best(0, "", 2)
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:], strict=False)]
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        sha = hashlib.sha256("\n".join(made).encode()).hexdigest()
        found.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha))
    return sorted(found, key=repr)


def random_turns(seed, conversations, longest):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["yes.", "no", "so?", "", " \n", None, "well!  ", "é…", "a.b"]
    for conv in [None, *range(conversations)]:
        for i in range(draw.randrange(1, longest)):
            turn = draw.choice([i, i, i, None, i // 2])
            text = draw.choice(texts) if draw.random() < 0.5 else f"words {draw.randrange(1000)}{draw.choice('.!?,')}"
            yield conv, turn, draw.choice(roles[: draw.choice([2, 3, 8])]), text


@pytest.mark.parametrize("bits", [12, 1])
def test_reports_equal_brute_force(spark, monkeypatch, bits):
    """Chunks of two rows take every way of the fix-up passes."""
    monkeypatch.setattr(op, "CHUNK_BITS", bits)
    turns = list(random_turns(3, 40, 12))
    frame = clashing(spark.createDataFrame(turns, SCHEMA), "at", "k", "fault", "copies")
    assert rows(op.repair_report(frame)) == brute(turns)


def test_chunks_give_what_whole_conversations_give():
    """Nothing but system turns: parallel only where a vector's parity allows it, so passes chain."""
    draw = random.Random(5)
    for length in (1, 7, 60):
        codes = bytes(draw.choice([2, 2, 3, 4, 6, 0]) for _ in range(length))
        whole = op.solve(codes, op._END)
        for at in range(1, length):
            right = op.solve(codes[at:], op._END)
            left = op.solve(codes[:at], op._SPECULATIVE)
            assert op.solve(codes[:at], tuple(right[:4]), left) + right == whole


def test_long_conversation_of_equal_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_BITS", 5)
    turns = [(7, i, "system", f"line {i}.") for i in range(300)]
    turns += [(7, 1000 + i, "user", "same") for i in range(200)] + [(7, 5000, "user", "twice.")] * 300
    found = op.repair_report(spark.createDataFrame(turns, SCHEMA)).collect()
    assert [tuple(r) for r in found] == brute_long(turns)


def brute_long(turns):
    import sys

    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        return brute(turns)
    finally:
        sys.setrecursionlimit(limit)


def test_repaired_rows_alternate_and_no_row_is_lost(spark):
    turns = list(random_turns(9, 30, 10))
    frame = spark.createDataFrame(turns, SCHEMA)
    edits = op.repairs(frame)
    assert edits.agg({"copies": "sum"}).first()[0] == len(turns)
    by = {}
    for r in op.repaired(edits).orderBy("at", "place").collect():
        by.setdefault(r["conv_id"], []).append(r["role"][:1])
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by.values())


def test_empty_and_dropped_conversations(spark):
    assert op.repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    found = op.repair_report(spark.createDataFrame([(*gone, "user", "x.")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
