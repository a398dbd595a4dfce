"""Buffers that texts are worked on in."""

from hourlake.llm import features


def test_buffers_are_small_and_hold_whole_texts():
    texts = [(f"w{i} " * 20_000).encode() for i in range(40)] + [b"", b"long " * 100_000]
    found = list(features.joined(texts))
    # A text of up to a piece stays whole, so the bound is a buffer and one text.
    assert max(len(data) for data, _, _ in found) <= features.BUFFER + max(map(len, texts)) + 2
    assert sum(len(data) < 2 * features.BUFFER for data, _, _ in found) >= len(found) - 1
    whole = [
        (int(owner), bytes(data[starts[i] : starts[i + 1] - 1]))
        for data, starts, owners in found
        for i, owner in enumerate(owners)
    ]
    assert whole == list(enumerate(texts))


def test_workers_keep_small_tables():
    """Tables of powers grow with the longest buffer and stay in the worker."""
    texts = [b"some words of a text " * 200] * 1_000
    assert all(len(data) <= features.BUFFER + len(texts[0]) + 1 for data, _, _ in features.joined(texts))
