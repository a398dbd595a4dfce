"""Periodic runs: stretches of words that repeat with a period, found by block convolution.

At each dyadic scale B the words are cut into aligned blocks of B. A run with a period q from B to 2B - 1
is at least 3q words long, so it holds an aligned block with its copy q words on. The squared differences
between a block and the window behind it, summed up for every distance at once, are a convolution; it is
worked out exactly by number-theoretic transforms modulo two primes, and where the sum is zero the block
occurs again. Blocks with a word that doesn't come again at any distance of the scale are spared the
transform. Each distance found is the seed of an extension to both sides, word by word.

If a block occurs three times or more in its window, it is itself periodic, with the distance d between
its occurrences, and a run's period is the distance between two left ends or two right ends of the
stretches with period d around the block and around its copies; only these two distances are seeds then.

Texts are worked on in groups of about ``GROUP`` words laid end to end, with marks between them that equal
nothing: one set of numpy calls for hundreds of short texts. A longer text is a group of its own.

Cases: a null or empty text has no words and no runs; rows are independent, so repeated rows give repeated
rows, and columns but the key and the text are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.tables import bounded

LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: The smallest block; together with its own length it covers all periods below 16.
BASE = 8
GROUP = 1 << 18
#: Transforms of so many numbers at a time.
ROOM = 1 << 20
#: Primes k * 2**26 + 1 with a generator each. Their product is beyond any sum of squares here.
PRIMES = ((2013265921, 31), (1811939329, 13))

Run = tuple[int, int, int]


@cache
def _powers(prime: int, root: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    step = pow(root, (prime - 1) // (2 * half), prime)
    step = pow(step, -1, prime) if inverse else step
    powers, have = np.ones(half, np.uint64), 1
    while have < half:
        powers[have : 2 * have] = powers[:have] * np.uint64(pow(step, have, prime)) % np.uint64(prime)
        have *= 2
    return powers


def _transformed(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order, in place."""
    p, half = np.uint64(prime), x.shape[1] // 2
    while half:
        pairs = x.reshape(len(x), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0] = (low + high) % p
        pairs[:, :, 1] = (low + p - high) * _powers(prime, root, half, False) % p
        half //= 2
    return x


def _back(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The inverse, from bit-reversed order, in place."""
    p, half = np.uint64(prime), 1
    while half < x.shape[1]:
        pairs = x.reshape(len(x), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1] * _powers(prime, root, half, True) % p
        pairs[:, :, 0] = (low + high) % p
        pairs[:, :, 1] = (low + p - high) % p
        half *= 2
    return x * np.uint64(pow(x.shape[1], -1, prime)) % p


def zero_shifts(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each row of ``blocks`` equals its row of ``windows`` at each place: the sum of the squared
    differences, from the correlation of both, is zero modulo each prime."""
    (rows, short), long = blocks.shape, windows.shape[1]
    size = 1 << (long - 1).bit_length()
    equal = np.ones((rows, long - short + 1), bool)
    for prime, root in PRIMES:
        p = np.uint64(prime)
        one, two = np.zeros((rows, size), np.uint64), np.zeros((rows, size), np.uint64)
        one[:, :short], two[:, :long] = blocks[:, ::-1], windows
        product = _transformed(one, prime, root) * _transformed(two, prime, root) % p
        # Sums that wrap around stand before the first whole one, as a window is no longer than ``size``.
        crossed = _back(product, prime, root)[:, short - 1 : long]
        squares = (blocks * blocks % p).sum(1, keepdims=True) % p
        sums = np.zeros((rows, long + 1), np.uint64)
        np.cumsum(windows * windows % p, axis=1, out=sums[:, 1:])
        behind = (sums[:, short:] - sums[:, : long - short + 1]) % p
        equal &= (squares + behind) % p == 2 * crossed % p
    return equal


def _right(words: np.ndarray, i: int, q: int) -> int:
    """The first place from ``i`` on whose word isn't repeated ``q`` words on."""
    step = 64
    while (end := min(i + step, len(words) - q)) > i:
        differs = words[i:end] != words[i + q : end + q]
        if differs[at := int(differs.argmax())]:
            return i + at
        i, step = end, min(2 * step, 1 << 16)
    return max(i, 0)


def _left(words: np.ndarray, i: int, q: int) -> int:
    """The first place such that all from there to ``i`` are repeated ``q`` words on."""
    step = 64
    while i > 0:
        begin = max(0, i - step)
        differs = words[begin:i] != words[begin + q : i + q]
        if differs[at := int(differs[::-1].argmax()) * -1 - 1]:
            return i + at + 1
        i, step = begin, min(2 * step, 1 << 16)
    return i


class _Stretches:
    """Maximal stretches of places whose words are repeated a distance on; the last of each distance is
    remembered, as seeds come in order."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.last = words, {}

    def around(self, x: int, q: int) -> tuple[int, int]:
        """The stretch of distance ``q`` that holds the place ``x``; empty if ``x`` isn't in any."""
        begin, end = self.last.get(q, (0, 0))
        if not begin <= x < end:
            end = _right(self.words, x, q)
            begin = _left(self.words, x, q) if end > x else x
            self.last[q] = begin, end
        return begin, end


def _divisors(q: int) -> Iterator[int]:
    """q over each of its prime factors."""
    rest, f = q, 2
    while f * f <= rest:
        if rest % f == 0:
            yield q // f
            while rest % f == 0:
                rest //= f
        f += 1
    if rest > 1 and q > 1:
        yield q // rest


def _least(words: np.ndarray, start: int, q: int) -> bool:
    """Whether a run of three periods or more has no smaller period."""
    return not any(
        np.array_equal(words[start : start + q], words[start + d : start + d + q]) for d in _divisors(q)
    )


def _block_starts(
    words: np.ndarray, order: np.ndarray, keys: np.ndarray, gap: np.ndarray, size: int
) -> np.ndarray:
    """Aligned blocks in which each word comes again at a distance of this scale."""
    n = len(words) // size * size
    low = 1 if size == BASE else size
    near = (gap[:n] < 2 * size).reshape(-1, size).all(1)
    starts = np.flatnonzero(near) * size
    if low > 1 and len(starts):
        places = starts[:, None] + np.arange(size)
        sought = words[places] * len(words) + places + low
        found = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        at = order[found]
        again = (keys[found] >= sought) & (words[at] == words[places]) & (at < places + 2 * size)
        starts = starts[again.all(1)]
    return starts


def _seeds(
    words: np.ndarray, starts: np.ndarray, size: int, stretches: _Stretches
) -> Iterator[tuple[int, int]]:
    """(place, distance) of what may be runs' blocks and periods."""
    low = 1 if size == BASE else size
    width = size + 2 * size - 1 - low
    marks = words.max(initial=0) + 1
    padded = np.concatenate([np.where(words < 0, marks, words), np.full(width + low, marks)]).astype(np.uint64)
    step = max(1, ROOM // width)
    for i in range(0, len(starts), step):
        some = starts[i : i + step]
        blocks = padded[some[:, None] + np.arange(size)]
        equal = zero_shifts(blocks, padded[some[:, None] + low + np.arange(width)])
        rows, shifts = np.nonzero(equal)
        shifts += low
        borders = np.searchsorted(rows, np.arange(len(some) + 1))
        for x, begin, end in zip(some.tolist(), borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            own = shifts[begin:end].tolist()
            if len(own) > 2 and low > 1:
                d = own[1] - own[0]
                here, there = stretches.around(x, d), stretches.around(x + own[0], d)
                own = [] if here == there else [q for q in {there[0] - here[0], there[1] - here[1]} if q in own]
            for q in own:
                yield x, q


def runs_of(words: np.ndarray, longest: int) -> list[Run]:
    """(start, length, period) of all runs, by start, then period. ``words`` are numbers, in which marks
    between texts are negative and differ; no text has more than ``longest`` words."""
    if longest < LEAST_LENGTH:
        return []
    order = np.argsort(words, kind="stable")
    ranked = words[order]
    keys = ranked * len(words) + order
    gap = np.full(len(words), len(words) + 1, np.int64)
    same = ranked[1:] == ranked[:-1]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    found, tried, size = [], set(), BASE
    while size == BASE or LEAST_PERIODS * size <= longest:
        starts = _block_starts(words, order, keys, gap, size)
        stretches = _Stretches(words)
        for x, q in _seeds(words, starts, size, stretches) if len(starts) else ():
            begin, end = stretches.around(x, q)
            if (begin, q) in tried:
                continue
            tried.add((begin, q))
            length = end - begin + q
            if end > x and length >= max(LEAST_LENGTH, LEAST_PERIODS * q) and _least(words, begin, q):
                found.append((begin, length, q))
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, equal ones alike, with a mark behind each text; and where each text starts."""
    flat = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
    numbers = flat.indices.to_numpy().astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    words = np.empty(len(numbers) + len(texts), np.int64)
    inside = np.ones(len(words), bool)
    inside[begins + sizes] = False
    words[inside] = numbers
    words[begins + sizes] = -1 - np.arange(len(texts))
    return words, begins


def text_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, given as its words."""
    words, begins = _numbered(texts)
    found: list[list[Run]] = [[] for _ in texts]
    for start, length, period in runs_of(words, max(map(len, texts), default=0)):
        i = int(np.searchsorted(begins, start, side="right")) - 1
        found[i].append((start - int(begins[i]), length, period))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words, one space between them, without what any run holds after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, begin, texts, size = batch.column(0), 0, [], 0
        for i, value in enumerate(batch.column(1)):
            # On bytes, split() without arguments splits at the six ASCII blanks.
            texts.append((value.as_py() or b"").split())
            size += len(texts[-1]) + 1
            if size >= GROUP or i + 1 == len(batch):
                runs = text_runs(texts)
                rest = [collapsed(*x) for x in zip(texts, runs, strict=True)]
                columns = [
                    keys.slice(begin, len(texts)),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([[dict(zip(_RUN.names, r, strict=True)) for r in x] for x in runs], pa.list_(_RUN)),
                    pa.array(rest, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "runs", "collapsed"])
                begin, texts, size = i + 1, [], 0


def find_runs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_words``, ``runs`` (array of start, length and period in words, by start, then
    period) and the ``collapsed`` text."""
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("data"))
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    found = bounded(rows).mapInArrow(
        _found, f"key {kind}, n_words bigint, runs {runs}, collapsed string"
    )
    return found.withColumnRenamed("key", key)


def planted(documents: DataFrame) -> DataFrame:
    """doc_id and text, with the contract's repeats: in every tenth document by crc32 of its id, the words from
    one place on repeat the first of them."""
    blanks = " \t\n\x0b\f\r"
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.split(F.trim("text", F.lit(blanks)), "[ \t\n\x0B\f\r]+")
    g, n = F.floor(F.col("h") / 10), F.size("words")
    rows = documents.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when((F.col("h") % 10 == 0) & (F.trim("text", F.lit(blanks)) != ""), words)
    )
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), n - F.col("a"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return (
        rows.withColumn("g", g)
        .withColumn("a", a)
        .withColumn("p", p)
        .select("doc_id", F.when(F.col("words").isNotNull(), changed).otherwise(F.col("text")).alias("text"))
    )


def run_report(documents: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    found = find_runs(planted(documents))
    more = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, x: F.when(more(b, x), x).otherwise(b))
    line = lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])
    lines = F.array_join(F.transform("runs", lambda x: F.concat(line(x), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
