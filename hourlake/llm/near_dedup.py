"""Near-duplicate documents by fast similarity sketching.

A document is the set of its five-word shingles. Its sketch has a fixed number of bins that are
filled in rounds: in the first rounds each shingle goes to one hashed bin a round, in later rounds
every shingle goes to the one bin of that round, and a bin keeps what came earliest and is least.
All bins fill for certain, after about as many rounds as there are bins for a small set and a few
for a large one, and agreement of bins concentrates around the Jaccard similarity. Six bins make a
band; documents that share a band are compared on their full sets.

Documents with the same set are one class first; only its smallest id goes on. Within a band's
bucket, members are compared with one centre, and then members of components that are still apart
with each other. How many of a set's shingles no other candidate has bounds its similarity with any
of them, exactly: in a bucket that a third of all documents share, far-off copies drop out before
pairs are made, near ones are all close to the centre, and no link is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.components import components
from hourlake.llm.features import RangeHash, joined, mix, words_of
from hourlake.llm.tables import as_bytes, bounded, stored

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A pair at the threshold is missed by all bands with odds of 1 in 4 million, a closer one with less.
BANDS, ROWS = 32, 6
BINS = BANDS * ROWS

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

SKETCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("k1", T.LongType()),
        T.StructField("k2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shingles", T.ArrayType(T.LongType())),
    ]
)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, sorted within each, and where each begins."""
    words, owner = [], []
    for data, starts, owners in joined(texts):
        lower = _LOWER[data]
        first, last = words_of(lower)
        words.append(RangeHash(lower)(first, last))
        owner.append(owners[np.searchsorted(starts, first, side="right") - 1])
    w = np.concatenate(words) if words else np.zeros(0, np.uint64)
    d = np.concatenate(owner).astype(np.int64) if owner else np.zeros(0, np.int64)
    counts = np.bincount(d, minlength=len(texts))
    n = max(0, len(w) - SHINGLE + 1)
    hashes = np.full(n, SHINGLE, np.uint64)
    for k in range(SHINGLE):
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n])
    whole = d[:n] == d[SHINGLE - 1 : SHINGLE - 1 + n] if n else np.zeros(0, bool)
    h, o = hashes[whole], d[:n][whole]
    begins = np.concatenate([[0], np.cumsum(counts)])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        few = np.empty(len(short), np.uint64)
        for i, text in enumerate(short):
            value = np.array([counts[text]], np.uint64)
            for word in w[begins[text] : begins[text + 1]]:
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
            few[i] = value[0]
        h, o = np.concatenate([h, few]), np.concatenate([o, short])
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], np.searchsorted(o[new], np.arange(len(texts) + 1))


def sketches_of(shingles: np.ndarray, begins: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values per set; rows of empty sets mean nothing."""
    texts = len(begins) - 1
    sketch = np.full((texts, bins), _NONE)
    flat = sketch.reshape(-1)
    owner = np.repeat(np.arange(texts), np.diff(begins))
    left = np.flatnonzero(np.diff(begins) > 0)
    values = shingles
    for turn in range(2 * bins):
        drawn = mix(values + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        if turn < bins:
            at = ((drawn >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
        else:
            at = turn - bins
        held = (np.uint64(turn) << np.uint64(40)) | (drawn & np.uint64(0xFFFFFFFFFF))
        np.minimum.at(flat, owner * bins + at, held)
        full = (sketch[left] != _NONE).all(axis=1)
        if full.any():
            done = np.zeros(texts, bool)
            done[left[full]] = True
            left = left[~full]
            if not len(left):
                break
            keep = ~done[owner]
            values, owner = values[keep], owner[keep]
    return sketch


def bands_of(sketch: np.ndarray) -> np.ndarray:
    """One hash per band and row."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sketch), BANDS))
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys


def _rows(batch: pa.RecordBatch, bytes_at_once: int = 1 << 21) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Stretches of a batch of about so many bytes of text."""
    sizes = batch.column(1).to_pylist()
    start, total = 0, 0
    for i, text in enumerate(sizes):
        total += len(text)
        if total >= bytes_at_once or i == len(sizes) - 1:
            yield batch.column(0).slice(start, i + 1 - start), sizes[start : i + 1]
            start, total = i + 1, 0


def _running(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in _rows(batch):
            shingles, begins = shingle_sets(texts)
            sizes = np.diff(begins)
            sums = [_running(mix(shingles ^ np.uint64(k))) for k in (1, 2)]
            bands = bands_of(sketches_of(shingles, begins)).view(np.int64)
            some = sizes > 0
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS)
            lists = pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1)), mask=pa.array(~some))
            keys = [
                pa.array((s[begins[1:]] - s[begins[:-1]]).view(np.int64)) for s in sums
            ]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes.astype(np.int64)), *keys, lists], names=SKETCHES.names
            )


def _set_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in _rows(batch):
            shingles, begins = shingle_sets(texts)
            lists = pa.ListArray.from_arrays(
                pa.array(begins.astype(np.int32)), pa.array(shingles.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([ids, lists], names=SETS.names)


def _may_link() -> Column:
    """Whether the sizes of two sets, and how much of each no other candidate has, allow a link.

    What is alone in one set is missing in the other: it counts for the union, not for the
    intersection. The bound is exact: it never refuses a link.
    """
    common = F.least(F.col("n") - F.col("alone"), F.col("n_other") - F.col("alone_other"))
    union = F.greatest(F.col("n") + F.col("alone_other"), F.col("n_other") + F.col("alone"))
    return F.lit(100) * common >= F.lit(PERCENT) * union


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that are links by their full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(F.lit(100) * common >= F.lit(PERCENT) * union).select("a", "b").distinct()


def _members(sketches: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the buckets with more than one class: ``key``, doc_id, size ``n`` of its set and how
    many of its shingles are ``alone``, in no other set here; and the full sets.

    A set of which more than 15 % are alone can't be in a link and is left out.
    """
    first = sketches.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    banded = (
        sketches.where("n_shingles > 0")
        .join(first.select("doc_id").hint("merge"), "doc_id", "left_semi")
        .select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    )
    crowded = banded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    members = stored(banded.join(crowded.hint("merge"), "key", "left_semi"), "band-members")
    ids = members.select("doc_id").distinct()
    chosen = documents.join(ids.hint("merge"), "doc_id", "left_semi")
    sets = stored(bounded(chosen).mapInArrow(_set_task, SETS), "shingle-sets")
    single = (
        sets.select("doc_id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("m"), F.min("doc_id").alias("doc_id"))
        .where("m = 1")
    )
    alone = single.groupBy("doc_id").agg(F.count("*").alias("alone"))
    weighed = members.join(alone.hint("merge"), "doc_id", "left").fillna(0, ["alone"])
    left = weighed.where(F.lit(100) * (F.col("n") - F.col("alone")) >= F.lit(PERCENT) * F.col("n"))
    return stored(left, "band-members"), sets


def _pairs(members: DataFrame, others: DataFrame, also: Column) -> DataFrame:
    """Members of a bucket with others of it that may link. ``others`` has the same columns, which
    are called ``…_other`` in ``also``."""
    named = others.select("key", *(F.col(c).alias(f"{c}_other") for c in others.columns if c != "key"))
    return (
        members.join(named, "key")
        .where((F.col("c") != F.col("c_other")) & _may_link() & also)
        .select(
            F.least("doc_id", "doc_id_other").alias("a"), F.greatest("doc_id", "doc_id_other").alias("b")
        )
        .distinct()
    )


def _links(sketches: DataFrame, documents: DataFrame) -> DataFrame:
    """(``vertex``, ``component``) over the classes' smallest ids."""
    members, sets = _members(sketches, documents)
    columns = ["key", "doc_id", "n", "alone", "c"]
    # The centre of a bucket is the set with the least of its own: nearest to the others.
    apart = members.withColumn("c", F.col("doc_id")).select(columns)
    nearest = F.min_by(F.struct("doc_id", "n", "alone", "c"), F.struct("alone", "doc_id"))
    centres = apart.groupBy("key").agg(nearest.alias("o")).select("key", "o.*")
    tested = stored(_pairs(apart, centres, F.lit(True)), "pairs")
    found = stored(_confirmed(tested, sets), "links")
    labels = components(found)
    # What is still apart in a bucket is compared pair by pair.
    named = labels.select(F.col("vertex").alias("doc_id"), F.col("component").alias("c0"))
    labelled = members.join(named, "doc_id", "left")
    labelled = labelled.withColumn("c", F.coalesce("c0", "doc_id")).select(columns)
    several = labelled.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    several = several.where("lo < hi").select("key")
    rest = stored(labelled.join(several, "key", "left_semi"), "band-members")
    # Each pair comes from the first of its common buckets only.
    keys = rest.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    rest = rest.join(keys.hint("merge"), "doc_id")
    here = F.array_min(F.array_intersect("keys", "keys_other")) == F.col("key")
    pairs = _pairs(rest, rest, (F.col("doc_id") < F.col("doc_id_other")) & here)
    pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    more = _confirmed(pairs, sets)
    return components(found.union(more))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document.

    A document's set has its distinct shingles of five words; with fewer words, the whole sequence
    as one; a null or empty text, or one of white space, has none and is linked with nothing.
    Repeated ids are one vertex. A row without an id is linked with nothing, is its own component
    (null) and is kept.
    """
    rows = documents.select(F.col("doc_id").cast("bigint"), as_bytes("text").alias("data"))
    sketches = stored(bounded(rows).mapInArrow(_sketch_task, SKETCHES), "sketches")
    named = sketches.where(F.col("doc_id").isNotNull())
    labels = _links(named, rows)
    first = named.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles")
    classes = first.agg(F.min("doc_id").alias("first"))
    # Empty sets would meet in one task; they match no class under any key.
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    keyed = sketches.drop("bands").withColumn("k1", F.when(alone, F.xxhash64("doc_id", "k1")).otherwise(F.col("k1")))
    keyed = keyed.withColumn("n", F.when(alone, F.lit(-1)).otherwise(F.col("n_shingles")))
    classed = keyed.join(classes.withColumnRenamed("n_shingles", "n"), ["k1", "k2", "n"], "left").select(
        "doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("first")
    )
    joined_up = classed.join(labels, classed["first"] == labels["vertex"], "left")
    component = F.coalesce("component", "first")
    return joined_up.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """The documents that stay, with the columns they came with: all but those whose component has
    a smaller id."""
    gone = near_duplicates(documents).where(~F.col("kept")).select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in documents.columns))
