"""Quality rules whose thresholds come from the data, with built-in functions only.

Each document gets a few counts. Ratios of them are compared with what is usual for the document's
language and source: fences around the middle half of the group's values, on a logarithmic scale, as far
out as the middle half is wide, ``REACH`` times over. A ratio that most documents have none of is compared
with those that have some; having none is never a reason to refuse.

The quantiles come from mergeable sketches: counts of logarithmic buckets per group, which tasks add up
before the shuffle and which are the same however the rows were dealt out. To every group's sketch
``PRIOR`` documents as its language has them are added, and to a language's as many as all documents have
them: a small group goes by its language, a large one by itself, and between them nothing changes in a step.
All weights are whole numbers, so that sums don't depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.tables import stored

WINDOW = 8
#: Buckets of the sketch are 2 % wide; values under the least count as zero.
GROWTH, LEAST = 1.02, 1e-3
#: Documents that a group borrows, and the weight of one of its own.
PRIOR, SCALE = 200, 1000
#: The fences stand so many widths of the middle half beyond its ends.
REACH = 4
#: Ratio → whether values below are refused too.
RATIOS = {"symbol_ratio": False, "dup_line_ratio": False, "repeat_ratio": False, "word_length": True}

_SPACE = r" \t\n\x0B\f\r"
_BLANKS = " \t\n\x0b\f\r"
#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space; null for a null text."""
    trimmed = F.trim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{_SPACE}]+")
    )


def _repeated_places(pairs: str) -> Column:
    """Places, in order, of the windows whose hash occurs more than once; ``pairs`` has (hash,
    place) in order of the hashes. It must be a column: an expression would be worked out again
    for each of its elements."""

    def repeated(pair: Column, at: Column) -> Column:
        before, after = F.get(pairs, at - 1)["h"], F.get(pairs, at + 1)["h"]
        same = F.coalesce(before == pair["h"], F.lit(False)) | F.coalesce(after == pair["h"], F.lit(False))
        return F.when(same, pair["i"])

    return F.array_sort(F.array_compact(F.transform(pairs, repeated)))


def _covered(places: Column) -> Column:
    """Words inside the windows at ``places``."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        places,
        start,
        lambda acc, at: F.struct(
            (acc["n"] + at + WINDOW - F.greatest(acc["end"], at)).cast("bigint").alias("n"),
            (at + WINDOW).alias("end"),
        ),
        lambda acc: acc["n"],
    )


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long).

    A null text counts as empty: all counts are zero. Columns of these names are replaced, and so
    are ``_words`` and ``_windows``. Windows of eight words are compared by 64-bit hashes of the
    hashes of their words, within one text only. Store the result before filtering by its counts: a filter
    would have them worked out once more, and its own way.
    """
    column = F.coalesce(F.col(text), F.lit(""))
    hashed = F.transform("_words", lambda w: F.xxhash64(w))
    with_words = documents.withColumn("_words", words_of(column)).withColumn("_hashes", hashed)
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    # Most texts repeat no window; only the others have theirs sorted.
    pairs = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    lines = F.filter(F.split(column, "\n"), lambda x: F.trim(x, F.lit(_BLANKS)) != "")
    symbols = sum(
        (F.octet_length(column) - F.octet_length(F.replace(column, F.lit(s))) for s in SYMBOLS),
        start=F.lit(0),
    )
    return (
        with_words.withColumn("_windows", windows)
        .withColumn("_pairs", pairs)
        .withColumn("_lines", lines)
        .withColumn("n_words", n.cast("bigint"))
        .withColumn(
            "word_chars",
            F.aggregate("_words", F.lit(0).cast("bigint"), lambda acc, w: acc + F.char_length(w)),
        )
        .withColumn("n_symbols", symbols.cast("bigint"))
        .withColumn(
            "n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")
        )
        .withColumn("n_lines", F.size("_lines").cast("bigint"))
        .withColumn(
            "n_repeat_words",
            F.coalesce(_covered(_repeated_places("_pairs")), F.lit(0).cast("bigint")),
        )
        .drop("_words", "_hashes", "_windows", "_pairs", "_lines")
    )


def with_ratios(counts: DataFrame) -> DataFrame:
    """The values that are compared within a group; zero where there is nothing to divide by."""

    def ratio(over: str, under: str) -> Column:
        return F.coalesce(F.try_divide(F.col(over), F.col(under)), F.lit(0.0))

    return (
        counts.withColumn("symbol_ratio", ratio("n_symbols", "word_chars"))
        .withColumn("dup_line_ratio", ratio("n_dup_lines", "n_lines"))
        .withColumn("repeat_ratio", ratio("n_repeat_words", "n_words"))
        .withColumn("word_length", ratio("word_chars", "n_words"))
    )


def bucket(value: Column) -> Column:
    """The logarithmic bucket of a value; null for values that count as zero."""
    return F.when(value >= LEAST, F.floor(F.log(value / LEAST) / F.log(F.lit(GROWTH))).cast("int"))


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Mergeable quantile sketches: rows per key, ratio and logarithmic bucket, without zeros.

    Sketches of parts of the data are merged by adding up ``n``.
    """
    named = F.create_map(*(x for r in RATIOS for x in (F.lit(r), bucket(F.col(r)))))
    values = rows.select(*keys, F.explode(named).alias("ratio", "bucket")).where("bucket IS NOT NULL")
    return values.groupBy(*keys, "ratio", "bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A null-safe join on ``keys``, which the result has once."""
    renamed = right.withColumnsRenamed({k: f"other_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"other_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*(f"other_{k}" for k in keys))


def blended(own: DataFrame, groups: DataFrame, above: DataFrame, keys: list[str], shared: list[str]) -> DataFrame:
    """Weights per key, ratio and bucket: own documents, and ``PRIOR`` more as the group above has them.

    ``groups`` has every key, ``above`` the weights of the coarser groups by ``shared`` keys: a few hundred
    buckets a ratio.
    """
    totals = above.groupBy(*shared, "ratio").agg(F.sum("w").alias("total"))
    shares = _matched(above, totals, [*shared, "ratio"]).select(
        *shared, "ratio", "bucket", F.expr(f"({PRIOR * SCALE} * w) div total").alias("w")
    )
    every = groups.withColumn("ratio", F.explode(F.array(*map(F.lit, RATIOS))))
    borrowed = _matched(every, shares, [*shared, "ratio"]).select(*keys, "ratio", "bucket", "w")
    mine = own.select(*keys, "ratio", "bucket", (F.col("n") * SCALE).alias("w"))
    return mine.union(borrowed).groupBy(*keys, "ratio", "bucket").agg(F.sum("w").alias("w"))


def fences(weights: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: the least and the largest bucket of each ratio that isn't refused."""
    group = Window.partitionBy(*keys, "ratio")
    placed = weights.withColumn("below", F.sum("w").over(group.orderBy("bucket"))).withColumn(
        "total", F.sum("w").over(group)
    )
    low = F.min(F.when(4 * F.col("below") >= F.col("total"), F.col("bucket")))
    high = F.min(F.when(4 * F.col("below") >= 3 * F.col("total"), F.col("bucket")))
    ends = placed.groupBy(*keys, "ratio").agg(low.alias("low"), high.alias("high"))
    width = F.col("high") - F.col("low") + 1
    least, most = F.col("low") - REACH * width, F.col("high") + REACH * width
    sides = ends.withColumns({"least": least, "most": most})
    return sides.groupBy(*keys).agg(
        *(
            F.max(F.when(F.col("ratio") == r, F.col(side))).alias(f"{side}_{r}")
            for r in RATIOS
            for side in ("least", "most")
        )
    )


def group_fences(rows: DataFrame) -> DataFrame:
    """Fences by lang and source, of rows with ratios."""
    keys = ["lang", "source"]
    fine = sketches(rows, keys)
    language = merged(fine, ["lang"])
    every = merged(language, []).select("ratio", "bucket", (F.col("n") * SCALE).alias("w"))
    groups = rows.select(*keys).distinct()
    by_language = blended(language, groups.select("lang").distinct(), every, ["lang"], [])
    return fences(blended(fine, groups, by_language, keys, ["lang"]), keys)


def judged(documents: DataFrame) -> DataFrame:
    """doc_id, counts and verdict of each document.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated windows. The
    rest is kept if each of its ratios is within the fences of its language and source, which the
    documents that pass the base make. Null languages and sources are groups of their own; a null or empty
    text fails the base; repeated rows are judged alike, and count as often as they are there.
    """
    counts = with_ratios(with_counts(documents.select("doc_id", "lang", "source", "text")).drop("text"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = stored(counts.withColumn("base_failed", failed), "quality-counts")
    found = _matched(rows, group_fences(rows.where(~F.col("base_failed"))), ["lang", "source"], "left")
    inside = F.lit(True)
    for r, both in RATIOS.items():
        inside &= F.coalesce(bucket(F.col(r)) <= F.col(f"most_{r}"), F.lit(True))
        if both:
            inside &= F.coalesce(bucket(F.col(r)) >= F.col(f"least_{r}"), F.lit(True))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*names, "base_failed", (~F.col("base_failed") & inside).alias("kept"))
