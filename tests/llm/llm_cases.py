"""Small tables with the awkward cases: nulls, empty and very long texts, repeated rows."""

import random

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LONG = " ".join(f"w{i * 7919 % 60_013}" for i in range(60_000))


def prose(seed, words, vocabulary=5000):
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('abcdefgh')}o{draw.randrange(vocabulary)}" for _ in range(words))


def awkward():
    """Rows with every awkward case once."""
    return [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "a", 4),
        (4, LONG, "en", None, len(LONG)),
        (5, prose(5, 40), "en", "a", None),
        (6, prose(5, 40), "de", "b", 1),
        (6, prose(5, 40), "de", "b", 1),
        (7, "ä#€ \U0001f600 Zeile\nZeile\nZeile", "de", "b", 20),
        (8, "one", "en", "a", 3),
        (None, prose(9, 30), "en", "a", 5),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def clashing(frame, *names):
    """The same rows with further columns of names that the operators use themselves."""
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit(f"own {n}") for n in names})


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
