"""Awkward documents that every operator has to take."""

from __future__ import annotations

import random
from contextlib import contextmanager

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept int, row double"


def documents(spark, extra=()):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and columns that clash."""
    draw = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "délta", "#x", "the", "of", "and\n", "zeta", "\tom"]
    texts = [" ".join(draw.choice(words) for _ in range(n)) for n in (0, 1, 2, 3, 4, 60, 61, 200, 200, 400)]
    texts += ["", " \n\t ", None, "a" * 3000, "na " * 3000, "one\ntwo\none\n", "x y z", "💥▁ two  spaces "]
    texts += [texts[7], texts[7], texts[9] + " end", texts[9] + " fin", *extra]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("b", "a", None, "é")[i % 4], len(t or ""), "7", 1, 0.5) for i, t in enumerate(texts)]
    rows += [rows[8], (None, texts[8], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def in_many_files(spark, df, folder, files=40):
    """The frame as read from many small files."""
    df.repartition(files).write.parquet(folder)
    return spark.read.parquet(folder)


@contextmanager
def other_splits(spark, number):
    """Files dealt to another number of tasks, as when executors come or go."""
    key = "spark.sql.files.minPartitionNum"
    spark.conf.set(key, str(number))
    try:
        yield
    finally:
        spark.conf.unset(key)
