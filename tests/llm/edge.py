"""Rows that every operator must take: nulls, empty and very long texts, repeats, clashing column names."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, key string, group string, "
          "path long, label int, score double, kept boolean, n_words string, run string, pos int, part int, at int")


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("an", "be", "co", "du", "el", "fi")) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


TEXTS = [
    (1, None), (2, ""), (3, "one two"), (3, "one two"), (None, words(1, 80)), (5, words(2, 30_000)),
    (6, words(3, 120)), (7, words(3, 120)), (7, words(3, 120)), (8, "   \n\t "), (9, "ein Wörtchen über naïve Café\n" * 40),
    (10, words(4, 300) + " extra"), (11, words(4, 300) + " other"),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None, k, "k", "g", 1, 0, 0.5, True,
             "7", "r", 1, 2, 3) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
