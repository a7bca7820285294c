"""Invented texts."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=3000):
    rng = random.Random(seed)
    return ["".join(rng.choice("bcdfgklmnprstv") + rng.choice("aeiou") for _ in range(1 + rng.randrange(vocabulary) % 4)) for _ in range(n)]


def prose(n, seed):
    return " ".join(words(n, seed))


def rows(texts, first=0):
    return [(first + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def frame(spark, texts, first=0):
    return spark.createDataFrame(rows(texts, first), SCHEMA)
