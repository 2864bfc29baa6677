from __future__ import annotations

import random
import re

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, _row string, _key string, copies int, kept string, dropped int"


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary):x}" for _ in range(n)]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None, 1.5, "r", "k", 7, "x", 3)


PASSAGE = " ".join(words(60, 99))


def odd_rows():
    """Nulls, empty and very long texts, repeats, ties, copies, other scripts."""
    long_text = "\n".join(" ".join(words(50, s, 5000)) for s in range(300))
    return [
        row(1, None),
        row(2, ""),
        row(3, " \t\n\x0b "),
        row(None, "a text without an id " + PASSAGE),
        row(None, None, None, None),
        row(4, long_text, "de", None),
        row(5, " ".join(words(80, 1))),
        row(5, " ".join(words(80, 1))),
        row(6, " ".join(words(80, 1))),
        row(7, "Before. " + PASSAGE + "\nafter it"),
        row(8, PASSAGE),
        row(9, "Größe   ÄÖÜ Straße   K\x00 \x1f x\x85y 漢字 MIT License"),
        row(10, "x " * 500),
        row(11, "ä" * 5000),
        row(12, "same", "fr", "b"),
        row(13, "same", "fr", "b"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(k, int(k != 10), 0) for k in (4, 5, 6, 7, 8, 10, 10)] + [(9, None, 0), (None, 1, 0), (77, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [(1, PASSAGE), (1, PASSAGE), (2, "short item"), (3, None), (4, ""), (None, " ".join(words(80, 1)[20:32])), (5, "漢字 MIT")]
    return spark.createDataFrame(rows, "item_id long, text string")
