import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    out = []
    for i in range(words):
        word = "".join(rng.choice("aeiou" if j % 2 else "bdfklmnrst") for j in range(rng.randint(2, 7)))
        out.append(word.capitalize() if i % 9 == 0 else word + "." if i % 9 == 8 else word)
    return " ".join(out)


def edited(text, places):
    words = text.split(" ")
    for p in places:
        words[p] = "zzz"
    return " ".join(words)


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, copies, a very long text."""
    base = prose(1, 300)
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, edited(base, [100]), "en", "b", 1),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \t\n\x0b ", "en", "b", 0),
        (7, prose(2, 80), None, None, 3),
        (7, prose(2, 80), None, None, 3),
        (8, "one", "fr", "é", 3),
        (9, "One", "fr", "z", 3),
        (10, prose(3, 60) + "\n" + prose(4, 60), "fr", "z", 3),
        (11, prose(5, 40) + "\n" + prose(4, 60), "fr", "z", 3),
        (12, prose(6, 30_000), "en", "a", 3),
        (13, "1234 5678 !!", "en", "a", 3),
        (None, prose(7, 50), "en", "a", 3),
        (None, prose(7, 50), "en", "a", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
