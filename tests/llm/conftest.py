import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, block long, key string, length long"


def frame(spark, rows):
    """Documents with the columns of the table and others whose names the operators use."""
    return spark.createDataFrame([(i, t, la, s, len(t or ""), 0.5, 1, 2, "k", 3) for i, t, la, s in rows], COLUMNS)


def prose(rng, words, lang="en"):
    parts = {"en": ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"], "de": ["ein", "sch", "ung", "ver", "ge", "lich", "ü", "te"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", ",", "."]) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (None, "no id at all", "en", "a"), (4, "x" * 60_000, "en", "b"),
        (5, prose(rng, 20_000), "en", "b"), (6, "same text here", "en", "a"), (6, "same text here", "en", "a"), (7, "same text here", "en", "a"),
        (8, "a\x02b\x03c\x00d", "xx", "a"), (9, "中文 emoji 🙂 <|endoftext|> it's so", "zh", "c"), (10, "\n\n".join(["one line of words"] * 5), "en", "a"),
    ]
    return rows + [(i, prose(rng, 60), "en", "a") for i in range(20, 60)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return frame(spark, odd_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
