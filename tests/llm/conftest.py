"""Small tables with the awkward cases, shared by all operators."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, bytes long, bits string, piece int, n int, copies string"


def words(rng, count):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 8))) for _ in range(count))


@pytest.fixture(scope="session")
def doc_rows():
    """(doc_id, text, lang): nulls, empty and very long texts, copies, near copies, repeated rows, ties."""
    rng = random.Random(4)
    shared = words(rng, 60)
    base = [words(rng, rng.randint(60, 300)) for _ in range(40)]
    rows = [(i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(base)]
    rows += [(100, None, "en"), (101, "", None), (102, "", "de"), (103, " \n\t ", "en"), (104, "one two", "en")]
    rows += [(110 + i, base[3], "en") for i in range(6)]
    rows += [(120 + i, base[4].replace(" ", "  ", 1) if i else base[4] + " again", "de") for i in range(3)]
    rows += [(130, base[5] + "\n" + shared + "\n" + base[6], "en"), (131, base[7] + " " + shared, "en")]
    rows += [(140, base[8], "en"), (140, base[8], "en"), (141, base[9], None), (141, base[9], None)]
    rows += [(None, base[10], "en"), (None, None, None)]
    rows += [(150, words(rng, 30_000), "en"), (151, "x" * 200_000, "de"), (152, "é中😀<|endoftext|> " * 60, "fr")]
    rows += [(153, "### same line here\n" * 30, "en"), (154, "A b C d " * 40, "en"), (155, base[11].upper(), "en"), (156, base[11], "en")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    rows = [(d, t, lang, None if d == 3 else "src", len(t or ""), "k", 1, "b", 2, 3, "c") for d, t, lang in doc_rows]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, int(i % 4 != 0), int(i % 7 == 0)) for i in range(40)] + [(None, 1, 0), (5, None, 1), (900, 1, 1), (6, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
