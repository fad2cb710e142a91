from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHES = ["score", "label", "id", "digest", "_digest", "hash", "_hash", "bin", "shard", "kept", "n", "fp", "root", "ids", "_found", "_quality", "_rows", "cluster", "tokens", "batch"]
WORDS = {"en": "the of and that with thing where often house".split(), "fr": "été dans une leçon où être très français mère".split()}


def prose(lang: str, n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(WORDS[lang]) for _ in range(n))


def messy_rows() -> list[tuple]:
    """NULLs in every column, empty and blank texts, a very long one, ties, copies, near copies and repeated rows."""
    rows = [(i, prose(lang, 40 + i, i), lang, f"s{i % 3}", None) for i, lang in enumerate(["en", "fr"] * 12)]
    rows = [(i, t, lang, s, len(t)) for i, t, lang, s, _ in rows]
    long = prose("en", 30_000, 99)
    near = rows[4][1].split()
    near[-1] = "different"
    rows += [
        (100, rows[0][1], "en", "s0", 5),
        (2**60 + 1, rows[0][1], "en", None, None),
        (2**60 + 1, rows[0][1], "en", None, None),
        (101, long, "en", "s1", len(long)),
        (102, None, "fr", "s1", None),
        (103, "", None, None, 0),
        (104, "  \n\t ", "en", "s1", 5),
        (105, "12 345 !!", "en", "s2", 9),
        (106, "one", "en", "s2", 3),
        (107, " ".join(near), "en", "s0", 3),
        (None, rows[3][1], "fr", "s0", 7),
        (None, "ein ganz anderer text ohne nummer", None, "s0", 7),
        (-5, rows[3][1].upper(), "fr", "s0", 7),
    ]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(messy_rows(), DOCS).repartition(3)
    return docs.withColumns({c: F.lit("mine") for c in CLASHES})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(24)] + [(None, 1, 0), (101, None, None), (0, 0, 0), (999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
