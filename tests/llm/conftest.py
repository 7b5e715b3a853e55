import random

import pytest

ALPHABET = "the of and to red blue green stone river cloud apple window music paper".split()
EDGES = [None, "", " ", "\n", "\n\n x \n", "a", "Ünï çödé 日本", "the", "!!! ???", "x\ty\x0bz", "line one\nline two\n"]


def prose(seed, words):
    pick = random.Random(seed)
    return " ".join(pick.choice(ALPHABET) + (pick.choice("abcdef") if pick.random() < 0.3 else "") for _ in range(words))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, blanks, ties, repeated rows and ids, and a long text."""
    rows = [(i, t) for i, t in enumerate(EDGES)]
    rows += [(100 + i, prose(i, 40)) for i in range(12)]
    rows += [(200, prose(1, 40)), (200, prose(1, 40)), (200, "another text under the same id"), (None, "a text without an id")]
    rows += [(None, None), (300, prose(9, 20_000)), (301, "x" * 50_000), (302, "7 " * 20_000)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The same rows with columns whose names clash with those that operators make."""
    taken = ["lang", "score", "fp", "kept", "hits", "_row", "n_lines", "key", "part", "digest", "label"]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in taken)
    return spark.createDataFrame([(i, t, *["c"] * len(taken)) for i, t in edge_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, n_chars bigint")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
