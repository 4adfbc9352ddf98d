"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, kept string, doc string, block string, fp string, score string, ids string"
)


def awkward(extra: list[tuple[int | None, str | None]] = ()):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today"
    rows = [
        (1, base), (2, base), (3, base + " again"), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r"), (7, "word"), (8, "Two words"),
        (9, base.upper()), (10, "  " + base.replace(" ", "\n") + " "), (11, "é è ü " * 40), (12, "日本語テキスト" * 30),
        (13, "x" * 3000), (14, ("lorem ipsum dolor sit amet consectetur " * 4000).strip()), (15, "a\x00b \x85 c　d 😀"),
        (None, base), (None, None), (2, base), (16, "different words stand in this text so that nothing here is like another one at all"),
        *extra,
    ]
    return [(i, t, "en" if t else None, "s", None if t is None else len(t), 9, "k", "d", "b", "f", "s", "i") for i, t in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest test tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
