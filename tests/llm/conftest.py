"""Fixture tables of the training-data operators."""

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, row_hash long, "
          "size string, fp string, score string")


def plain(spark, rows):
    """documents of (doc_id, text[, lang[, source]])."""
    full = [(*r, *("en", "src0")[len(r) - 2:], None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


def words(n, seed=0, vocabulary=997):
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{(x >> 8) % vocabulary}")
    return " ".join(out)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, wordless and very long texts, ties, repeated rows, clashing extra columns."""
    long = words(60_000, 5)
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (2, "THE QUICK brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (2, "THE QUICK brown fox jumps over the lazy dog near the river bank", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog near the river BANK", "fr", None),
        (3, None, None, None), (3, None, None, None), (None, None, None, None),
        (4, "", "en", "b"), (5, " \n\t ", "de", "b"), (6, "?! ... 12", "es", "b"),
        (7, long, "en", "c"), (None, long, None, "c"), (8, long + " end", "en", "c"),
        (9, "été à la plage avec des amis et la famille", "fr", "d"), (10, "a", "en", "d"), (11, "a b", "en", None),
        (None, "only text", "en", "a"), (None, "only text", "en", "a"),
    ]
    return spark.createDataFrame([(*r, 1, True, 5, "x", "y", "z") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def multiset(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))
