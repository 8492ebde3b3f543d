from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor sit amet " * 4000
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, size int, taken int, target string, rep int, "
    "kept int, bands string, live int, hits int, row int, owner int, part int, block int, spans string, label int, toxic int, decoded int, ids int"
)


def rows(*given):
    """Documents from (doc_id, text, lang, source), with columns that clash with names the operators use."""
    return [(i, t, lang, src, len(t) if t is not None else None, 0.5, 1, 2, "x", 3, 4, "b", 5, 6, 7, 8, 9, 10, "s", 11, 12, 13, 14) for i, t, lang, src in given]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing columns."""
    same = "the same words again and again in one text of ten"
    given = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, "b"), (4, LONG, "en", None), (5, same, "en", "a"), (6, same, "en", "b"),
        (None, same, "en", "a"), (None, None, None, None), (7, "x", "de", "c"), (7, "x", "de", "c"), (7, "y other", "de", "c"),
        (8, "!!! ??? ...", "en", "c"), (9, "日本語 の テキスト です", "ja", "a"), (10, "a" * 5000, "en", "a"), (11, "é ß İ ſ K", "tr", "a"),
    ]
    return spark.createDataFrame(rows(*given), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
