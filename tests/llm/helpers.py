"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta " * 6000


def awkward_rows():
    """Nulls in every column, empty and blank and long texts, ties and repeated rows."""
    rows = [
        (0, "One two three four five six seven.\nOne two three four five six seven.\n", "en", "a", 70),
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n ", "fr", "b", 4),
        (4, LONG, "en", "a", len(LONG)),
        (5, LONG.upper(), "en", None, len(LONG)),
        (6, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich.", "de", "c", 64),
        (6, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich.", "de", "c", 64),
        (None, "no number", "en", "c", 9),
        (7, "NO NUMBER", "xx", "c", 9),
        (8, "emoji 👩‍👩‍👧 \x1c\x85   nul \x00 tab\tend", "en", "", 30),
        (9, "同じ文書 です", "ja", "b", 7),
    ]
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
