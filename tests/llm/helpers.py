"""Small tables with every awkward case for the text operators."""

from __future__ import annotations

LONG = "sand silt tide bank marsh " * 40_000  # a million characters

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and a column named like a result."""
    rows = [
        (1, "The tide rises over the wide flats and the birds rest.", "en", "a", 5, 9.0),
        (1, "The tide rises over the wide flats and the birds rest.", "en", "a", 5, 9.0),
        (2, None, None, None, None, None),
        (3, "", "en", "b", 0, 0.0),
        (None, "The tide falls.", "en", None, 15, 1.0),
        (None, None, None, None, None, None),
        (4, " \t\n ", "", "b", 4, 1.0),
        (5, LONG, "en", "a", len(LONG), 1.0),
        (6, "Ümläut ÀÉ 漢字 🙂 1234 !!", "de", "", 23, 2.0),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
