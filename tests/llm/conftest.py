"""Messy tables that every operator and stage must take."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, n string, kept string, value int, _doc int"
EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "The river runs along the old wall and the people of the town walk there in the evening. "


def row(doc_id, text, source="src0"):
    return (doc_id, text, None, source, None if text is None else len(text), 7, "x", "y", None, 3)


@pytest.fixture(scope="session")
def messy(spark):
    """NULL ids and texts, empty and blank texts, repeated rows, one id with two texts, a very long text, names that clash."""
    long = PROSE + " ".join(f"w{i % 4999} number{i}" for i in range(60000)) + "\n" + "é" * 3000
    rows = [row(1, PROSE * 9), row(1, PROSE * 9), row(2, None), row(3, ""), row(4, " \t\n"), row(None, PROSE * 9), row(None, "other words"), row(5, long, None)]
    rows += [row(6, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" here"), row(6, "mail a.b@c.example now"), row(7, "x" * 150), row(8, "x" * 150), row(9, "\ud7ff🙂 " * 40)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EMPTY)
