from __future__ import annotations

import pytest

#: Rows that every operator must take: missing values, empty and blank texts, ties and repeated rows, a long text.
LONG = "lorem ipsum dolor sit amet " * 8000


@pytest.fixture(scope="session")
def odd_rows():
    return [
        (0, "one two three four five six seven"), (1, None), (2, ""), (3, " \t\n"), (None, "one two three"),
        (None, None), (4, "one two three four five six seven"), (4, "one two three four five six seven"),
        (5, "Ünï ©ode 日本 \U0001f600 test"), (6, LONG), (7, LONG + "x"), (3, "another text of the same id"),
    ]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with further columns whose names operators might use themselves."""

    def make(rows):
        found = spark.createDataFrame(rows, "doc_id long, text string")
        extra = ("_file", "_row", "_id", "_text", "kept", "score", "doc", "fp", "n", "x", "class", "component_id")
        return found.selectExpr("doc_id", "text", *(f"'e' AS `{c}`" for c in extra))

    return make


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path
