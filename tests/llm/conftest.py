import pytest

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "a text without an id"),
    (4, "The same text twice."),
    (4, "The same text twice."),
    (5, "x" * 70_000 + " " + "y " * 30_000),
    (6, "Ünïcödé tëxt, 日本語 \U0001f600 é́"),
    (7, "a\x00b \x1c c\x85d　e"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash."""
    rows = [(*r, "en", f"s{k % 2}" if k else None, 0, "x", "y") for k, r in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, score string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
