import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case: nulls, empty texts, repeats, ties, a long text, and columns with common names."""
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [
        (0, "The cat sat on the mat, and it was warm.", "en", "b", 1),
        (1, "the CAT sat on the mat, and it was warm.", "en", "b", 2),
        (2, None, None, None, 3),
        (3, "", "en", "a", 4),
        (4, " \t\n ", "fr", "a", 5),
        (5, "Le chat était assis sur le tapis, près de la fenêtre ouverte.", "fr", "\U0001f600", 6),
        (6, long, "en", "é", 7),
        (7, "one", "en", None, 8),
        (7, "one", "en", None, 8),
        (None, "no id here", "en", "b", 9),
        (None, None, "fr", "b", 10),
        (10, "123 456 !!! \U0001f600", None, "b", 11),
        (11, "mail me: a.b@c.example.org or +49 (30) 1234-5678; card 4111 1111 1111 1111, host 10.0.0.255.", "en", "b", 12),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    wide = spark.createDataFrame(rows, schema)
    for name in ("size", "slot", "part", "group", "fp", "key", "score", "toxic", "kind", "start", "label", "r", "e"):
        wide = wide.selectExpr("*", f"n_chars AS {name}")
    return wide


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
