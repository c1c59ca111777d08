import pytest

AWKWARD = [
    (1, "Hello world, it's a test.\n\nTwo  spaces   here "), (2, None), (3, ""), (4, "   "), (5, "\n\t "),
    (6, "héllo wörld ÀÉ ñandú 漢字 と カナ 🙂🙂 ​ x"), (7, "a" * 9000), (8, "word " * 4000),
    (9, "Hello World, it's a test.\n\nTwo  spaces   here "), (10, "x<|endoftext|>y"), (11, "漢" * 5000),
    (12, "it's we'll they've 'tis don't" * 300), (13, "1 2 3 4 5 6 7 8 9 10 " * 500), (13, "1 2 3"),
    (None, "no identifier"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated identifiers, and extra columns whose names clash."""
    rows = [(i, t, "en", None, 1, 2.0, "z") for i, t in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n long, length double, salt string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
