import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, columns with clashing names."""
    line = "the same words come again and again in this line of text for every reader to see now"
    rows = [
        (1, None, None, None, None, "x", None), (2, "", "en", "", 0, None, "y"), (None, line, "en", "a", 1, None, None),
        (3, line, "en", "a", 1, None, None), (3, line, "en", "a", 1, None, None), (4, line + "\n" + line, "en", None, 1, None, None),
        (5, "!!! ### $$$", "de", "b", 1, None, None), (6, "der die das und ein Wort " * 3000, "de", "b", 1, None, None),
        (7, "aaaa" * 500, None, "b", 1, None, None), (8, "été \u2028 naïve café 日本語 \x1d x " * 20, "fr", "c", 1, None, None),
        (3, "another text under the same id, with enough words to be a document of its own", "en", "a", 1, None, None),
        (9, "Released under the MIT License.\n" + line, "en", "a", 1, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
