import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, shard int"


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, "one two three four five six seven", "en", "a"), (2, "one two three four five six seven", "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, "  \n ", None, "b"),
        (6, "Eine kleine Zeile\nmit Umbruch", "de", None), (None, "null id text here now", "en", "c"), (7, "word " * 30000, "en", "a"), (8, "x" * 70000, "de", "c"), (9, "9 8 7 !!", "fr", "b"),
        (10, "repeat row of words", "en", "a"), (10, "repeat row of words", "en", "a"), (11, "ONE two  three\tfour five six seven", "en", "a"), (12, "été à la plage 漢字 🙂", "fr", "c"),
    ]
    return spark.createDataFrame([(*r, 1, 0.5, "zz", 3) for r in rows], COLUMNS)


@pytest.fixture
def empty(odd):
    return odd.limit(0)
