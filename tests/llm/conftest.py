import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = "\n".join(f"line number {i} of a very long text that goes on and on" for i in range(3000))
    rows = [
        (1, "one two three four five six seven eight nine ten", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n ", "en", "b", 3), (5, long, "en", "b", 9),
        (6, "one two three four five six seven eight nine ten", "en", "a", 1), (6, "one two three four five six seven eight nine ten", "en", "a", 1), (7, "solo", "de", "c", 4),
        (8, "Ünïcödé tëxt 日本語 \U0001f600 ok", "de", None, 5), (None, "a text without a key that still has to be kept", "en", "a", 2), (None, None, None, None, None), (9, long + "!", "en", "b", 9),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clash(odd):
    """Columns with the names of results and of helpers."""
    from pyspark.sql import functions as F

    names = ("shard", "slot", "law", "position", "host", "path", "rule", "verdict", "lang_pred", "score", "n_removed", "tokens", "copies", "block", "place", "weight", "component_id", "fingerprint", "k", "v", "id", "node", "root", "size", "part", "own", "rank", "key", "row", "piece")
    return odd.withColumns({c: F.lit("x") for c in names})
