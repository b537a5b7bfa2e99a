import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal ids, clashing columns."""
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \t\n ", "en", "b", 4),
        (4, LONG, "en", "a", len(LONG)),
        (5, "one two three four five six seven eight nine ten eleven", "de", "b", 1),
        (5, "one two three four five six seven eight nine ten eleven", "de", "b", 1),
        (6, "one two three four five six seven eight nine ten eleven", "de", None, 1),
        (7, "Ünïcode ▁ mark\x00 漢字 and \U0001f600\nline\nline\n\nline", "xx", "c", 9),
        (None, "no id here but some words to count for everyone in it", "en", "c", 2),
        (None, None, None, None, None),
    ]
    extra = ("size", "ids", "decoded", "n_tokens", "fp", "shard", "measures2", "WORD")
    df = spark.createDataFrame([(*r, *("x",) * len(extra)) for r in rows], DOCS + "".join(f", {c} string" for c in extra))
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
