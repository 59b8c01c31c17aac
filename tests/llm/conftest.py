import pytest

from lakeload.llm.scratch import prepare

LONG = "wide words of a very long text " * 9000

#: Nulls, empty and very long texts, ties, repeated rows.
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 55),
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 55),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \n\t \n", "en", "b", 5),
    (5, LONG, "en", "c", len(LONG)),
    (None, "no id has this text", "en", "c", 19),
    (6, "word", "en", "a", 4),
    (7, "Ünïcode ␛ <|turn|> </s>\nline", "de", None, 28),
]
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in ("row", "node", "batch", "tokens", "place", "site", "key", "good", "part", "line", "bad_id", "only_id", "lost_id", "label_id")
)


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Documents of every odd kind, with extra columns named like those the operators make."""
    return llm.createDataFrame([(*row, *["x"] * 14) for row in ROWS], FIELDS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
