import pytest

from machinewatch.llm.common import prepare

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(ready):
    return ready.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(ready):
    """Nulls, an empty and a very long text, copies, repeated rows, and columns named like results."""
    long_text = "The quick brown fox jumps over 13 lazy dogs, again. " * 6000
    copy = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None), (2, "", "en"), (3, long_text, "en"), (4, copy, "de"), (4, copy, "de"), (5, copy, None),
            (None, "no id at all here", "en"), (6, " \t\n\r ", "fr"), (7, "x" * 50_000, "en"), (8, "été 日本語 <|endoftext|>", "fr"),
            (9, "12 34 !!", None)]
    clash = "'s' as score, 1 as n_words, 'f' as fp, 0 as row, 'k' as key, 7 as n, 'i' as ids, 2 as n_tokens, true as kept, " \
            "'r' as _r, 'y' as _row, 't' as t, 'd' as d, 'z' as _stay, 'p' as part, 'l' as lang_pred, 'c' as component_id"
    return ready.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def empty(documents):
    return documents.where("false")
