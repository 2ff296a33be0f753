import duckdb
import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, words string"


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, extra columns that clash."""
    long = " ".join(f"word{i % 977} Zoé" for i in range(40_000))
    rows = [(1, "a plain text of a few words here", "en", "s", 3, 9, "x"), (2, None, None, None, None, None, None),
            (3, "", "en", "s", 0, 1, "y"), (4, long, "fr", "s", 1, 1, "z"), (5, long, "fr", "t", 1, 1, "z"),
            (None, "no id at all", "en", None, 1, 1, "z"), (6, "same row", "de", "s", 1, 1, "z"),
            (6, "same row", "de", "s", 1, 1, "z"), (7, " \t\n ", "de", "s", 1, 1, "z"),
            (8, "<|endoftext|> 12 %%% ÉİK", "de", "s", 1, 1, "z")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def table(name, sf=SF):
    return duckdb.sql(f"select * from '{sf}/{name}.parquet'").df()
