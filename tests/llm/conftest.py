from pathlib import Path

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i} of{i % 7}" for i in range(3000))
# Nulls in any column, empty and very long texts, repeated rows, repeated ids.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog tonight and sleeps", "a"),
    (2, "The quick  brown fox jumps\nover the lazy dog tonight and sleeps", None),
    (2, "The quick  brown fox jumps\nover the lazy dog tonight and sleeps", None),
    (3, None, "b"),
    (4, "", "b"),
    (5, " \t ", "b"),
    (None, "The quick brown fox jumps over the lazy dog tonight and sleeps", "c"),
    (None, "nobody knows me", None),
    (6, LONG, "c"),
    (7, "prefix " + LONG, "c"),
    (8, "Été ÀÉ 日本 ☃", "d"),
    (8, "another text under the same id", "d"),
    (9, "one", "d"),
]
# Names that the operators use inside.
CLASHES = ["fp", "n", "copy", "tokens", "at", "words", "digest", "trigger", "score", "u", "kept", "text_sha256", "size"]


@pytest.fixture(scope="session")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return frame.selectExpr("*", *[f"'x' AS {name}" for name in CLASHES])


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


@pytest.fixture(scope="session")
def given(spark):
    """``(doc_id, text)`` of the small table."""
    frame = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in frame.collect()]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)
