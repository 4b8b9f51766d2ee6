"""The bound queries against their SQL counterparts, and the driver contract."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# Model fitting has no SQL form; these are tested in test_learning.
FITTED = {"lasso_cv", "mlp_cv", "train_score_metrics", "train_top_features"}
# The other volume queries are steps of this one and tested in test_volumes.
VOLUMES = ["image_features", "glcm_counts", "resample_linear", "mesh_tables", "image_job"]
CHECKED = [
    name
    for part in entry._PARTS
    for name in part.ORACLES
    if part.__name__ != "bindings.images" or name in VOLUMES
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_contract():
    queries, oracles = entry.queries(), entry.oracle_sql()
    own = {name for part in entry._PARTS for name in part.QUERIES}
    assert own - set(oracles) == FITTED
    assert own <= set(queries) and set(oracles) <= set(queries)
    assert len(own) == sum(len(part.QUERIES) for part in entry._PARTS)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, SF)
    theirs = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(columns) == sorted(ours.columns)
    want = sorted(theirs.fetchall(), key=repr)
    assert want
    assert sorted(map(tuple, ours.select(*columns).collect()), key=repr) == want


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 20 and df.count() > 0
