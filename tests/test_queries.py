"""Every registered query against its SQL in DuckDB, as rows in any order."""

import os
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from verification.oracles import all_oracles
from verification.queries import JDBC_URL_SETTING, _jdbc_url, all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The queries of the training-data operators have tests of their own.
QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted((tuple(str(v) for v in row) for row in rows.itertuples(index=False, name=None)))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(result.columns) == sorted(expected.columns)
    assert len(result) > 0
    assert canonical(result) == canonical(expected)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("master", ["local-cluster[3,2,3000]", "spark://host:7077", "yarn"])
def test_executors_of_their_own_need_a_named_database(master):
    with pytest.raises(ValueError, match=JDBC_URL_SETTING):
        _jdbc_url(SimpleNamespace(conf={"spark.master": master}))
    assert _jdbc_url(SimpleNamespace(conf={"spark.master": master, JDBC_URL_SETTING: "jdbc:x:y"})) == "jdbc:x:y"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[4,2]"])
def test_one_process_has_a_database_of_its_own(master):
    assert _jdbc_url(SimpleNamespace(conf={"spark.master": master})).startswith("jdbc:derby:memory:")
