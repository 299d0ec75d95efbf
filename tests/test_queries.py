from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from check import differences
from precis.plans.oracle import oracle_sql
from precis.plans.queries import QUERIES

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(tables):
    con = duckdb.connect()
    for file in Path(tables).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"rouge1_stemmed", "train_sentence_model"}
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, tables, name):
    got = QUERIES[name](spark, tables).toPandas()
    assert len(got)
    if name in ORACLES:
        assert differences(got, con.execute(ORACLES[name]).df()) == ""
