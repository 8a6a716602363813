"""Every registered query against its oracle in DuckDB, on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from wareflow.fixtures import TABLES
from wareflow.queries import registry

DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    plain = lambda v: None if pd.isna(v) else round(float(v), 5) if isinstance(v, (float, int, np.floating, np.integer)) and not isinstance(v, bool) else v
    return sorted((tuple(map(plain, r)) for r in df.astype(object).itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    found = QUERIES[name](spark, DIR).toPandas()
    if name not in SQL:
        assert len(found.columns)
        return
    wanted = oracle.execute(SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
