"""Every core query against its SQL on the smallest tables."""

import glob
import numbers
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from folioforge.queries.registry import QUERIES, SQL


def rows(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if isinstance(v, (list, np.ndarray)):
            return str(list(v))
        if pd.isna(v):
            return None
        if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)):
            return round(float(v), 6)
        return str(v)

    return sorted((tuple(str(one(x)) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)))


@pytest.fixture(scope="module")
def duck(root):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{root}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, root, duck, name):
    got = QUERIES[name](spark, root).toPandas()
    if name in SQL:
        want = duck.execute(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns) > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
