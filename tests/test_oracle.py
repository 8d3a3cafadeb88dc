"""Every registered query against its SQL twin in DuckDB on the sf0.001 tables."""

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, queries
from pumpline.plans.registry import ORACLE_SQL

TABLES = ["region", "nation", "customer", "events", "pages"]


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, float):
            return round(v, 9)
        if isinstance(v, pd.Timestamp):
            return v.to_pydatetime().replace(tzinfo=None)
        return v
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")),
                        key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_entry(spark):
    assert entry(spark).count() > 0


def assert_matches(spark, con, sf, query, sql):
    s = query(spark, sf).toArrow()
    d = con.sql(sql).to_arrow_table()
    assert {f.name: str(f.type) for f in s.schema} == {f.name: str(f.type) for f in d.schema}
    assert _rows(s.to_pandas()) == _rows(d.to_pandas())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, sf_small, name):
    assert_matches(spark, con, sf_small, queries()[name], ORACLE_SQL[name])
