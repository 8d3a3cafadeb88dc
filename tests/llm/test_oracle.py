"""The text operators' registered queries against their SQL twins, and the
columns and folds that the registered queries promise."""

import zlib

import duckdb
import pytest

from pumpline.llm.registry import ORACLE_SQL, QUERIES
from tests.test_oracle import assert_matches


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, sf_small, name):
    assert_matches(spark, con, sf_small, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name, modulus, fold, least", [("op1_quality", 4, 2, 0.7), ("op2_language", 4, 2, None),
                                                        ("op3_lm", 7, 2, None), ("op9_toxicity", 5, 0, 0.5)])
def test_folds_and_columns(spark, sf_small, name, modulus, fold, least):
    rows = QUERIES[name](spark, sf_small).collect()
    assert len(rows) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == fold)
        if least is not None:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
