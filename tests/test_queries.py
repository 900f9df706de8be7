"""Every registered query against its DuckDB oracle, plus the flagship entry."""

import pytest

import __spark_entry__ as E
from conftest import sf_dir
from oracle import compare, duck
from tollgate.plans import catalog

# The operators of the llm subpackage have tests of their own.
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.REGISTRY}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in catalog.REGISTRY}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(sf_dir("0.001"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, sf_dir("0.001"))
    r = compare(df, con, ORACLES[name])
    assert r["cols_match"], (r["spark_cols"], r["duck_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"], (r["spark_sample"], r["duck_sample"])


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.rule_id == "lineitem-uniqueness-unique-1" and r.root_cause == "duplicate_record"
    assert r.gate_status in ("Blocked", "Ready")


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_result_types_match_oracle(spark, con, name):
    df = QUERIES[name](spark, sf_dir("0.001"))
    rel = con.sql(ORACLES[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert SPARK_TO_DUCK.get(t, t) == duck_types[f.name], (f.name, t, duck_types[f.name])
