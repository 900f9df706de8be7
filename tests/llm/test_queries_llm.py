"""Registered queries: names, and those that SQL can express against DuckDB."""

import pytest

import __spark_entry__ as E
from conftest import sf_dir
from oracle import compare, duck
from tollgate.llm.registry import REGISTRY


def test_the_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in REGISTRY} == {f"op{i}" for i in range(1, 14)}
    assert set(REGISTRY) <= names and "pipeline" in names


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_matches_sql(spark, name, sf):
    r = compare(E.queries()[name](spark, sf_dir(sf)), duck(sf_dir(sf)), E.oracle_sql()[name])
    assert r["cols_match"] and r["rows"][0] == r["rows"][1]
    assert r["hash_match"], (r["spark_sample"], r["duck_sample"])
