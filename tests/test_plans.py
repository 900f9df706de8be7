"""Plan guards for every registered query: scale-hostile operators never appear."""

import pytest

import __spark_entry__ as E
from conftest import sf_dir
from tollgate.plans import catalog

QUERIES = {k: v for k, v in E.queries().items() if k in catalog.REGISTRY}

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()     # final (adaptive) plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products_or_python_rows(spark, name):
    plan = _plan(QUERIES[name](spark, sf_dir("0.001")))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} uses {op}"


@pytest.mark.parametrize("name", ["latest_event_per_user", "latest_turn_per_role", "status_mapping_sample",
                                  "enrich_latest_status"])
def test_latest_per_key_limits_rows_before_the_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, sf_dir("0.001")))
    assert "WindowGroupLimit" in plan


def test_scans_read_only_checked_columns(spark):
    plan = _plan(QUERIES["dup_lineitem_key"](spark, sf_dir("0.001")))
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln]
    assert scans and all("[l_orderkey#" in ln and "l_extendedprice" not in ln
                         and "l_shipdate" not in ln for ln in scans)


def test_hashed_text_keys_shuffle_digests(spark):
    plan = _plan(QUERIES["dup_document_text"](spark, sf_dir("0.001")))
    assert "sha2" in plan
