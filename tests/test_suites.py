"""Checkpoint of the four feed suites over every fixture bundle in one plan."""

import pytest
from pyspark.sql import functions as F

from tollgate.operators import expectations as ex
from tollgate.plans.gate import GateConfig, ReleaseGate


@pytest.fixture(scope="module")
def results(spark, bundles_root, tmp_path_factory):
    store = str(tmp_path_factory.mktemp("store") / "results")
    gate = ReleaseGate(spark, GateConfig(data_root=str(bundles_root)))
    res = gate.run_checkpoint(run_name="ingest-validation", store_path=store)
    return spark.read.parquet(store), res


def _failing(df):
    rows = df.where(~F.col("success")).select("bundle", "suite", "expectation_type", "column_name").collect()
    out = {}
    for r in rows:
        out.setdefault(r.bundle, set()).add((r.suite, r.expectation_type, r.column_name))
    return out


def test_suite_failures_per_bundle(results):
    stored, _res = results
    f = _failing(stored)
    assert "good" not in f
    assert ("candidates_suite", "expect_column_values_to_be_unique", "candidate_id") in f["duplicate-candidate-id"]
    assert ("exam_results_suite", "expect_table_columns_to_match_ordered_list",
            "exam_result_id,candidate_id,exam_code,exam_date,attempt_number,score,score_scaled,pass_fail,exam_location,file_received_ts") \
        in f["missing-required-column"]
    assert ("exam_results_suite", "expect_column_values_to_be_between", "score") in f["invalid-score"]
    assert ("cert_status_suite", "expect_column_values_to_be_in_set", "certification_status") \
        in f["cert-status-inconsistent-with-exam"]
    assert ("exam_results_suite", "expect_compound_columns_to_be_unique",
            "candidate_id,exam_code,attempt_number") in f["regression-duplicate-exam-attempt"]


def test_parameters_are_per_bundle_and_stats(results):
    stored, res = results
    # exam dates lie within their own bundle's min/max: never a failure
    between = stored.where((F.col("column_name") == "exam_date") & ~F.col("success"))
    assert between.count() == 0
    stats = ex.suite_statistics(res, ["bundle"]).where(F.col("bundle") == "good").collect()
    assert {r.suite: r.evaluated_expectations for r in stats} == {
        "candidates_suite": 5, "exam_results_suite": 10, "cert_status_suite": 8, "freshness_suite": 2}
    assert stored.select("suite", "run_name").distinct().count() == 4
