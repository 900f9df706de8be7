"""Unit: reporting over outcome tables (statuses, summaries, decision, triage)."""

from pyspark.sql import functions as F

from tollgate.functions import rules as R
from tollgate.outcome import OUTCOME_SCHEMA, empty_outcomes
from tollgate.plans import reporting


def _outcomes(spark, rows):
    return spark.createDataFrame([(r[0], "test", r[2], r[1], {}) for r in rows], OUTCOME_SCHEMA)


def test_ready_when_no_outcomes(spark):
    e = empty_outcomes(spark)
    d = reporting.release_decision(e).first()
    assert d is None or d.status == R.STATUS_READY
    runs = spark.createDataFrame([("b1",)], "bundle string")
    eb = e.withColumn("bundle", F.lit("b1"))
    d = reporting.release_decision(eb, ["bundle"], runs=runs).first()
    assert d.status == "Ready" and d.failed_rules == [] and d.blocking_root_causes is None
    s = reporting.gate_status(eb, ["bundle"], runs=runs).first()
    assert s.status == "Ready" and s.rule_count == 0


def test_warning_only_on_non_critical_defects(spark):
    o = _outcomes(spark, [("BR-04", "warning", False)])
    d = reporting.release_decision(o).first()
    assert d.status == R.STATUS_WARNING_ONLY and d.blocking_root_causes is None
    c = {r.root_cause: r.defect_count for r in reporting.defect_counts(o).collect()}
    assert c == {"invalid_business_rule_state": 1}


def test_blocks_on_critical_duplicate(spark):
    o = _outcomes(spark, [("exam_results-uniqueness-1", "critical", False)])
    d = reporting.release_decision(o).first()
    assert d.status == R.STATUS_BLOCKED and d.blocking_root_causes == ["duplicate_record"]
    assert d.failed_rules[0].root_cause == "duplicate_record"
    s = reporting.defect_summary(o).first()
    assert s.root_cause_counts == {"duplicate_record": 1} and s.defect_count == 1


def test_decision_names_first_critical_rule_in_order(spark):
    o = _outcomes(spark, [("BR-04", "warning", False), ("BR-08", "critical", False),
                          ("BR-07", "critical", False)]).withColumn(
        "seq", F.when(F.col("rule_id") == "BR-04", 0).when(F.col("rule_id") == "BR-08", 1).otherwise(2))
    d = reporting.release_decision(o).first()
    assert d.decision_reason == "Critical failure BR-08 blocks release."
    assert d.blocking_root_causes == ["integrity_issue", "stale_data"]
    ref = reporting.release_decision(o, reason_rule="first_failing").first()
    assert ref.decision_reason == "Critical failure BR-04 blocks release."
    assert [x.rule_id for x in d.failed_rules] == ["BR-04", "BR-08", "BR-07"]


def test_validation_summary_lists_rules_in_order(spark):
    o = _outcomes(spark, [("b", "info", True), ("a", "critical", False)]).withColumn(
        "seq", F.when(F.col("rule_id") == "b", 0).otherwise(1))
    s = reporting.validation_summary(o).first()
    assert s.rule_count == 2 and s.failed_count == 1 and [r.rule_id for r in s.rules] == ["b", "a"]
    assert s.rules[1].remediation_link == "docs/rule-severity-matrix.md#a"


def test_root_cause_order_and_slug(spark):
    cases = {
        "candidates-required-columns": "schema_issue", "x-dtype-score": "schema_issue",
        "exam_results-uniqueness-unique-2": "duplicate_record", "BR-09": "duplicate_record",
        "BR-07b": "integrity_issue", "my-fk": "integrity_issue", "BR-08": "stale_data",
        "freshness-x": "stale_data", "BR-05-pass": "invalid_business_rule_state",
        "EXTRA-01": "invalid_business_rule_state", "schema-duplicate": "schema_issue",
    }
    df = spark.createDataFrame([(k,) for k in cases], "rule_id string")
    got = {r.rule_id: r.rc for r in df.select("rule_id", R.root_cause().alias("rc")).collect()}
    assert got == cases
    slugs = spark.createDataFrame([("  Exam_Results Rule!! ",), ("--x--",), ("!!!",)], "rule_id string")
    out = [r.s for r in slugs.select(R.slugify_rule_id().alias("s")).collect()]
    assert out == ["exam-results-rule", "x", "!!!"]


def test_severity_matrix_maps_mapping_failure_to_consistency(spark):
    o = _outcomes(spark, [("BR-05-pass", "critical", False)])
    r = reporting.severity_enrich(o).first()
    assert r.rule_family == "BR-05" and r.dimension == "Consistency"
