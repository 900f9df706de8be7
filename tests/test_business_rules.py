"""Unit: business rules on literal frames."""

import datetime as dt

from tollgate.operators import business, integrity


def test_score_range_warns_for_out_of_range(spark):
    df = spark.createDataFrame([("ER-1", 95, 95), ("ER-2", 120, 120)],
                               "exam_result_id string, score bigint, score_scaled bigint")
    o = business.check_score_range(df, "score", "BR-04", max_value=100).first()
    assert not o.passed and o.severity == "warning" and o.out_of_range_count == 1


def test_score_range_counts_invalid_formats_and_missing_column(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,), ("1d",)], "score string")
    o = business.check_score_range(df, "score", "BR-04").first()
    assert o.invalid_format_count == 2 and o.out_of_range_count == 0
    m = business.check_score_range(df, "nope", "BR-04").first()
    assert not m.passed and m.description == "Column 'nope' is missing."


def test_exam_date_window_flags_future_dates(spark):
    df = spark.createDataFrame([("ER-1", "2027-04-01T00:00:00Z")], "exam_result_id string, exam_date string")
    o = business.check_exam_date_window(df, dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc), 12, "BR-06").first()
    assert not o.passed and o.severity == "warning" and o.out_of_window == 1 and o.window_days == 366


def test_exam_date_window_bounds_inclusive_and_null_ok(spark):
    df = spark.createDataFrame([("2025-03-01T00:00:00",), ("2026-03-01T00:00:00",), (None,)], "exam_date string")
    o = business.check_exam_date_window(df, "2026-03-01T00:00:00Z", 12).first()
    # 2026-03-01 minus 366 days is 2025-02-28, so both dates are inside.
    assert o.passed and o.severity == "info"


def test_pass_fail_certification_detects_mismatch(spark):
    exam = spark.createDataFrame([("C-1", "ER-1", "Pass")], "candidate_id string, exam_result_id string, pass_fail string")
    cert = spark.createDataFrame([("C-1", "NeedsReview", "2026-02-01T00:00:00Z")],
                                 "candidate_id string, certification_status string, status_effective_ts string")
    rows = {r.rule_id: r for r in business.check_pass_fail_certification(exam, cert).collect()}
    p = rows["BR-05-pass"]
    assert not p.passed and p.severity == "critical" and p.mismatch_count == 1 and p.missing_count == 0
    assert rows["BR-05-fail"].passed and rows["BR-05-fail"].severity == "info"


def test_latest_status_null_timestamp_wins_and_missing_counts_in_mismatch(spark):
    exam = spark.createDataFrame([("A", "Pass", 1), ("A", "Pass", 2), ("B", "P", 3), ("C", "Fail", 4)],
                                 "candidate_id string, pass_fail string, n int")
    cert = spark.createDataFrame([("A", "Certified", "2026-01-01", "1"), ("A", "Not Certified", None, "2"),
                                  ("C", "Certified", "2026-01-01", "3")],
                                 "candidate_id string, certification_status string, status_effective_ts string, cert_status_id string")
    rows = {r.rule_id: r for r in business.check_pass_fail_certification(
        exam, cert, tie_cols=("cert_status_id",), order_col="n").collect()}
    p, f = rows["BR-05-pass"], rows["BR-05-fail"]
    assert p.mismatch_count == 3 and p.missing_count == 1        # A (null ts wins) x2, B missing
    assert p.sample_candidates == ["A", "B"]
    assert f.mismatch_count == 1 and f.severity == "warning" and f.sample_candidates == ["C"]


def test_null_candidate_keys_match_each_other(spark):
    exam = spark.createDataFrame([(None, "Pass")], "candidate_id string, pass_fail string")
    cert = spark.createDataFrame([(None, "Certified", "2026-01-01")],
                                 "candidate_id string, certification_status string, status_effective_ts string")
    rows = {r.rule_id: r for r in business.check_pass_fail_certification(exam, cert).collect()}
    assert rows["BR-05-pass"].passed


def test_freshness_uses_file_timestamp_column(spark):
    df = spark.createDataFrame([("2026-01-10T08:00:00Z", "ER-100")], "file_received_ts string, exam_result_id string")
    o = business.evaluate_freshness(df, reference_ts="2026-03-03T17:42:35Z",
                                    timestamp_column="file_received_ts",
                                    max_allowed_hours=24, warning_hours=48).first()
    assert not o.passed and o.severity == "critical" and o.timestamp_source == "file_received_ts"


def test_freshness_thresholds_and_fallback_to_file_time(spark):
    df = spark.createDataFrame([("a", None, "2026-01-01 00:00:00"), ("b", "2026-01-01 10:00:00", "2026-01-01 00:00:00")],
                               "g string, ts string, mtime string")
    rows = {r.g: r for r in business.evaluate_freshness(
        df, reference_ts="2026-01-02 12:00:00", timestamp_column="ts", file_time_column="mtime",
        group_cols=["g"], thresholds={"b": (24.0, 30.0)}).collect()}
    a, b = rows["a"], rows["b"]
    assert a.timestamp_source == "filesystem" and a.lag_hours_exact == 36.0 and a.severity == "warning"
    assert b.timestamp_source == "ts" and b.lag_hours_exact == 26.0 and b.severity == "warning"


def test_freshness_future_data_has_zero_lag(spark):
    df = spark.createDataFrame([("2026-05-10T10:00:00Z",)], "file_received_ts string")
    o = business.evaluate_freshness(df, reference_ts="2026-03-03T17:42:35Z",
                                    timestamp_column="file_received_ts").first()
    assert o.passed and o.lag_hours_exact == 0.0


def test_foreign_key_distinct_sorted_orphans(spark):
    child = spark.createDataFrame([("9",), ("3",), ("3",), (None,), ("1",)], "candidate_id string")
    parent = spark.createDataFrame([("1",), (None,)], "candidate_id string")
    o = integrity.check_exam_candidate_fk(child, parent).first()
    assert not o.passed and o.severity == "critical" and o.missing_count == 2
    assert o.sample_values == ["3", "9"]
    assert o.description.endswith("Mismatched candidates found.")
    ok = integrity.check_exam_candidate_fk(parent, parent).first()
    assert ok.passed and ok.severity == "info"


def test_offender_sample_per_group(spark):
    exam = spark.createDataFrame([("b1", "A", "Pass", 3), ("b1", "B", "Pass", 1), ("b2", "C", "Fail", 2)],
                                 "bundle string, candidate_id string, pass_fail string, n int")
    cert = spark.createDataFrame([("b2", "C", "Certified", "2026-01-01")],
                                 "bundle string, candidate_id string, certification_status string, status_effective_ts string")
    keys = business.status_mapping_keys(exam, cert, order_col="n", group_cols=["bundle"])
    got = sorted((r.bundle, r.rule_id, r.sample_rank, r.candidate)
                 for r in business.offender_sample(keys, 5, group_cols=["bundle"]).collect())
    assert got == [("b1", "BR-05-pass", 1, "B"), ("b1", "BR-05-pass", 2, "A"), ("b2", "BR-05-fail", 1, "C")]
