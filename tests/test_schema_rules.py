"""Unit: schema operators on literal frames."""

from pyspark.sql import functions as F

from tollgate.operators import duplicates, schema
from tollgate.outcome import to_outcomes


def test_required_columns_failure_reports_missing_entries(spark):
    df = spark.createDataFrame([("1", "foo@example.com")], "candidate_id string, email string")
    o = schema.check_required_columns(df, ["candidate_id", "first_name", "last_name"],
                                      "schema-missing-columns").first()
    assert not o.passed and o.severity == "critical"
    assert o.details["missing_columns"] == '["first_name", "last_name"]'


def test_detect_duplicates_counts_every_member(spark):
    df = spark.createDataFrame([("a", 90), ("a", 95), ("b", 88)], "candidate_id string, score bigint")
    o = duplicates.detect_duplicates(df, ["candidate_id"], "schema-duplicate-report").first()
    assert not o.passed and o.duplicate_count == 2 and o.subset == ["candidate_id"]


def test_duplicates_null_keys_are_equal_and_three_copies_count_three(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",), ("x",), ("x",)], "k string")
    o = duplicates.detect_duplicates(df, ["k"], "r").first()
    assert o.duplicate_count == 5 and o.duplicate_groups == 2


def test_duplicates_per_group(spark):
    df = spark.createDataFrame([("b1", 1), ("b1", 1), ("b2", 1)], "bundle string, k int")
    rows = {r.bundle: r for r in duplicates.detect_duplicates(df, ["k"], "r", group_cols=["bundle"]).collect()}
    assert rows["b1"].duplicate_count == 2 and rows["b2"].passed


def test_duplicate_rows_joins_back_group_size(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    got = sorted((r.k, r.v, r.dup_count) for r in duplicates.duplicate_rows(df, ["k"]).collect())
    assert got == [(1, "a", 2), (1, "b", 2)]


def test_dtype_audit_emits_issue_for_bad_values(spark):
    df = spark.createDataFrame([("100",), ("bad",)], "score string")
    issues = schema.dtype_audit(df, {"score": "float64"}, "schema-dtype", emit_passed=False).collect()
    assert len(issues) == 1
    i = issues[0]
    assert i.rule_id == "schema-dtype-score" and not i.passed
    assert "Could not coerce" in i.description and i.failed_count == 1


def test_normalize_keeps_failing_column_raw(spark):
    df = spark.createDataFrame([("100", "2026-01-01"), ("bad", "nope")], "score string, d string")
    norm, issues = schema.normalize_dataframe_dtypes(
        df, {"score": "float64", "d": "datetime64[ns]"}, "p", keep_raw_on_failure=True)
    types = dict(norm.dtypes)
    assert types["score"] == "string"          # non-date column with a failure stays raw
    assert types["d"] == "timestamp"           # date column always coerces, bad -> null
    assert [r.d is None for r in norm.collect()] == [False, True]
    assert sorted(r.column for r in issues.collect()) == ["d", "score"]


def test_numeric_guards_follow_pandas(spark):
    # float64: "1d"/"3f" are Spark-only literals, NaN counts as missing;
    # infinities and scientific notation parse, as in pandas.
    df = spark.createDataFrame([("1d",), ("3f",), ("NaN",), ("Infinity",), ("-inf",), ("1e3",), (" 7 ",)], "v string")
    assert schema.dtype_audit(df, {"v": "float64"}, "p").first().failed_count == 3
    # Int64: whole numbers only ("1.0", "1e3", "1.5" fail), signs and spaces allowed.
    ints = spark.createDataFrame([("1",), (" 1",), ("-3",), ("+4",), ("1.0",), ("1e3",), ("1.5",)], "v string")
    assert schema.dtype_audit(ints, {"v": "Int64"}, "p").first().failed_count == 3


def test_timestamp_guard_rejects_partial_dates(spark):
    df = spark.createDataFrame([("2026",), ("2026-01",), ("10:00",), ("2026-01-25T10:15:00Z",)], "v string")
    out = schema.dtype_audit(df, {"v": "datetime64[ns]"}, "p").first()
    assert out.failed_count == 3


def test_required_and_ordered_columns_by_file(spark):
    h = spark.createDataFrame([("b1", ["a", "b", "c"]), ("b2", ["a", "c"]), ("b3", ["b", "a", "c"])],
                              "bundle string, columns array<string>")
    req = {r.bundle: r for r in schema.required_columns_by_file(h, ["a", "b", "c"], "r").collect()}
    assert req["b1"].passed and req["b2"].missing_columns == ["b"] and req["b3"].passed
    ordered = {r.bundle: r for r in schema.ordered_columns_by_file(h, ["a", "b", "c"], "o").collect()}
    assert ordered["b1"].passed and not ordered["b3"].passed
    assert ordered["b3"].mismatched_positions == [1, 2]
    assert ordered["b2"].mismatched_positions == [2, 3]


def test_apply_schema_definition_missing_key_column_fails_instead_of_raising(spark):
    d = schema.get_schema_definition("exam_results")
    df = spark.createDataFrame([("ER-1", "1")], "exam_result_id string, candidate_id string")
    _norm, outs = schema.apply_schema_definition(df, d)
    rows = {r.rule_id: r for o in outs for r in o.collect()}
    assert not rows["exam_results-required-columns"].passed
    assert rows["exam_results-uniqueness-unique-1"].passed
    assert not rows["exam_results-uniqueness-unique-2"].passed


def test_unknown_schema_name_raises_key_error():
    import pytest
    with pytest.raises(KeyError):
        schema.get_schema_definition("nope")


def test_required_keys_on_json(spark):
    df = spark.createDataFrame([('{"k": 1, "v": 2}',), ('{"k": 3}',), (None,)], "props string")
    r = schema.required_keys(df.select(F.json_object_keys("props").alias("keys")), "keys", ["k", "v"], "rk")
    got = {x.required_key: x.missing_rows for x in r.collect()}
    assert got == {"k": 1, "v": 2}


def test_to_outcomes_packs_metrics(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    o = to_outcomes(duplicates.detect_duplicates(df, ["k"], "r")).first()
    assert o.details == {"subset": '["k"]', "duplicate_count": "2", "duplicate_groups": "1"}


def test_ordered_columns_on_a_dataframe_and_declared_struct(spark):
    df = spark.createDataFrame([("1", "a")], "candidate_id string, email string")
    ok = schema.check_ordered_columns(df, ["candidate_id", "email"], "o").first()
    bad = schema.check_ordered_columns(df, ["email", "candidate_id"], "o").first()
    assert ok.passed and not bad.passed and "mismatched" in bad.details
    st = schema.typed_struct(schema.get_schema_definition("exam_results"))
    types = {f.name: f.dataType.simpleString() for f in st.fields}
    assert types["exam_date"] == "timestamp" and types["attempt_number"] == "bigint"
    assert types["score"] == "double" and list(types)[0] == "exam_result_id"
