"""Unit: expectation suites, parameters, partial lists, checkpoint and store."""

from pyspark.sql import functions as F

from tollgate.operators import expectations as ex
from tollgate.sources import sinks


def _frame(spark):
    return spark.createDataFrame(
        [("a", 1, "P", 5.0), ("a", 2, "X", 150.0), (None, None, None, None), ("b", 2, "Y", 50.0),
         ("c", 3, "Y", -1.0)],
        "id string, n int, code string, score double")


def test_fused_suite_metrics(spark):
    df = _frame(spark)
    suite = [ex.not_null("id"), ex.unique("id"), ex.compound_unique(["id", "n"]),
             ex.between("score", 0, 100), ex.in_set("code", ["P", "F"])]
    rows = {r.expectation_index: r for r in ex.run_suite(df, "s", suite).collect()}
    nn, un, cu, bt, st = (rows[i] for i in range(5))
    assert nn.unexpected_count == 1 and nn.unexpected_percent == 20.0 and nn.missing_count is None
    assert un.unexpected_count == 2 and un.missing_count == 1 and un.unexpected_percent == 50.0
    assert cu.unexpected_count == 0 and cu.missing_count == 1 and cu.success
    assert bt.unexpected_count == 2 and bt.missing_count == 1 and not bt.success
    assert st.unexpected_count == 3 and st.unexpected_percent == 75.0


def test_mostly_and_parameters(spark):
    df = _frame(spark)
    bounds = spark.createDataFrame([(-5.0,), (200.0,)], "v double")
    params = {"lo": ex.parameter(bounds, F.min("v")), "hi": ex.parameter(bounds, F.max("v"))}
    r = ex.run_suite(df, "s", [ex.between("score", ex.Param("lo"), ex.Param("hi")),
                               ex.in_set("code", ["P", "X", "Y"], mostly=0.5)], params).collect()
    assert all(x.success for x in r)


def test_null_parameter_fails_instead_of_raising(spark):
    df = _frame(spark)
    empty = spark.createDataFrame([], "v double")
    r = ex.run_suite(df, "s", [ex.between("score", ex.Param("lo"), None)],
                     {"lo": ex.parameter(empty, F.min("v"))}).first()
    assert not r.success and not r.bounds_resolved


def test_partial_unexpected_top_values(spark):
    df = _frame(spark)
    r = ex.run_suite(df, "s", [ex.in_set("code", ["P"])], partial_lists=True).first()
    assert [(x.value, x["count"]) for x in r.partial_unexpected_counts] == [("Y", 2), ("X", 1)]


def test_suite_config_entry_and_statistics(spark, tmp_path):
    cfg = {"expectation_type": "expect_column_values_to_be_between",
           "kwargs": {"column": "n", "min_value": "$PARAMETER.lo", "max_value": 2}}
    e = ex.from_config(cfg)
    assert e.min_value == ex.Param("lo")
    df = _frame(spark)
    res = ex.run_checkpoint([("batch1", df, "s1", [e, ex.ordered_columns(["id", "n", "code", "score"])]),
                             ("batch2", df, "s2", [ex.not_null("id")])],
                            {"lo": F.lit(1)}, run_name="r1")
    stats = {r.suite: r for r in ex.suite_statistics(res).collect()}
    assert stats["s1"].evaluated_expectations == 2 and stats["s1"].successful_expectations == 1
    assert stats["s1"].success_percent == 50.0 and not stats["s2"].success
    sinks.store_results(res, str(tmp_path / "store"))
    back = spark.read.parquet(str(tmp_path / "store"))
    assert back.select("suite", "run_name").distinct().count() == 2


def test_expectation_outcomes(spark):
    res = ex.run_suite(_frame(spark), "s", [ex.not_null("id")])
    o = ex.expectation_outcomes(res).first()
    assert o.rule_id == "s-expect_column_values_to_not_be_null-id" and not o.passed


def test_grouped_suite_with_partial_lists(spark):
    df = spark.createDataFrame([("b1", "X"), ("b1", "X"), ("b1", "P"), ("b2", "Y"), ("b2", None)],
                               "bundle string, code string")
    rows = {r.bundle: r for r in ex.run_suite(df, "s", [ex.in_set("code", ["P"])], group_cols=["bundle"],
                                              partial_lists=True).collect()}
    assert rows["b1"].unexpected_count == 2 and rows["b2"].missing_count == 1
    assert [(x.value, x["count"]) for x in rows["b1"].partial_unexpected_counts] == [("X", 2)]
    assert [(x.value, x["count"]) for x in rows["b2"].partial_unexpected_counts] == [("Y", 1)]


def test_uniqueness_lists_repeated_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, None), (None, None)], "k string, n int")
    rows = {r.expectation_type: r for r in ex.run_suite(df, "s", [ex.unique("k"), ex.compound_unique(["k", "n"])], partial_lists=True).collect()}
    assert [(x.value, x["count"]) for x in rows["expect_column_values_to_be_unique"].partial_unexpected_counts] == [("a", 3)]
    assert [(x.value, x["count"]) for x in rows["expect_compound_columns_to_be_unique"].partial_unexpected_counts] == [('{"k":"a","n":1}', 2)]
