"""Sources and sinks on copies of the fixture bundles."""

import pytest
from pyspark.sql import functions as F

from tollgate.sources import csv_feeds, files, sinks


def test_headers_per_file(spark, bundles_root):
    h = csv_feeds.read_headers(spark, [str(bundles_root / "*" / "exam_results.csv")])
    rows = {r.bundle: r.columns for r in h.collect()}
    assert len(rows) == 12 and "score" not in rows["missing-required-column"]
    assert rows["good"][0] == "exam_result_id"


def test_na_tokens_become_null(spark, tmp_path):
    d = tmp_path / "b1"
    d.mkdir()
    (d / "feed.csv").write_text("a,b\nNA,1\nnull,\nx,N/A\n")
    df = csv_feeds.read_feed(spark, [str(tmp_path / "*" / "feed.csv")])
    got = [(r.a, r.b) for r in df.orderBy(F.col("_row_order")).collect()]
    assert got == [(None, "1"), (None, None), ("x", None)]


def test_presence_check_lists_all_missing(spark, bundles_root):
    with pytest.raises(FileNotFoundError) as e:
        files.require_feed_files(spark, str(bundles_root), ["candidates.csv", "disciplinary_flags.csv"])
    assert "good/disciplinary_flags.csv" in str(e.value)
    assert "(+" in str(e.value) or str(e.value).count("disciplinary_flags.csv") == 11
    files.require_feed_files(spark, str(bundles_root), ["candidates.csv", "exam_results.csv"])
    pres = files.presence_outcomes(spark, str(bundles_root), ["disciplinary_flags.csv"])
    failed = pres.where(~F.col("passed")).count()
    assert failed == 11 and pres.first().rule_id == "disciplinary_flags-schema-file-present"


def test_file_metadata_and_defect_log(spark, bundles_root, tmp_path):
    raw = csv_feeds.read_feed(spark, [str(bundles_root / "*" / "candidates.csv")])
    meta = {r.bundle: r for r in files.file_metadata(
        raw, {"file_received_ts": "2026-03-01T00:00:00Z", "ignored": None}).collect()}
    good = meta["good"]
    assert meta["duplicate-candidate-id"].row_count == 2 and good.modified_at is not None
    assert good.file_size > 0 and good.source_path.endswith("good/candidates.csv")
    assert good.file_received_ts == "2026-03-01T00:00:00Z" and "ignored" not in good.asDict()
    outcomes = spark.createDataFrame([("b1", "BR-08", "stale", False, "critical"),
                                      ("b1", "BR-07", "ok", True, "info")],
                                     "bundle string, rule_id string, description string, passed boolean, severity string")
    log = str(tmp_path / "defects")
    sinks.append_defect_log(outcomes, log, "2026-03-03T17:42:35Z")
    again = sinks.append_defect_log(outcomes, log, "2026-03-03T17:42:35Z")
    sinks.append_defect_log(outcomes, log, "2026-03-04T17:42:35Z")
    back = spark.read.parquet(log)
    assert back.count() == 2 and back.first().status == "open" and again.count() == 1
    results = spark.createDataFrame([("s", "e1"), ("s", "e2")], "suite string, expectation_type string")
    for _ in range(2):
        sinks.store_results(results, str(tmp_path / "results"), "run-1")
    sinks.store_results(results.limit(1), str(tmp_path / "results"), "run-2")
    assert spark.read.parquet(str(tmp_path / "results")).count() == 3


def _csv(tmp_path, bundle, text):
    (tmp_path / bundle).mkdir(parents=True, exist_ok=True)
    (tmp_path / bundle / "feed.csv").write_text(text)


def test_quotes_and_line_breaks(spark, tmp_path):
    _csv(tmp_path, "b1", 'a,"b,x",c\n1,"say ""hi"", ok",3\n2,"two\nlines",4\n')
    got = [tuple(r) for r in csv_feeds.read_feed(spark, [str(tmp_path / "*" / "feed.csv")]).orderBy("_row_order").select("a", "`b,x`", "c").collect()]
    assert got == [("1", 'say "hi", ok', "3"), ("2", "two\nlines", "4")]


def test_surplus_fields_are_kept_apart(spark, tmp_path):
    _csv(tmp_path, "b1", "a,b,c\n1,2,3\n5,6,7,8\n9,10\n")
    got = [(r.a, r.c, r["_surplus"]) for r in csv_feeds.read_feed(spark, [str(tmp_path / "*" / "feed.csv")]).orderBy("_row_order").collect()]
    assert got == [("1", "3", None), ("5", "7", "8"), ("9", None, None)]


def test_unclosed_quotes_are_counted(spark, tmp_path):
    _csv(tmp_path, "b1", 'a,b\n1,"two\nlines"\n')
    assert [tuple(r) for r in csv_feeds.unclosed_quotes(spark, [str(tmp_path / "*" / "feed.csv")]).collect()] == [("b1", 2)]


def test_folder_names_with_spaces_and_plus(spark, tmp_path):
    for b in ("my bundle", "a+b", "50% é"):
        _csv(tmp_path, b, "a\n1\n")
    df = csv_feeds.read_feed(spark, [str(tmp_path / "*" / "feed.csv")])
    assert {r.bundle for r in df.collect()} == {"my bundle", "a+b", "50% é"}


def test_header_pass_takes_one_task_per_file(spark, tmp_path):
    for i in range(3):
        _csv(tmp_path, f"b{i}", "a,b\n" + "1,2\n" * 400_000)
    with csv_feeds.whole_files(spark):
        assert spark.read.text(str(tmp_path / "*" / "feed.csv")).rdd.getNumPartitions() == 3
    h = csv_feeds.read_headers(spark, [str(tmp_path / "*" / "feed.csv")])
    assert [r.columns for r in h.collect()] == [["a", "b"]] * 3


def test_bundle_lists_fold_into_brace_globs(spark, bundles_root):
    names = ["good", "invalid-score", "future-exam-date"]
    globs = csv_feeds.feed_glob(str(bundles_root), "exam_results.csv", names)
    assert len(globs) == 1 and "{good,invalid-score,future-exam-date}" in globs[0]
    raw = csv_feeds.read_feed(spark, globs)
    assert {r.bundle for r in raw.select("bundle").distinct().collect()} == set(names)
