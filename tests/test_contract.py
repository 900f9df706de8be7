"""Contract operators, checked against brute force on small fixtures."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tollgate.operators import contract, integrity


def _intervals(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot key with a third of all rows, plus many cold keys
        k = 0 if i % 3 == 0 else rnd.randint(1, 200)
        s = rnd.randint(0, 400 * 86400)
        e = None if rnd.random() < 0.05 else s + rnd.randint(0, 20 * 86400)
        rows.append((k, i, s, e))
    df = spark.createDataFrame(rows, "k int, id int, s long, e long")
    return df.select("k", "id", F.timestamp_seconds("s").alias("start"),
                     F.timestamp_seconds("e").alias("end"))


def test_bucketed_overlap_equals_per_key_window(spark):
    df = _intervals(spark)
    got = contract.interval_overlaps(df, ["k"], "start", "end", ["id"], num_chunks=16)
    w = Window.partitionBy("k").orderBy("start", "id").rowsBetween(Window.unboundedPreceding, -1)
    brute = df.withColumn("p", F.max("end").over(w)).select(
        "id", F.coalesce(F.col("start") < F.col("p"), F.lit(False)).alias("o"))
    a = {r.id: r.overlaps for r in got.collect()}
    b = {r.id: r.o for r in brute.collect()}
    assert a == b and sum(a.values()) > 0
    o = contract.check_overlapping_intervals(df, ["k"], "start", "end", ["id"], num_chunks=7).first()
    assert o.overlap_count == sum(b.values()) and not o.passed


def test_overlap_hot_key_in_one_day_is_split_across_chunks(spark):
    rnd = random.Random(3)
    rows = [(0 if i % 3 else rnd.randint(1, 50), i, rnd.randint(0, 80000), rnd.randint(0, 5000))
            for i in range(6000)]          # two thirds of all rows: key 0, all within one day
    df = spark.createDataFrame(rows, "k int, id int, s long, d long").select(
        "k", "id", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds(F.col("s") + F.col("d")).alias("end"))
    got = contract.interval_overlaps(df, ["k"], "start", "end", ["id"], num_chunks=12)
    chunks = got.where("k = 0").count()
    w = Window.partitionBy("k").orderBy("start", "id").rowsBetween(Window.unboundedPreceding, -1)
    brute = df.withColumn("p", F.max("end").over(w)).select(
        "id", F.coalesce(F.col("start") < F.col("p"), F.lit(False)).alias("o"))
    assert {r.id: r.overlaps for r in got.collect()} == {r.id: r.o for r in brute.collect()}
    assert chunks == 4000
    spread = (df.where("k = 0").repartitionByRange(12, "k", "start", "id")
              .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(spread) > 6                 # the hot key really spans many chunks


def test_late_master_and_arrival_lag(spark):
    fact = spark.createDataFrame([("1", "2026-01-10"), ("2", "2026-01-10"), ("3", "2026-01-10")],
                                 "candidate_id string, exam_date string")
    master = spark.createDataFrame([("1", "2026-01-01T00:00:00Z"), ("2", "2026-01-11T00:00:00Z")],
                                   "candidate_id string, created_ts string")
    o = contract.check_late_master(fact, master, key="candidate_id", fact_time="exam_date",
                                   master_time="created_ts").first()
    assert o.late_count == 1 and o.matched_rows == 2 and o.severity == "warning"
    ex = spark.createDataFrame([("2026-01-01", "2026-01-01T23:00:00Z"), ("2026-01-01", "2026-01-02T01:00:00Z")],
                               "exam_date string, file_received_ts string")
    a = contract.check_arrival_lag(ex, received_col="file_received_ts", event_col="exam_date").first()
    assert a.late_rows == 1 and not a.passed


def test_quarantine_split_and_violations(spark):
    df = spark.createDataFrame([("ER-1", "94"), ("ER-2", None), ("ER-3", "x")], "id string, score string")
    good, bad = contract.split_quarantine(df, contract.score_quarantine_rules(["score"]))
    assert [r.id for r in good.collect()] == ["ER-1"]
    assert sorted((r.id, tuple(r.violations)) for r in bad.collect()) == [
        ("ER-2", ("score_invalid",)), ("ER-3", ("score_invalid",))]


def test_optional_metadata_value_sets_and_latest_per_level(spark):
    cert = spark.createDataFrame(
        [("CS-1", "1", "Associate", "2026-01-01", "lms"), ("CS-2", "1", "Associate", "2026-02-01", None),
         ("CS-3", "1", "Guru", "2026-01-01", "lms")],
        "cert_status_id string, candidate_id string, certification_level string, status_effective_ts string, status_source string")
    m = {r.column: r for r in contract.check_optional_metadata(cert, ["status_source", "file_received_ts"]).collect()}
    assert m["status_source"].non_null_count == 2 and not m["status_source"].passed
    assert m["status_source"].severity == "info" and not m["file_received_ts"].present
    lv = contract.check_certification_level(cert).first()
    assert lv.unexpected_count == 1
    latest = contract.keep_latest_per_level(cert).collect()
    assert sorted(r.cert_status_id for r in latest) == ["CS-2", "CS-3"]


def test_latest_per_key_hot_key(spark):
    rows = [(0 if i % 3 == 0 else i, i, None if i == 9 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, id int, ts int")
    got = {r.k: r.id for r in integrity.latest_per_key(df, ["k"], "ts", ["id"]).collect()}
    assert got[0] == 9          # the null timestamp wins inside the hot key
    assert len(got) == 201


def test_without_fact_is_info(spark):
    cert = spark.createDataFrame([("1",), ("2",)], "candidate_id string")
    exam = spark.createDataFrame([("1",)], "candidate_id string")
    o = contract.check_without_fact(cert, exam, "candidate_id").first()
    assert o.missing_count == 1 and o.severity == "info" and not o.passed


def test_write_quarantine_single_pass(spark, tmp_path):
    df = spark.createDataFrame([("ER-1", "94"), ("ER-2", None)], "id string, score string")
    out = str(tmp_path / "q")
    contract.write_quarantine(df, contract.score_quarantine_rules(["score"]), out)
    back = spark.read.parquet(out).withColumn("quarantined", F.col("quarantined").cast("boolean"))
    got = {r.id: r.quarantined for r in back.collect()}
    assert got == {"ER-1": False, "ER-2": True}


def test_grouped_fk_reports_passing_groups(spark):
    child = spark.createDataFrame([("b1", "1"), ("b1", "2"), ("b2", "1"), ("b3", None)],
                                  "bundle string, candidate_id string")
    parent = spark.createDataFrame([("b1", "1"), ("b2", "1")], "bundle string, candidate_id string")
    rows = {r.bundle: r for r in integrity.check_exam_candidate_fk(child, parent, group_cols=["bundle"]).collect()}
    assert rows["b1"].sample_values == ["2"] and rows["b2"].passed and rows["b3"].passed


def test_per_feed_freshness_limits(spark):
    cand = spark.createDataFrame([("2026-03-01T00:00:00Z",)], "created_ts string")
    exam = spark.createDataFrame([("2026-03-01T00:00:00Z",)], "file_received_ts string")
    ref = "2026-03-03T12:00:00Z"                      # 60 h after both
    rows = {r.feed: r for r in contract.feed_freshness(
        {"candidates": (cand, "created_ts"), "exam_results": (exam, "file_received_ts")},
        reference_ts=ref).collect()}
    assert rows["candidates"].severity == "warning"      # limits 24 / 72 h
    assert rows["exam_results"].severity == "critical"   # limits 24 / 48 h
    assert rows["candidates"].rule_id == "BR-08-candidates"


def test_overlaps_do_not_depend_on_exchange_reuse(spark):
    import random

    from pyspark.sql import functions as F
    rng = random.Random(7)
    rows = [("g%d" % (i % 2), "hot" if rng.random() < 0.6 else "k%d" % rng.randrange(40), i, t, t + rng.randrange(1, 40)) for i in range(3000) for t in [rng.randrange(100_000)]]
    df = (spark.createDataFrame(rows, "grp string, k string, id long, s long, e long")
          .select("grp", "k", "id", F.timestamp_seconds("s").alias("s"), F.timestamp_seconds("e").alias("e")))
    want = {}
    for g in ("g0", "g1"):
        n = 0
        for key in {r[1] for r in rows}:
            end = None
            for _, _, _, s, e in sorted((r for r in rows if r[0] == g and r[1] == key), key=lambda r: (r[3], r[2])):
                n += end is not None and s < end
                end = e if end is None else max(end, e)
        want[g] = n
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r.grp: r.overlap_count for r in contract.check_overlapping_intervals(df, ["k"], "s", "e", ["id"], group_cols=["grp"]).collect()}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert got == want


def test_overlap_partners_with_a_hot_key(spark):
    rnd = random.Random(11)
    rows = [("hot" if i % 3 else f"k{rnd.randint(1, 40)}", i, rnd.randint(0, 3000), None if rnd.random() < 0.05 else rnd.randint(0, 60)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, id int, s long, d long").select(
        "k", "id", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds(F.col("s") + F.col("d")).alias("end"))
    got = {r.id: r.partner.id if r.partner else None for r in contract.interval_overlaps(df, ["k"], "start", "end", ["id"], num_chunks=9).collect()}
    want, last = {}, {}
    for k, i, s, d in sorted(rows, key=lambda r: (r[2], r[1])):
        best = last.get(k)
        want[i] = best[1] if best and s < best[0] else None
        if d is not None:
            last[k] = max(best, (s + d, i)) if best else (s + d, i)
    assert got == want and sum(v is not None for v in want.values()) > 500
