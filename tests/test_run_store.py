"""Runs are replaced as a whole and seen only when published."""

import pytest
from pyspark.sql import functions as F

from conftest import REFERENCE_TS
from tollgate.plans.gate import GateConfig, ReleaseGate
from tollgate.sources.run_store import RunStore


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "bundle string, rule_id string")


def content(store):
    return sorted(tuple(r) for r in store.read().select("run", "bundle", "rule_id").collect())


def test_a_retry_with_fewer_failures_replaces_the_run(spark, tmp_path):
    s = RunStore(spark, str(tmp_path / "log"))
    s.write(rows(spark, ("a", "R1"), ("b", "R1"), ("b", "R2")), "2026-03-01T10:00:00Z", ["bundle"])
    s.write(rows(spark, ("a", "R1")), "2026-03-02T10:00:00Z", ["bundle"])
    s.write(rows(spark, ("b", "R2")), "2026-03-01T10:00:00Z", ["bundle"])
    assert content(s) == [("2026-03-01T10:00:00Z", "b", "R2"), ("2026-03-02T10:00:00Z", "a", "R1")]
    s.write(rows(spark).limit(0), "2026-03-02T10:00:00Z", ["bundle"])
    assert content(s) == [("2026-03-01T10:00:00Z", "b", "R2")]
    assert {r.run for r in s.runs().collect()} == {"2026-03-01T10:00:00Z", "2026-03-02T10:00:00Z"}


def test_a_crash_before_the_marker_is_unseen_and_removed(spark, tmp_path):
    s = RunStore(spark, str(tmp_path / "log"))
    s.write(rows(spark, ("a", "R1")), "r/1 ü")
    s.stage(rows(spark, ("a", "R1"), ("a", "R9")), "r/1 ü")
    s.stage(rows(spark, ("z", "R9")), "never")
    assert content(s) == [("r/1 ü", "a", "R1")]
    s.write(rows(spark, ("a", "R2")), "r/1 ü")
    assert s.vacuum() == 3 and content(s) == [("r/1 ü", "a", "R2")] and s.vacuum() == 0


def test_an_open_reader_keeps_the_attempt_it_listed(spark, tmp_path):
    s = RunStore(spark, str(tmp_path / "log"))
    s.write(rows(spark, ("a", "R1")), "r")
    before = s.read()
    s.write(rows(spark, ("a", "R2")), "r")
    assert [r.rule_id for r in before.collect()] == ["R1"] and content(s) == [("r", "a", "R2")]


def test_nothing_published(spark, tmp_path):
    s = RunStore(spark, str(tmp_path / "log"))
    assert s.runs().collect() == []
    with pytest.raises(FileNotFoundError):
        s.read()
    assert s.read(rows(spark).schema).columns == ["bundle", "rule_id", "run"]
    with pytest.raises(ValueError):
        s.stage(rows(spark).withColumn("run", F.lit("x")), "r")


def test_gate_outcomes_are_stored_and_queried(spark, bundles_root, tmp_path):
    s = RunStore(spark, str(tmp_path / "history"))
    with ReleaseGate(spark, GateConfig(data_root=str(bundles_root), bundles=("good", "invalid-score"), reference_ts=REFERENCE_TS)) as gate:
        gate.run()
        gate.store(s, "night-1")
        gate.store(s, "night-1")
    got = s.read().where("NOT passed AND rule_id LIKE 'BR-04%'").select("run", "bundle").distinct().collect()
    assert [tuple(r) for r in got] == [("night-1", "invalid-score")]
