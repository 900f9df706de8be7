"""Streaming gate: bundles landing in two waves are each gated once."""

import shutil

from tollgate.plans.gate import GateConfig
from tollgate.streaming.bundle_stream import start_gate_stream

from conftest import REFERENCE_TS


def test_stream_gates_each_arriving_bundle_once(spark, bundles_root, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out, ckpt = tmp_path / "out", tmp_path / "ckpt"
    cfg = GateConfig(data_root=str(landing), reference_ts=REFERENCE_TS)

    shutil.copytree(bundles_root / "good", landing / "good")
    q = start_gate_stream(spark, cfg, str(out), str(ckpt), available_now=True)
    q.awaitTermination(300)

    shutil.copytree(bundles_root / "future-exam-date", landing / "future-exam-date")
    q = start_gate_stream(spark, cfg, str(out), str(ckpt), available_now=True)
    q.awaitTermination(300)

    d = spark.read.parquet(str(out / "decisions"))
    got = {(r.bundle, r.status) for r in d.collect()}
    assert got == {("good", "Blocked"), ("future-exam-date", "Warning only")}
    assert d.select("batch_id").distinct().count() == 2


def test_feeds_in_any_order_late_and_never(spark, tmp_path):
    import time

    from tollgate.streaming.bundle_stream import landed_feeds, ready_bundles
    feeds = ["a.csv", "b.csv"]
    landing = tmp_path / "landing"

    def land(bundle, *files):
        (landing / bundle).mkdir(parents=True, exist_ok=True)
        for f in files:
            (landing / bundle / f).write_text("x\n1\n")

    land("first", "b.csv")
    land("both", "a.csv", "b.csv", "notes.csv")
    got = []
    ready = ready_bundles(landed_feeds(spark, str(landing), feeds), feeds, 4000)
    q = (ready.writeStream.foreachBatch(lambda df, i: got.extend((r.bundle, tuple(r.feeds), r.complete) for r in df.collect()))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(processingTime="500 milliseconds").start())
    try:
        def until(n):
            end = time.time() + 60
            while len(got) < n and time.time() < end:
                time.sleep(0.2)
            return got[:n]

        assert until(1) == [("both", ("a.csv", "b.csv"), True)]
        land("first", "a.csv")
        land("lone", "a.csv")
        out = until(3)
        assert ("first", ("a.csv", "b.csv"), True) in out or ("first", ("b.csv",), False) in out
        assert ("lone", ("a.csv",), False) in until(4)[1:]
        land("lone", "b.csv")  # late: the bundle is judged again when its wait is over
        n = len(got)
        assert ("lone", ("b.csv",), False) in until(n + 1)[n:]
    finally:
        q.stop()
