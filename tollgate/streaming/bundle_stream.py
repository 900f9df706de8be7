"""Continuous gating of bundles as their feed files land.

A Structured Streaming file source watches ``<landing>/*/<trigger_file>``
(one folder per delivered bundle). Each micro-batch names the bundles whose
trigger file arrived; ``foreachBatch`` runs the release gate for exactly
those bundles (batch reads of their feeds) and writes outcomes and
decisions under ``<output>/<kind>/batch_id=<id>``. Overwriting the batch's
own folder makes a retried micro-batch idempotent, and the streaming
checkpoint records which files were already processed, so a restarted job
(or a lost executor) neither skips nor duplicates a bundle.

``start_arrival_stream`` needs no file to come last: it keeps per bundle which
feeds have come (keyed state, one small row a waiting bundle) and gates the
bundle when all are there, in whatever order, or when none has come for
``wait``; a feed that comes after that opens the bundle again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.gate import GateConfig, ReleaseGate
from ..sources.csv_feeds import BUNDLE_COL, bundle_of, plain_path


def arrived_bundles(spark: SparkSession, landing_root: str, trigger_file: str = "exam_results.csv",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of (bundle, file_path) for each newly landed trigger file."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(f"{landing_root.rstrip('/')}/*/{trigger_file}")
    return (lines.select(F.col("_metadata.file_path").alias("file_path"))
            .select(bundle_of(F.col("file_path")).alias(BUNDLE_COL), "file_path"))


def gate_batch(config: GateConfig, output_root: str):
    """foreachBatch function: gate the bundles of one micro-batch."""
    out = output_root.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        # Only bundle names reach the driver: one row per delivered bundle.
        names = sorted({r[BUNDLE_COL] for r in batch.select(BUNDLE_COL).distinct().collect()})
        if not names:
            return
        spark = batch.sparkSession
        tag = F.lit(batch_id).cast("long")
        with ReleaseGate(spark, replace(config, bundles=tuple(names))) as gate:
            rep = gate.run()
            rep.outcomes.withColumn("batch_id", tag).write.mode("overwrite").parquet(
                f"{out}/outcomes/batch_id={batch_id}")
            rep.release_decision().withColumn("batch_id", tag).write.mode("overwrite").parquet(
                f"{out}/decisions/batch_id={batch_id}")

    return run


def start_gate_stream(spark: SparkSession, config: GateConfig, output_root: str,
                      checkpoint_location: str, trigger_file: str = "exam_results.csv",
                      available_now: bool = False, processing_time: str | None = None,
                      max_files_per_trigger: int | None = 1000):
    """Start the streaming gate; returns the StreamingQuery.

    ``max_files_per_trigger`` bounds the bundles of one micro-batch (their
    names are the only rows the driver receives).
    """
    stream = arrived_bundles(spark, config.data_root, trigger_file, max_files_per_trigger)
    w = (stream.writeStream.foreachBatch(gate_batch(config, output_root))
         .option("checkpointLocation", checkpoint_location))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def landed_feeds(spark: SparkSession, landing_root: str, feed_files: Sequence[str],
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of (bundle, feed) for each newly landed feed file; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    path = plain_path(F.col("path"))
    files = reader.load(f"{landing_root.rstrip('/')}/*/*").select(bundle_of(path).alias(BUNDLE_COL), F.element_at(F.split(path, "/"), -1).alias("feed"))
    return files.where(F.col("feed").isin(list(feed_files)))


def ready_bundles(landed: DataFrame, feed_files: Sequence[str], wait_ms: int) -> DataFrame:
    """Streaming frame of (bundle, feeds, complete): bundles whose feeds have all come, or for which time ran out.

    The state of a bundle is the list of its feeds so far; it is dropped when
    the bundle is handed on. Time runs from the last feed that came.
    """
    expected = sorted(set(feed_files))

    def arrive(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        have = set(state.get[0]) if state.exists else set()
        if not state.hasTimedOut:
            for pdf in batches:
                have |= set(pdf["feed"])
            if not have.issuperset(expected):
                state.update((sorted(have),))
                state.setTimeoutDuration(wait_ms)
                return
        if state.exists:
            state.remove()
        yield pd.DataFrame({BUNDLE_COL: [key[0]], "feeds": [sorted(have)], "complete": [have.issuperset(expected)]})

    return landed.groupBy(BUNDLE_COL).applyInPandasWithState(
        arrive, f"{BUNDLE_COL} string, feeds array<string>, complete boolean", "feeds array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout)


def start_arrival_stream(spark: SparkSession, config: GateConfig, output_root: str, checkpoint_location: str,
                         wait_seconds: float = 3600, processing_time: str = "1 minute",
                         max_files_per_trigger: int | None = 1000):
    """Gate each bundle once its declared feeds are there, or ``wait_seconds`` after the last one that came."""
    feeds = [d.file_name for d in config.rules.schemas()]
    ready = ready_bundles(landed_feeds(spark, config.data_root, feeds, max_files_per_trigger), feeds, int(wait_seconds * 1000))
    return (ready.writeStream.foreachBatch(gate_batch(config, output_root)).option("checkpointLocation", checkpoint_location)
            .trigger(processingTime=processing_time).start())
