"""Helpers shared by the operators: tables, written intermediates, runs, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import checkpoint_dir, remove_at_end

SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one operator run, in the shared checkpoint folder.

    ``keep`` writes a frame once as Parquet and reads it back, so that a lost
    executor costs a re-read, never the lineage before it. ``drop`` removes
    what later steps do not read; what a returned frame still reads goes when
    the session's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/tollgate-llm/{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        if not self.count:
            remove_at_end(self.spark, self.base)
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for f in frames:
            if "_scratch_path" in f.__dict__:
                path = jvm.org.apache.hadoop.fs.Path(f._scratch_path)
                path.getFileSystem(conf).delete(path, True)


ROW_KEY = "__row_key"


def row_keys(scratch: Scratch, documents: DataFrame) -> DataFrame:
    """``documents`` with ROW_KEY: one long for each (doc_id, text), so that ids may repeat or be null.

    An id that stands for one text is its own key, so keys keep the order of
    ids. Rows of an id with several texts, and rows without an id, get a hash of
    id and text from 2**62 on, behind all ids (ids stay below 2**62). Finding
    the repeated ids shuffles two numbers a row, never a text; the join is
    planned by the written size of their list.
    """
    repeated = scratch.keep(documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("h"))
                            .distinct().groupBy("__id").agg(F.count("*").alias("n")).where("n > 1").select("__id"))
    behind = F.lit(1 << 62).cast("long") + F.xxhash64(F.col("doc_id").cast("long"), "text").bitwiseAND(F.lit((1 << 62) - 1).cast("long"))
    one = F.col("doc_id").isNotNull() & F.col("__id").isNull()
    return (documents.join(repeated, F.col("doc_id").cast("long") == F.col("__id"), "left")
            .withColumn(ROW_KEY, F.when(one, F.col("doc_id").cast("long")).otherwise(behind)).drop("__id"))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes a piece (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Regroup key-sorted batches into tables that hold whole runs of ``keys``."""
    held: list[pa.RecordBatch] = []
    held_rows = 0

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        held_rows += batch.num_rows
        if held_rows < rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        first = run_starts(t, keys)
        cut = int(first[-1])
        if cut == 0:
            continue
        yield t.slice(0, cut)
        rest = t.slice(cut).combine_chunks()
        held, held_rows = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new run of equal ``keys`` begins (integer keys)."""
    new = np.zeros(t.num_rows, bool)
    if t.num_rows:
        new[0] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def connected_components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component: its smallest node.

    Contraction: in a round every node points at the least of its neighbours
    and itself, edges are renamed by the pointers, and loops and repeats go.
    Rounds order nodes by id and by a fresh hash in turn: ids end stars (what
    the operators emit) in a round, random orders shrink any graph, long paths
    included, by a constant factor in expectation, so rounds grow with the
    logarithm of the node count. Pointers of each round are written; edges and
    pointers meet in joins whose sides are both plain exchanges, so a hub's
    edges can be split by the adaptive skew join. No node's neighbours are
    collected.
    """
    spark = scratch.spark
    e = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    levels = []
    while not e.isEmpty():
        h = (lambda c: F.xxhash64(F.lit(len(levels)), F.col(c))) if len(levels) % 2 else F.col  # noqa: E731,B023
        best = (e.select("a", F.struct(h("b").alias("h"), F.col("b").alias("n")).alias("x"))
                .unionAll(e.select(F.col("b").alias("a"), F.struct(h("a").alias("h"), F.col("a").alias("n")).alias("x")))
                .groupBy("a").agg(F.min("x").alias("x"))
                .select(F.col("a").alias("u"), F.when(h("a") < F.col("x.h"), F.col("a")).otherwise(F.col("x.n")).alias("p")))
        level = scratch.keep(best)
        levels.append(level)
        pa_ = level.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        pb_ = level.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        renamed = (e.join(pa_, "a").select("b", "pa").join(pb_, "b").where("pa <> pb")
                   .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        old, e = e, scratch.keep(renamed)
        scratch.drop(old)
    if not levels:
        return spark.createDataFrame([], "node long, component long")
    root = levels[-1].select("u", F.col("p").alias("root"))
    for level in reversed(levels[:-1]):
        up = root.select(F.col("u").alias("p"), "root")
        root = level.join(up, "p", "left").select("u", F.coalesce("root", "p").alias("root"))
    root = scratch.keep(root.select(F.col("u").alias("node"), "root"))
    least = scratch.keep(root.groupBy("root").agg(F.min("node").alias("component")))
    out = scratch.keep(root.join(least, "root").select("node", "component"))
    scratch.drop(*levels, root, least)
    return out
