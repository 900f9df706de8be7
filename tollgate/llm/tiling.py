"""Benchmark decontamination by greedy string tiling.

Texts and test items are word sequences (A-Z lower-cased). A running
Karp-Rabin sum gives the code of every window of ``MATCH`` words. A fixed-size
bitmap of the items' windows (2 MB at any benchmark size) lets a task drop
windows that no item has; the rest are joined with the items' windows on the
code. A pair with enough shared windows of the item, repeats counted, to reach
the threshold is tiled: the
longest unmarked common run of words is marked in both sequences again and
again until none of ``MATCH`` words is left, so passages in another order
count too. Coverage is the share of the item's words under tiles; a document
is contaminated if one item's coverage reaches ``THRESHOLD``.

Cases: null and empty texts and items match nothing. An item of fewer than
MATCH words is too short to be told from chance and is never counted. Items
that repeat are counted each; repeated rows of a doc_id are one document in
counts and returned each. Rows are told by id and text (``common.row_keys``),
so texts that share an id, or have none, are judged each by itself (``coverage``
itself takes ids as given and skips null ones); items with a null id are not
used. Ties: the item
with the smallest id is named. Extra columns are not read. Empty tables give
clean documents, or none.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import ROW_KEY, Scratch, row_keys, slices, table

MATCH, THRESHOLD = 5, 0.4
FILTER_BITS = 24
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)


def windows(codes: np.ndarray, bounds: np.ndarray, width: int = MATCH) -> tuple[np.ndarray, np.ndarray]:
    """(Karp-Rabin code of each window of ``width`` words, row bounds into them)."""
    n = np.maximum(np.diff(bounds) - width + 1, 0)
    out = np.concatenate(([0], np.cumsum(n)))
    first = np.repeat(bounds[:-1], n) + np.arange(out[-1]) - np.repeat(out[:-1], n)
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * tc.power_table(_BASE, len(codes))[:len(codes)])))
    return tc.mix((running[first + width] - running[first]) * tc.power_table(_INVERSE, len(codes) + 1)[first]), out


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, codes): word count and window codes in order of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            codes, bounds, _, _ = tc.words(*tc.utf8(b.column(1)))
            w, wb = windows(codes, bounds)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(bounds).astype(np.int64)),
                                              pa.array([w[wb[i]:wb[i + 1]].view(np.int64) for i in range(b.num_rows)], pa.list_(pa.int64()))], ["item_id", "n", "codes"])

    return (benchmark.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL")
            .mapInArrow(run, "item_id long, n long, codes array<long>").where("size(codes) > 0"))


def code_bitmap(codes: DataFrame) -> np.ndarray:
    """Fixed-size bitmap (2**FILTER_BITS bits) of the column ``code``; at most 512 rows of 4 KB reach the driver."""
    at = F.col("code").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1
    rows = codes.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros(((1 << FILTER_BITS) >> 15, 4096), np.uint8)
    for r in rows:
        out[r["bucket"] - 1] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(-1)


def document_windows(documents: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(doc_id, at, code) of the windows that the bitmap lets pass."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for b in slices(batches, "text"):
            codes, bounds, _, _ = tc.words(*tc.utf8(b.column(1)))
            w, wb = windows(codes, bounds)
            bit = (w & tc.U64((1 << FILTER_BITS) - 1)).astype(np.int64)
            hit = np.flatnonzero((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            row = np.searchsorted(wb, hit, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array((hit - wb[row]).astype(np.int64)), pa.array(w[hit].view(np.int64))], ["doc_id", "at", "code"])

    return documents.mapInArrow(run, "doc_id long, at long, code long")


def tiles(item: list[int], n: int, places: list[tuple[int, int]], width: int = MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in text, start in item), from the text's windows (place, code) that the item shares."""
    where = defaultdict(list)
    for i, c in enumerate(item):
        where[c].append(i)
    diagonal = defaultdict(list)
    for at, c in sorted(places):
        for i in where.get(c, ()):
            diagonal[at - i].append(at)
    heap = []
    for d, ats in diagonal.items():
        start = prev = ats[0]
        for at in [*ats[1:], None]:
            if at is None or at != prev + 1:
                heap.append((-(prev - start + width), start, start - d))
                start = at
            prev = at
    heapq.heapify(heap)
    text_marked, item_marked, out, left = set(), [False] * n, [], n
    while heap and left >= width:
        length, at, i = heapq.heappop(heap)
        length = -length
        free = [not item_marked[i + x] and at + x not in text_marked for x in range(length)]
        if all(free):
            out.append((length, at, i))
            text_marked.update(range(at, at + length))
            item_marked[i:i + length] = [True] * length
            left -= length
            continue
        run = 0
        for x in range(length + 1):
            if x < length and free[x]:
                run += 1
                continue
            if run >= width:
                heapq.heappush(heap, (-run, at + x - run, i + x - run))
            run = 0
    return out


def coverage(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, coverage) of every pair whose coverage reaches ``threshold``."""
    scratch = Scratch(documents.sparkSession)
    items = scratch.keep(item_windows(benchmark))
    seeds = scratch.keep(items.select("item_id", F.explode("codes").alias("code")).groupBy("item_id", "code").agg(F.count(F.lit(1)).alias("times")))
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    shared = document_windows(documents, code_bitmap(seeds)).join(seeds, "code")
    # A tile of L words has L - MATCH + 1 >= L / MATCH of the item's window places, so a pair under this bound cannot reach the threshold.
    least = F.col("n") * (threshold / MATCH) - 1e-6
    codes = F.array_distinct(F.transform("places", lambda p: F.struct(p.code, p.times)))
    pairs = (shared.groupBy("doc_id", "item_id").agg(F.collect_set(F.struct("at", "code", "times")).alias("places"))
             .withColumn("found", F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a + c.times))
             .join(items, "item_id").where(F.col("found") >= least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, item, n, codes, places in zip(*(b.column(c).to_pylist() for c in ("doc_id", "item_id", "n", "codes", "places"))):
                share = sum(t[0] for t in tiles(codes, n, [(p["at"], p["code"]) for p in places])) / n
                if share >= threshold:
                    out.append((doc, item, share))
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], ["doc_id", "item_id", "coverage"])

    found = scratch.keep(pairs.select("doc_id", "item_id", "n", "codes", "places").mapInArrow(run, "doc_id long, item_id long, coverage double"))
    scratch.drop(items, seeds)
    return found


def contaminated(found: DataFrame) -> DataFrame:
    """(doc_id, n_items, item_id, coverage): a row per contaminated document, with its best covered item."""
    best = F.max(F.struct("coverage", (-F.col("item_id")).alias("item")))
    return (found.groupBy("doc_id").agg(F.countDistinct("item_id").alias("n_items"), best.alias("best"))
            .select("doc_id", "n_items", (-F.col("best.item")).alias("item_id"), F.col("best.coverage").alias("coverage")))


def keep_clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``documents``, all columns, without the rows that cover a benchmark item; rows are told by id and text."""
    keyed = row_keys(Scratch(documents.sparkSession), documents)
    found = coverage(keyed.select(F.col(ROW_KEY).alias("doc_id"), "text"), benchmark, threshold).select(F.col("doc_id").alias(ROW_KEY)).distinct()
    return keyed.join(found.hint("shuffle_hash"), ROW_KEY, "left_anti").select(documents.columns)


def op5_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: whether a benchmark item is covered, by which and how far."""
    documents = row_keys(Scratch(spark), table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = documents.select(F.col(ROW_KEY).alias("doc_id"), "text")
    found = contaminated(coverage(rows, table(spark, sf_dir, "benchmark"))).withColumnRenamed("doc_id", ROW_KEY)
    return (documents.select("doc_id", ROW_KEY).join(found, ROW_KEY, "left")
            .select("doc_id", F.col("coverage").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    "item_id", F.coalesce("coverage", F.lit(0.0)).alias("coverage")))
