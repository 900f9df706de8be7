"""Embedding near-duplicates over a robust-pruned flat graph.

Vectors are compared within a label only. Equal vectors are one class (node:
the smallest vec_id) with its number of copies. Then:

1. Cells: centroids of each large label, fitted on a bounded sample (at most
   MAX_LABELS labels, MAX_CENTROIDS centroids and SAMPLE vectors in all, so the
   broadcast is bounded); smaller labels are one cell. Every node joins its
   OVERLAP nearest cells.
2. Shards: a cell is dealt by hash into blocks of about BLOCK nodes. Each
   block builds a flat graph: a node's candidates are its nearest nodes and
   some random ones, robust-pruned (a candidate goes if a chosen neighbour is
   ALPHA times closer to it than the node is), with reverse edges.
3. Union: a node's adjacency lists of all its shards become one.
4. Search: for every two blocks of a cell, the nodes of one are queries to the
   other's graph: greedy beam search from the medoid, then every node found in
   range is expanded until no more come into range. A node looks for itself in
   its own block; one that misses itself searches again with a wider beam and
   at last from itself.
5. Verify: cosine in double precision; only pairs at the threshold count, in
   both directions. A pair is counted in the smallest cell that both share.

A task returns per node a number of linked vectors and a spanning forest of
its links; pairs are never emitted. ``audit`` measures recall against brute
force for the rows whose id is divisible by ``every``.

Cases: null vectors, vectors with null or non-finite components, zero vectors
and rows with a null label or id link with nothing (component: the own id).
Vectors of different length never link. Rows that repeat a vec_id are one
vector (the smallest by value, if they differ), returned each. Extra columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import Scratch, connected_components, run_starts, sorted_runs, table
from tollgate.llm.minhash import blocked, labels

CELL, BLOCK, OVERLAP = 800, 1500, 2
MAX_LABELS, MAX_CENTROIDS, SAMPLE = 256, 4096, 60_000
NEAREST, RANDOM, DEGREE, ALPHA, BEAM = 40, 24, 24, 1.2, 24


def prepare(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, h1, h2, x) of the vectors that can link; x: packed doubles."""
    fine = (F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
            & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
            & F.exists("embedding", lambda v: v != 0))
    one = (vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e")).alias("v"))
           .groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v.label", "v.e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            col = b.column(2)
            off = np.asarray(col.offsets)
            flat = np.asarray(col.flatten())
            off = off - off[0]
            bits = flat.view(np.uint64)
            at = np.arange(len(bits), dtype=np.uint64) - np.repeat(off[:-1], np.diff(off)).astype(np.uint64)
            h1 = np.add.reduceat(tc.mix(bits + at * tc.U64(0x9E3779B97F4A7C15)), off[:-1]).view(np.int64)
            h2 = np.add.reduceat(tc.mix((bits ^ tc.U64(0x5851F42D4C957F2D)) + at * tc.U64(0xD1342543DE82EF95)), off[:-1]).view(np.int64)
            x = [flat[off[i]:off[i + 1]].tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(off).astype(np.int32)), pa.array(h1), pa.array(h2), pa.array(x, pa.binary())],
                                             ["vec_id", "label", "dim", "h1", "h2", "x"])

    return one.mapInArrow(run, "vec_id long, label long, dim int, h1 long, h2 long, x binary")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(nodes: DataFrame, seed: int = 11) -> dict[tuple[int, int], np.ndarray]:
    """(label, dim) -> unit centroids of the labels larger than a cell; spherical k-means on a bounded sample."""
    large = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).where(F.col("n") > CELL).orderBy(F.desc("n"), "label", "dim").limit(MAX_LABELS).collect()
    total = sum(r["n"] for r in large)
    out = {}
    if not large:
        return out
    place = F.xxhash64(F.lit(seed), "node").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    keep = F.lit(False)
    for r in large:
        keep = keep | ((F.col("label") == r["label"]) & (F.col("dim") == r["dim"]) & (place < min(1.0, SAMPLE / 2 / total)))
    rows = nodes.where(keep).select("node", "label", "dim", "x").limit(SAMPLE).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r["node"]):
        by.setdefault((r["label"], r["dim"]), []).append(np.frombuffer(r["x"], np.float64))
    for r in large:
        key = (r["label"], r["dim"])
        if len(by.get(key, ())) < 2:
            continue
        x = _unit(np.stack(by[key]))
        k = int(min(-(-r["n"] // CELL), max(1, MAX_CENTROIDS * r["n"] // total), len(x)))
        c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
        for _ in range(8):
            near = (x @ c.T).argmax(1)
            sums = np.zeros_like(c)
            np.add.at(sums, near, x)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            c = np.where(norm > 0, sums / np.maximum(norm, 1e-300), c)
        out[key] = c
    return out


def assign(nodes: DataFrame, cells: dict) -> DataFrame:
    """A row per node and joined cell: (node, group, cell, cells, copies, x); ``group`` stands for (label, dim, cell)."""
    shared = nodes.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            label, dim = b.column("label").to_numpy(), b.column("dim").to_numpy()
            x = b.column("x").to_pylist()
            joined: list = [[0]] * b.num_rows
            for key, c in shared.value.items():
                rows = np.flatnonzero((label == key[0]) & (dim == key[1]))
                if len(rows) == 0:
                    continue
                sims = _unit(np.frombuffer(b"".join(x[i] for i in rows), np.float64).reshape(len(rows), -1)) @ c.T
                top = np.argsort(-sims, axis=1, kind="stable")[:, :OVERLAP]
                for i, t in zip(rows.tolist(), np.sort(top, 1).tolist()):
                    joined[i] = t
            count = np.array([len(j) for j in joined])
            take = pa.array(np.repeat(np.arange(b.num_rows), count))
            cell = np.concatenate([np.array(j, np.int64) for j in joined])
            with_list = pa.array([j for j in joined for _ in j], pa.list_(pa.int64()))
            group = tc.mix(tc.mix(label[take].astype(np.uint64) + (dim[take].astype(np.uint64) << tc.U64(48))) + cell.astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("node").take(take), pa.array(group), pa.array(cell), with_list, b.column("copies").take(take), b.column("x").take(take)],
                                             ["node", "group", "cell", "cells", "copies", "x"])

    return nodes.select("node", "label", "dim", "copies", "x").mapInArrow(run, "node long, group long, cell long, cells array<long>, copies long, x binary")


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _unit(a) @ _unit(b).T


def prune(near: np.ndarray, sims: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Robust pruning of one node's candidates; ``sims``: cosines of [node, *candidates] among each other.

    Distances are angles' chords; candidates come nearest first.
    """
    dist = np.sqrt(np.maximum(2 - 2 * sims, 0))
    alive = np.ones(len(near), bool)
    out = []
    for i in range(len(near)):
        if not alive[i]:
            continue
        out.append(near[i])
        if len(out) == degree:
            break
        alive &= ALPHA * dist[i + 1, 1:] > dist[0, 1:]
    return np.array(out, np.int64)


def build(x: np.ndarray, seed: int) -> list[np.ndarray]:
    """Adjacency of a shard's flat graph."""
    m = len(x)
    s = cosines(x, x)
    rng = np.random.default_rng(seed)
    out: list = []
    reverse: list[list[int]] = [[] for _ in range(m)]
    for i in range(m):
        row = s[i].copy()
        row[i] = -2
        k = min(NEAREST, m - 1)
        near = np.argpartition(-row, k - 1)[:k] if k else np.empty(0, np.int64)
        near = near[np.argsort(-row[near], kind="stable")]
        far = rng.choice(m, min(RANDOM, m), replace=False)
        far = far[(far != i) & ~np.isin(far, near)]
        far = far[np.argsort(-row[far], kind="stable")]
        some = []
        for pool, degree in ((near, DEGREE), (far, DEGREE // 3)):
            if len(pool):
                at = np.concatenate(([i], pool))
                some.append(prune(pool, s[np.ix_(at, at)], degree))
        mine = np.concatenate(some) if some else near
        out.append(mine)
        for j in mine[:DEGREE // 2].tolist():
            reverse[j].append(i)
    return [np.unique(np.concatenate([a, np.array(r[:DEGREE], np.int64)])) for a, r in zip(out, reverse)]


def _matrix(col) -> np.ndarray:
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["group", "my"]
    for t in sorted_runs(batches, keys, rows=BLOCK):
        first = run_starts(t, keys)
        node = t.column("node").to_numpy()
        lists = []
        for s, e in zip(first.tolist(), np.append(first[1:], t.num_rows).tolist()):
            lists += [node[s + a] for a in build(_matrix(t.column("x").slice(s, e - s)), int(node[s]) % 2**32)]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(lists, pa.list_(pa.int64()))], ["node", "near"])


def search(sims: np.ndarray, adjacent: np.ndarray, entry: int, beam: int) -> np.ndarray:
    """Visited nodes (queries, nodes) of greedy beam searches from ``entry``.

    sims: query x node; adjacent: padded neighbour lists, -1 for none. All
    queries advance together.
    """
    q, m = sims.shape
    visited = np.zeros((q, m), bool)
    visited[:, entry] = True
    held = np.full((q, beam), -1)
    held[:, 0] = entry
    value = np.full((q, beam), -np.inf)
    value[:, 0] = sims[:, entry]
    todo = np.zeros((q, beam), bool)
    todo[:, 0] = True
    live = np.arange(q)
    while len(live):
        best = np.where(todo[live], value[live], -np.inf).argmax(1)
        todo[live, best] = False
        near = adjacent[held[live, best]]
        fresh = (near >= 0) & ~visited[live[:, None], near]
        visited[live[:, None], np.where(fresh, near, entry)] = True
        got = np.where(fresh, sims[live[:, None], near], -np.inf)
        all_held = np.concatenate([held[live], near], 1)
        all_value = np.concatenate([value[live], got], 1)
        all_todo = np.concatenate([todo[live], fresh], 1)
        top = np.argpartition(-all_value, beam - 1, axis=1)[:, :beam]
        held[live] = np.take_along_axis(all_held, top, 1)
        value[live] = np.take_along_axis(all_value, top, 1)
        todo[live] = np.take_along_axis(all_todo, top, 1) & (value[live] > -np.inf)
        live = live[todo[live].any(1)]
    return visited


def expand(found: np.ndarray, adjacent: np.ndarray, in_range: np.ndarray) -> np.ndarray:
    """Range expansion: neighbours in range of what is found, until nothing new comes."""
    found = found & in_range
    front = found
    while True:
        q, n = np.nonzero(front)
        if len(q) == 0:
            return found
        new = np.zeros_like(found)
        for column in adjacent.T:
            to = column[n]
            ok = to >= 0
            new[q[ok], to[ok]] = True
        front = new & in_range & ~found
        found = found | front


def links_between(x: np.ndarray, y: np.ndarray, adjacent: np.ndarray, same: bool, threshold: float) -> np.ndarray:
    """Boolean (queries, nodes): links that the search of graph ``y`` finds for queries ``x``."""
    sims = cosines(x, y)
    mean = _unit(y).mean(0)
    entry = int((_unit(y) @ mean).argmax())
    visited = search(sims, adjacent, entry, BEAM)
    if same:
        lost = np.flatnonzero(~np.diagonal(visited))
        if len(lost):
            visited[lost] |= search(sims[lost], adjacent, entry, 4 * BEAM)
            lost = lost[~visited[lost, lost]]
            visited[lost, lost] = True
            visited[lost[:, None], np.where(adjacent[lost] >= 0, adjacent[lost], lost[:, None])] = True
    return expand(visited, adjacent, sims >= threshold)


def _padded(lists: list, ids: np.ndarray) -> np.ndarray:
    """Neighbour lists as places in ``ids`` (ascending), -1 for none or another shard's node."""
    width = max((len(a) for a in lists), default=0)
    out = np.full((len(lists), max(width, 1)), -1)
    for i, a in enumerate(lists):
        at = np.minimum(np.searchsorted(ids, a), len(ids) - 1)
        ok = ids[at] == a
        out[i, :int(ok.sum())] = at[ok]
    return out


def _searcher(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["group", "bi", "bj"]
        for t in sorted_runs(batches, keys, rows=BLOCK):
            first = run_starts(t, keys)
            node, my, bi, bj, cell, copies = (t.column(c).to_numpy() for c in ("node", "my", "bi", "bj", "cell", "copies"))
            cells, near = t.column("cells").to_pylist(), t.column("near").to_pylist()
            out_node, out_n, out_to = [], [], []
            for s, e in zip(first.tolist(), np.append(first[1:], t.num_rows).tolist()):
                rows = s + np.argsort(node[s:e], kind="stable")
                x = _matrix(t.column("x").take(pa.array(rows)))
                here, side = int(cell[s]), my[rows]
                blocks = [np.flatnonzero(side == b) for b in sorted({int(bi[s]), int(bj[s])})]
                if bi[s] != bj[s] and len(blocks) < 2 or any(len(b) == 0 for b in blocks):
                    continue
                a, b = blocks[0], blocks[-1]
                lists = [np.array(near[r] or [], np.int64) for r in rows]
                local = lambda part: _padded([lists[i] for i in part], node[rows[part]])  # noqa: E731,B023
                if bi[s] == bj[s]:
                    linked = links_between(x[a], x[a], local(a), True, threshold)
                    linked |= linked.T
                    np.fill_diagonal(linked, False)
                else:
                    linked = links_between(x[a], x[b], local(b), False, threshold) | links_between(x[b], x[a], local(a), False, threshold).T
                i, j = np.nonzero(linked)
                mine = np.array([cells[r] for r in rows])
                if len(i) and mine.shape[1] > 1:  # a pair counts in the smallest cell that both joined
                    common = (mine[a[i]][:, :, None] == mine[b[j]][:, None, :]).any(2)
                    own = mine[a[i], common.argmax(1)] == here
                    i, j = i[own], j[own]
                if len(i) == 0:
                    continue
                gi, gj = rows[a[i]], rows[b[j]]
                w = np.zeros(t.num_rows, np.int64)
                np.add.at(w, gi, copies[gj])
                if bi[s] != bj[s]:
                    np.add.at(w, gj, copies[gi])
                adjacency = np.zeros((e - s, e - s), bool)
                adjacency[gi - s, gj - s] = adjacency[gj - s, gi - s] = True
                root = s + labels(adjacency)
                touched = np.unique(np.concatenate([gi, gj]))
                out_node.append(node[touched])
                out_n.append(w[touched])
                out_to.append(node[root[touched - s]])
            cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (out_node, out_n, out_to)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["node", "n", "to"])

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = scratch.keep(prepare(vectors))
    classes = scratch.keep(rows.groupBy("label", "dim", "h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    nodes = scratch.keep(rows.join(classes.select(F.col("node").alias("vec_id"), "copies"), "vec_id").select(F.col("vec_id").alias("node"), "label", "dim", "copies", "x"))
    joined = scratch.keep(assign(nodes, centroids(nodes)))
    blocks = scratch.keep(joined.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    joined = joined.join(blocks, "group")
    shards = (joined.withColumn("my", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int")).select("node", "group", "my", "x")
              .repartition("group", "my").sortWithinPartitions("group", "my", "node").mapInArrow(_build_shards, "node long, near array<long>"))
    union = scratch.keep(shards.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    found = scratch.keep(blocked(joined.join(union, "node"), "blocks").repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj")
                         .mapInArrow(_searcher(threshold), "node long, n long, to long"))
    components = connected_components(scratch, found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    counts = scratch.keep(found.groupBy("node").agg(F.sum("n").alias("n")))
    named = scratch.keep(classes.join(counts, "node", "left").join(components, "node", "left")
                         .select("label", "dim", "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    result = scratch.keep(rows.select("vec_id", "label", "dim", "h1", "h2").join(named, ["label", "dim", "h1", "h2"]).select("vec_id", "n_links", "component_id"))
    scratch.drop(rows, classes, nodes, union, blocks, found, components, counts, named)
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(result, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def audit(vectors: DataFrame, result: DataFrame, threshold: float = 0.98, every: int = 100) -> DataFrame:
    """(queries, links, found, recall): links of the rows whose id is divisible by ``every``, by brute force and as found.

    Queries and rows meet per label in blocks of rows, numpy against numpy.
    """
    rows = prepare(vectors).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(64)).cast("int"))
    asked = rows.where(F.col("vec_id") % every == 0).drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(63))))

    def run(key, q, r):
        x, y = _unit(np.stack([np.frombuffer(v, np.float64) for v in q["x"]])) if len(q) else None, None
        if x is None or len(r) == 0:
            return q.iloc[:0][["vec_id"]].assign(n=np.empty(0, np.int64))
        y = _unit(np.stack([np.frombuffer(v, np.float64) for v in r["x"]]))
        n = (x @ y.T >= threshold).sum(1) - np.isin(q["vec_id"], r["vec_id"])
        return q[["vec_id"]].assign(n=n.astype(np.int64))

    keys = ["label", "dim", "block"]
    brute = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(run, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    return (brute.join(result, "vec_id").agg(F.count("*").alias("queries"), F.sum("n").alias("links"), F.sum(F.least("n", "n_links")).alias("found"))
            .withColumn("recall", F.when(F.col("links") > 0, F.col("found") / F.col("links")).otherwise(F.lit(1.0))))


def op6_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector: links at cosine 0.98 within its label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
