"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct word shingles. Documents with equal sets
are one class (its node: the smallest doc_id), and classes get b-bit MinHash
signatures: 128 positions of 16 bits. The Hamming distance of two signatures
counts differing positions.

Index: the first 64 positions are cut into 16 chunks of 4. If two signatures
differ in at most 31 of them, some chunk differs in at most one position
(pigeonhole: 16 chunks with 2 errors each make 32). So every chunk is keyed by
its 4 variants with one position left out, 64 keys a class, and all pairs
within distance 31 share a key. At similarity 0.8 a position differs with
probability 0.2, so a link is missed with probability below 1e-6; the second
64 positions only sharpen the distance test (at most 52 of 128, same odds).

No pairs are emitted. Buckets with the same members are processed once; a
bucket is cut into blocks, and a block pair yields only a spanning forest of
its near pairs. The forests' components (candidate groups) are again cut into
blocks of bounded shingle counts; in a block pair every near pair that is not
yet connected is confirmed on the full sets, and a spanning forest of the
confirmed links leaves the task. The components are exactly those of all
confirmed links.

Cases: null and empty texts, and texts of white space, have the empty set and
are linked with nothing. Fewer words than the shingle width: the whole
sequence is one shingle. Rows that repeat a doc_id are returned each; they
count as one document. Rows with a null doc_id are linked with nothing
(component null, kept). Extra columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import ROW_KEY, Scratch, connected_components, row_keys, run_starts, slices, sorted_runs, table

CHUNKS, CHUNK, POSITIONS = 16, 4, 128
INDEXED = CHUNKS * CHUNK
NEAR_INDEXED, NEAR = 31, 52
BUCKET_ROWS, BLOCK_ROWS, BLOCK_SHINGLES = 4000, 1500, 400_000
_MULTIPLIERS = tc.stream(POSITIONS, 99) | tc.U64(1)


def sets_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw, off = tc.utf8(texts)
    codes, bounds, _, _ = tc.words(raw, off)
    return tc.row_sets(*tc.shingles(codes, bounds, width))


def signatures(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, POSITIONS) uint16; zeros for an empty set."""
    n = np.diff(bounds)
    out = np.zeros((len(n), POSITIONS), np.uint16)
    full = np.flatnonzero(n > 0)
    if len(full):
        for j, m in enumerate(_MULTIPLIERS):
            least = np.minimum.reduceat(((codes * m) >> tc.U64(32)).astype(np.uint32), bounds[full])
            out[full, j] = (least & 0xFFFF).astype(np.uint16)
    return out


def profile(documents: DataFrame, width: int) -> DataFrame:
    """(doc_id, h1, h2, n, sig): set identity (128 bits and size) and signature of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            codes, bounds = sets_of(b.column(1), width)
            n = np.diff(bounds)
            h = np.zeros((2, len(n)), np.int64)
            full = np.flatnonzero(n > 0)
            if len(full):
                h[0, full] = np.add.reduceat(codes, bounds[full]).view(np.int64)
                h[1, full] = np.add.reduceat(tc.mix(codes ^ tc.U64(0x5BF03635)), bounds[full]).view(np.int64)
            sig = signatures(codes, bounds)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h[0]), pa.array(h[1]), pa.array(n.astype(np.int64)),
                                              pa.array([s.tobytes() for s in sig], pa.binary())], ["doc_id", "h1", "h2", "n", "sig"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, h1 long, h2 long, n long, sig binary")


def _sig_rows(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(len(col), POSITIONS)


def chunk_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): the 64 one-error keys of each node's signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            sig = _sig_rows(b.column(1))[:, :INDEXED].astype(np.uint64).reshape(-1, CHUNKS, CHUNK)
            keys = np.empty((b.num_rows, CHUNKS, CHUNK), np.uint64)
            for left_out in range(CHUNK):
                acc = np.broadcast_to(np.arange(CHUNKS, dtype=np.uint64) * tc.U64(CHUNK) + tc.U64(left_out), sig.shape[:2])
                for i in range(CHUNK):
                    if i != left_out:
                        acc = (acc << tc.U64(16)) | sig[:, :, i]
                keys[:, :, left_out] = tc.mix(acc)
            node = np.repeat(b.column(0).to_numpy(), CHUNKS * CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(node)], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def near_matrix(sig: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(left, right) True where the signatures are within the distance thresholds."""
    a, b = sig[left], sig[right]
    apart = np.zeros((len(a), len(b)), np.uint8)
    for j in range(POSITIONS):
        if j == INDEXED:
            close = apart <= NEAR_INDEXED
            if not close.any():
                return close
        apart += a[:, j][:, None] != b[:, j][None, :]
    return close & (apart <= NEAR)


def labels(adjacent: np.ndarray) -> np.ndarray:
    """Component (least index) of each node of a symmetric boolean matrix."""
    n = len(adjacent)
    label = np.full(n, -1)
    for start in range(n):
        if label[start] >= 0:
            continue
        front = np.zeros(n, bool)
        front[start] = True
        while front.any():
            label[front] = start
            front = adjacent[front].any(0) & (label < 0)
    return label


def blocked(rows: DataFrame, blocks: str) -> DataFrame:
    """Repeat each row for every block pair (bi <= bj) that its own block ``my`` is part of."""
    return (rows.withColumn("my", F.pmod(F.xxhash64(F.lit(3), "node"), F.col(blocks)).cast("int"))
            .withColumn("__o", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
            .withColumn("bi", F.least("my", "__o")).withColumn("bj", F.greatest("my", "__o")).drop("__o", blocks))


_EDGES = ["a", "b"]


def _edge_batch(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64))], _EDGES)


def _near_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["key", "bi", "bj"]
    for t in sorted_runs(batches, keys):
        first = run_starts(t, keys)
        size = np.diff(np.append(first, t.num_rows))
        node, my, bi, bj = (t.column(c).to_numpy() for c in ("node", "my", "bi", "bj"))
        sig = _sig_rows(t.column("sig"))
        two = first[(size == 2) & (bi[first] == bj[first])]
        differ = sig[two] != sig[two + 1]
        ok = two[(differ[:, :INDEXED].sum(1) <= NEAR_INDEXED) & (differ.sum(1) <= NEAR)]
        a, b = [node[ok]], [node[ok + 1]]
        for s, m in zip(first.tolist(), size.tolist()):
            same = bi[s] == bj[s]
            if m < 2 or (m == 2 and same):
                continue
            rows = np.arange(s, s + m)
            if same:
                adjacent = near_matrix(sig, rows, rows)
            else:
                left, right = rows[my[rows] == bi[s]], rows[my[rows] == bj[s]]
                if len(left) == 0 or len(right) == 0:
                    continue
                adjacent = np.zeros((m, m), bool)
                near = near_matrix(sig, left, right)
                adjacent[np.ix_(left - s, right - s)] = near
                adjacent[np.ix_(right - s, left - s)] = near.T
            label = labels(adjacent)
            other = np.flatnonzero(label != np.arange(m))
            a.append(node[rows[label[other]]])
            b.append(node[rows[other]])
        yield _edge_batch(np.concatenate(a), np.concatenate(b))


def _sets(rows: DataFrame, width: int, extra: str) -> DataFrame:
    """Replace ``text`` by the row's set (little-endian 64-bit codes)."""
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            codes, bounds = sets_of(b.column("text"), width)
            held = [codes[bounds[i]:bounds[i + 1]].tobytes() for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(held, pa.binary())], [*names, "held"])

    return rows.select(*names, "text").mapInArrow(run, extra + ", held binary")


def linked(common, n_a, n_b, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def confirm(node: np.ndarray, held: list[bytes], near, percent: int) -> tuple[list[int], list[int]]:
    """Spanning forest of the confirmed links among rows; ``near(i)``: later rows to compare row i with."""
    sizes = np.array([len(h) // 8 for h in held])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    _, codes = np.unique(np.frombuffer(b"".join(held), np.uint64), return_inverse=True)
    flag = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    comp = np.arange(len(node))
    a, b = [], []
    for i in range(len(node)):
        other = near(i)
        other = other[comp[other] != comp[i]]
        if len(other) == 0:
            continue
        mine = codes[bounds[i]:bounds[i + 1]]
        flag[mine] = True
        if sizes[other].sum() * 4 > len(codes):
            common = np.add.reduceat(flag[codes].astype(np.int64), bounds[:-1])[other]
        else:
            common = np.array([np.count_nonzero(flag[codes[bounds[j]:bounds[j + 1]]]) for j in other])
        flag[mine] = False
        for j in other[linked(common, sizes[i], sizes[other], percent)]:
            if comp[j] != comp[i]:
                comp[comp == comp[j]] = comp[i]
                a.append(int(node[i]))
                b.append(int(node[j]))
    return a, b


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["group", "bi", "bj"]
        for t in sorted_runs(batches, keys, rows=512):
            first = run_starts(t, keys)
            ends = np.append(first[1:], t.num_rows)
            node, my, bi, bj = (t.column(c).to_numpy() for c in ("node", "my", "bi", "bj"))
            sig, held = _sig_rows(t.column("sig")), t.column("held")
            a, b = [], []
            for s, e in zip(first.tolist(), ends.tolist()):
                if e - s < 2:
                    continue
                rows = np.arange(s, e)
                if bi[s] == bj[s]:
                    left = right = rows
                    adjacent = np.triu(near_matrix(sig, rows, rows), 1)
                else:
                    left, right = rows[my[rows] == bi[s]], rows[my[rows] == bj[s]]
                    adjacent = near_matrix(sig, left, right) if len(left) and len(right) else np.zeros((0, 0), bool)
                place = np.full(e - s, -1)
                place[left - s] = np.arange(len(left))
                near = lambda i: (right[adjacent[place[i]]] - s) if place[i] >= 0 and place[i] < len(adjacent) else np.empty(0, np.int64)  # noqa: E731,B023
                x, y = confirm(node[s:e], held.slice(s, e - s).to_pylist(), near, percent)
                a += x
                b += y
            yield _edge_batch(a, b)

    return run


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``documents`` (doc_id, text)."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prof = scratch.keep(profile(documents, width))
    real = prof.where("n > 0 AND doc_id IS NOT NULL")
    classes = scratch.keep(real.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("node")))
    nodes = scratch.keep(real.join(classes.select("h1", "h2", "n", F.col("node").alias("doc_id")), ["h1", "h2", "n", "doc_id"], "left_semi")
                         .select(F.col("doc_id").alias("node"), "n", "sig").dropDuplicates(["node", "n", "sig"]))

    keys = chunk_keys(nodes)
    shared = (keys.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("lo"), F.bit_xor(F.xxhash64("node")).alias("hx"))
              .where("c > 1").groupBy("c", "lo", "hx").agg(F.min("key").alias("key"))
              .select("key", F.ceil(F.col("c") / BUCKET_ROWS).cast("int").alias("blocks")))
    buckets = scratch.keep(shared)
    in_buckets = blocked(keys.join(buckets, "key"), "blocks").join(nodes.select("node", "sig"), "node")
    near = in_buckets.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "node").mapInArrow(_near_forest, "a long, b long")
    groups = connected_components(scratch, near)

    members = nodes.join(groups.select("node", F.col("component").alias("group")), "node")
    blocks = scratch.keep(members.groupBy("group").agg(F.greatest(
        F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_ROWS)).cast("int").alias("blocks")))
    members = scratch.keep(members.join(blocks, "group").select(F.col("node").alias("doc_id"), "group", "blocks", "sig"))
    texts = documents.join(members.hint("shuffle_hash"), "doc_id").select(F.col("doc_id").alias("node"), "group", "blocks", "sig", "text")
    held = _sets(texts, width, "node long, group long, blocks int, sig binary")
    confirmed = (blocked(held, "blocks").repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj")
                 .mapInArrow(_verifier(percent), "a long, b long"))
    components = connected_components(scratch, confirmed)

    named = scratch.keep(classes.join(components, "node", "left").select("h1", "h2", "n", F.coalesce("component", "node").alias("component_id")))
    scratch.drop(classes, nodes, buckets, blocks, members, groups, components)
    return (prof.join(named, ["h1", "h2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``documents``, all columns, without the rows that a component's first document stands for.

    Rows take part by id and text together (``common.row_keys``), those without
    an id as well; rows alike in both stay or go together.
    """
    scratch = Scratch(documents.sparkSession)
    keyed = row_keys(scratch, documents)
    gone = near_duplicates(keyed.select(F.col(ROW_KEY).alias("doc_id"), "text"), width, percent).where("NOT kept").select(F.col("doc_id").alias(ROW_KEY))
    return keyed.join(gone.hint("shuffle_hash"), ROW_KEY, "left_anti").select(documents.columns)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over two-word shingles at similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM sized),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id AND 5 * b.n >= 4 * a.n AND 5 * a.n >= 4 * b.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(node, least) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.node WHERE r.least < l.b),
best AS (SELECT node, min(least) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, b.component_id, s.doc_id = b.component_id AS kept
FROM sized s JOIN best b ON b.node = s.doc_id
"""
