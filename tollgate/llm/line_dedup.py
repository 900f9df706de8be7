"""Line dedup by an exact set-similarity join.

A line is the set of its lower-cased words. A line goes if an earlier one (by
doc_id, then line number) has the same set or a Jaccard similarity of at least
``percent``. Lines without words stay.

1. Lines with equal sets are one class; its place is that of its first line.
2. Words are counted over the whole table into 2**20 counters (hash buckets;
   4 MB at any input size). Rarity order: counter, bucket, word code - one
   fixed order for all lines, so the prefix filter is exact.
3. Every line posts the words of its prefix (n - ceil(t n) + 1 rarest), packed
   as arrays by hash part. Within a part, two classes that share a word are a
   candidate if they pass the length filter, the positional filter and a bound
   from 128-bit parity maps (differing bits never exceed differing words).
   Only a spanning forest of the candidates leaves the task. A word whose
   counter passes HOT, or that more than WIDE classes post, links its classes
   without the filters; that only makes candidate groups larger.
4. The forests' components are the candidate groups. They are cut into blocks
   of bounded size, and every block pair looks for each class whether an
   earlier class of the group passes the similarity on the full sets.

Every pair at the threshold shares a prefix word and passes the filters, so it
ends in one group and meets in one block pair: the join is exact.

Cases: null and empty texts have no lines to remove; a text whose lines all
went is empty. Repeated rows of one doc_id with one text are one place each
(``dedup`` returns every row). In ``removed_lines`` rows with a null doc_id take
no part and texts of one id share its places; ``dedup`` tells rows apart by id
and text, so there each takes part for itself. Very long lines are handled whole. Extra columns are passed through
by ``dedup`` and not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import ROW_KEY, Scratch, connected_components, row_keys, run_starts, slices, sorted_runs, table
from tollgate.llm.minhash import blocked

BITS, SLABS = 20, 64
HOT, WIDE = 200_000, 4096
MAP_WORDS = 2
BLOCK_ROWS, BLOCK_TOKENS = 4000, 200_000
FLUSH_POSTINGS = 400_000


def line_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, bounds) of every line's word set, the row of each line and its number in the row."""
    raw, off = tc.utf8(texts)
    ends = np.flatnonzero(raw == 0x0A) + 1
    starts = np.sort(np.concatenate((off[:-1], ends)))
    row = np.searchsorted(off, ends - 1, "right") - 1
    row = np.sort(np.concatenate((np.arange(len(off) - 1), row)))
    first = np.searchsorted(row, np.arange(len(off) - 1))
    codes, bounds, _, _ = tc.words(raw, np.append(starts, len(raw)))
    codes, bounds = tc.row_sets(codes, bounds)
    return codes, bounds, row, np.arange(len(row)) - first[row]


def identities(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.zeros((2, len(bounds) - 1), np.int64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        h[0, full] = np.add.reduceat(codes, bounds[full]).view(np.int64)
        h[1, full] = np.add.reduceat(tc.mix(codes ^ tc.U64(0x5BF03635)), bounds[full]).view(np.int64)
    return h[0], h[1]


def profile(documents: DataFrame) -> DataFrame:
    """Two kinds of rows in one pass over the texts.

    (doc_id, line, h1, h2, n) of every line with words, and per task (slab,
    held): its word counters, 2**BITS of them in SLABS slabs.
    """
    width = (1 << BITS) // SLABS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for b in slices(batches, "text"):
            codes, bounds, row, line = line_sets(b.column(1))
            np.add.at(total, (codes >> tc.U64(64 - BITS)).astype(np.int64), 1)
            h1, h2 = identities(codes, bounds)
            n = np.diff(bounds)
            live = n > 0
            doc = b.column(0).take(pa.array(row[live]))
            yield pa.RecordBatch.from_arrays([doc, pa.array(line[live].astype(np.int64)), pa.array(h1[live]), pa.array(h2[live]),
                                              pa.array(n[live].astype(np.int64)), pa.nulls(len(doc), pa.int32()), pa.nulls(len(doc), pa.binary())], _PROFILE)
        if total.any():
            none = pa.nulls(SLABS, pa.int64())
            held = [np.minimum(s, 2**31 - 1).astype(np.int32).tobytes() for s in total.reshape(SLABS, width)]
            yield pa.RecordBatch.from_arrays([none] * 5 + [pa.array(np.arange(SLABS, dtype=np.int32)), pa.array(held, pa.binary())], _PROFILE)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, line long, h1 long, h2 long, n long, slab int, held binary")


_PROFILE = ["doc_id", "line", "h1", "h2", "n", "slab", "held"]


def word_counters(profiled: DataFrame) -> np.ndarray:
    """Lines per hash bucket of words over all tasks: slabs are summed slab by slab, 4 MB reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for slab, held in zip(b.column(0).to_pylist(), b.column(1)):
                sums[slab] = sums.get(slab, 0) + np.frombuffer(held.as_buffer(), np.int32).astype(np.int64)
        for slab, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([np.minimum(s, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())], ["slab", "held"])

    rows = profiled.where("slab IS NOT NULL").select("slab", "held").repartition("slab").mapInArrow(add, "slab int, held binary").collect()
    out = np.zeros((SLABS, (1 << BITS) // SLABS), np.int32)
    for r in rows:
        out[r["slab"]] = np.frombuffer(r["held"], np.int32)
    return out.reshape(-1)


def least_common(a, b, percent: int):
    """Smallest intersection with which sets of sizes a and b reach the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def parity_maps(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(lines, MAP_WORDS) uint64: parity of the set's words per bit."""
    m = len(bounds) - 1
    bits = 64 * MAP_WORDS
    row = np.repeat(np.arange(m), np.diff(bounds))
    odd = np.bincount(row * bits + (codes & tc.U64(bits - 1)).astype(np.int64), minlength=m * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(m, bits), axis=1).view(np.uint64)


def apart_at_most(maps: np.ndarray, i, j, bound) -> np.ndarray:
    return np.bitwise_count(maps[i] ^ maps[j]).sum(-1) <= bound


_POSTING = np.dtype([("word", "<u4"), ("n", "<u4"), ("at", "<u4"), ("line", "<i8"), ("map", "<u8", MAP_WORDS)])


def prefixes(codes: np.ndarray, bounds: np.ndarray, counters: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, word code, place in rarity order, counter) of each line's prefix words."""
    n = np.diff(bounds)
    line = np.repeat(np.arange(len(n)), n)
    bucket = (codes >> tc.U64(64 - BITS)).astype(np.int64)
    count = np.minimum(counters[bucket], (1 << 23) - 1).astype(np.uint64)
    if len(n) < 1 << 20:
        order = np.argsort((line.astype(np.uint64) << tc.U64(43)) | (count << tc.U64(20)) | bucket.astype(np.uint64), kind="stable")
    else:
        order = np.lexsort((bucket, count, line))
    at = np.arange(len(codes)) - bounds[:-1][line]
    keep = at < (n + (percent * n) // -100 + 1)[line]
    pick = order[keep]
    return line[keep], codes[pick], at[keep], count[pick]


def postings(documents: DataFrame, counters: np.ndarray, parts: int, percent: int) -> DataFrame:
    """(part, held, a, b): packed postings by hash part, or a link (a, b) made where a word is hot."""
    shared = documents.sparkSession.sparkContext.broadcast(counters)

    def pack(buffer: list[np.ndarray], part: list[np.ndarray]) -> pa.RecordBatch:
        rows, p = np.concatenate(buffer), np.concatenate(part)
        order = np.argsort(p, kind="stable")
        rows, p = rows[order], p[order]
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        held = [r.tobytes() for r in np.split(rows, first[1:])]
        none = pa.nulls(len(first), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(p[first].astype(np.int32)), pa.array(held, pa.binary()), none, none], ["part", "held", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, part, size = [], [], 0
        hot: dict[int, int] = {}
        for b in slices(batches, "text"):
            codes, bounds, _, _ = line_sets(b.column(0))
            h1, _ = identities(codes, bounds)
            n = np.diff(bounds)
            _, once = np.unique(h1, return_index=True)
            once = once[n[once] > 0]
            if len(once) == 0:
                continue
            pick = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in once])
            codes, bounds, h1, n = codes[pick], np.concatenate(([0], np.cumsum(n[once]))), h1[once], n[once]
            line, word, at, count = prefixes(codes, bounds, shared.value, percent)
            maps = parity_maps(codes, bounds)
            out = np.zeros(len(line), _POSTING)
            out["word"], out["n"], out["at"], out["line"], out["map"] = (word & tc.U64(0xFFFFFFFF)).astype(np.uint32), n[line], at, h1[line], maps[line]
            place = ((word >> tc.U64(32)) % tc.U64(parts)).astype(np.int64)
            much = count >= HOT
            if much.any():
                a, c = [], []
                for i in np.flatnonzero(much):
                    pivot = hot.get(int(word[i]))
                    if pivot is None:
                        hot[int(word[i])] = int(h1[line[i]])
                        out["n"][i] = 0  # links with all that share the word
                        much[i] = False
                    elif pivot != h1[line[i]]:
                        a.append(pivot)
                        c.append(int(h1[line[i]]))
                if a:
                    m = len(a)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(m, dtype=np.int32) % parts), pa.nulls(m, pa.binary()), pa.array(a, pa.int64()), pa.array(c, pa.int64())], ["part", "held", "a", "b"])
                out, place = out[~much], place[~much]
            buffer.append(out)
            part.append(place)
            size += len(out)
            if size >= FLUSH_POSTINGS:
                yield pack(buffer, part)
                buffer, part, size = [], [], 0
        if size:
            yield pack(buffer, part)

    return documents.select("text").mapInArrow(run, "part int, held binary, a long, b long")


def candidate_forest(rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (a, b) of the candidate pairs among the postings of one part."""
    rows = rows[np.lexsort((rows["line"], rows["n"], rows["word"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["word"][1:] != rows["word"][:-1]) | (rows["line"][1:] != rows["line"][:-1]) | (rows["n"][1:] != rows["n"][:-1])
    rows = rows[new]
    lines, node = np.unique(rows["line"], return_inverse=True)
    word, n, at, maps = rows["word"], rows["n"].astype(np.int64), rows["at"].astype(np.int64), rows["map"]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    size = np.diff(np.append(first, len(rows)))
    group = np.repeat(np.arange(len(first)), size)
    wide = ((size > WIDE) | (n[first] == 0))[group]
    parent = list(range(len(lines)))
    stale = 0

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    a: list[int] = []

    def link(i, j):
        nonlocal stale
        stale += len(i)
        for x, y in zip(node[i].tolist(), node[j].tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                a.append(x)

    active = np.flatnonzero(word[1:] == word[:-1])
    chain = active[wide[active]]
    link(chain, chain + 1)
    active = active[~wide[active]]
    label = node.copy()
    d = 1
    while len(active):
        if stale > 2000 + len(active) // 4 or d in (2, 3):
            # Components so far; a word whose classes are all one needs no more pairs.
            stale = 0
            label = np.array(parent)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
            label = label[node]
            one = np.minimum.reduceat(label, first) == np.maximum.reduceat(label, first)
            active = active[~one[group[active]]]
        i, j = active, active + d
        more = (percent * n[j] <= 100 * n[i])
        active, i, j = active[more], i[more], j[more]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        least = least_common(n[i], n[j], percent)
        ok = 1 + np.minimum(n[i] - at[i], n[j] - at[j]) - 1 >= least
        i, j, least = i[ok], j[ok], least[ok]
        ok = apart_at_most(maps, i, j, n[i] + n[j] - 2 * least)
        if ok.any():
            link(i[ok], j[ok])
        d += 1
        active = active[active + d < len(word)]
        active = active[word[active] == word[active + d]]
    if not a:
        return lines[:0], lines[:0]
    # As stars around each component's least class.
    top = np.array([root(x) for x in range(len(lines))])
    member = np.flatnonzero(top != np.arange(len(lines)))
    return lines[top[member]], lines[member]


def candidate_links(packed: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done():
            a, b = candidate_forest(np.concatenate(held), percent)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            made = batch.filter(pa.compute.is_valid(batch.column("a")))
            if made.num_rows:
                yield made.select(["a", "b"])
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not data.is_valid:
                    continue
                if part != key:
                    if held:
                        yield done()
                    key, held = part, []
                held.append(np.frombuffer(data.as_buffer(), _POSTING))
        if held:
            yield done()

    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(run, "a long, b long")


_LINE = "doc_id long, line long, h1 long, h2 long, group long, blocks int"


def _line_sets_of(rows: DataFrame) -> DataFrame:
    """(doc_id, text, lines) to a row per wanted line with its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            codes, bounds, row, line = line_sets(b.column(1))
            first = np.searchsorted(row, np.arange(b.num_rows + 1))
            h1, h2 = identities(codes, bounds)
            out = []
            for i, (doc, wanted) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                for w in wanted:
                    at = first[i] + w["line"]
                    if at < first[i + 1] and h1[at] == w["h1"] and h2[at] == w["h2"]:
                        out.append((doc, w["line"], w["h1"], w["h2"], w["group"], w["blocks"], codes[bounds[at]:bounds[at + 1]].tobytes()))
            cols = list(zip(*out)) or [[]] * 7
            types = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "line", "h1", "h2", "group", "blocks", "held"])

    return rows.mapInArrow(run, _LINE + ", held binary")


def later_matches(held: list[bytes], side: np.ndarray | None, percent: int) -> np.ndarray:
    """Of rows in order: True where an earlier row passes the threshold.

    ``side``: rows of equal side are not compared; None: all are.
    """
    m = len(held)
    sizes = np.array([len(h) // 8 for h in held])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.frombuffer(b"".join(held), np.uint64)
    maps = parity_maps(flat, bounds)
    _, codes = np.unique(flat, return_inverse=True)
    flag = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    found = np.zeros(m, bool)
    for i in range(1, m):
        j = np.arange(i) if side is None else np.flatnonzero(side[:i] != side[i])
        least = least_common(sizes[j], sizes[i], percent)
        j = j[least <= np.minimum(sizes[j], sizes[i])]
        if len(j) == 0:
            continue
        least = least_common(sizes[j], sizes[i], percent)
        ok = apart_at_most(maps, j, i, sizes[j] + sizes[i] - 2 * least)
        j, least = j[ok], least[ok]
        if len(j) == 0:
            continue
        flag[codes[bounds[i]:bounds[i + 1]]] = True
        for a in range(0, len(j), 64):
            part = j[a:a + 64]
            idx = np.concatenate([np.arange(bounds[x], bounds[x + 1]) for x in part])
            common = np.add.reduceat(flag[codes[idx]].astype(np.int64), np.concatenate(([0], np.cumsum(sizes[part])[:-1])))
            if (common >= least[a:a + 64]).any():
                found[i] = True
                break
        flag[codes[bounds[i]:bounds[i + 1]]] = False
    return found


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["group", "bi", "bj"]
        for t in sorted_runs(batches, keys, rows=4000):
            first = run_starts(t, keys)
            ends = np.append(first[1:], t.num_rows)
            h1, h2, my, bi, bj, doc, line = (t.column(c).to_numpy() for c in ("h1", "h2", "my", "bi", "bj", "doc_id", "line"))
            held = t.column("held")
            hit = []
            for s, e in zip(first.tolist(), ends.tolist()):
                if e - s < 2:
                    continue
                order = s + np.lexsort((line[s:e], doc[s:e]))
                same = np.concatenate(([False], (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])))
                order = order[~same]
                got = later_matches(held.take(pa.array(order)).to_pylist(), None if bi[s] == bj[s] else my[order], percent)
                hit.append(order[got])
            hit = np.concatenate(hit) if hit else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h1[hit], pa.int64()), pa.array(h2[hit], pa.int64())], ["h1", "h2"])

    return run


def removed_lines(documents: DataFrame, scratch: Scratch, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(lines, removed): every line with words, and those to remove, both (doc_id, line)."""
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    profiled = scratch.keep(profile(documents))
    lines = profiled.where("slab IS NULL").select("doc_id", "line", "h1", "h2", "n")
    lines._scratch_path = profiled._scratch_path
    classes = scratch.keep(lines.groupBy("h1", "h2", "n").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("c"))
                           .select("h1", "h2", "n", "c", "first.doc_id", "first.line"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = connected_components(scratch, candidate_links(postings(documents, word_counters(profiled), parts, percent), percent))

    members = scratch.keep(classes.join(groups.select(F.col("node").alias("h1"), F.col("component").alias("group")), "h1")
                           .select("doc_id", "line", "h1", "h2", "n", "group"))
    blocks = scratch.keep(members.groupBy("group").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_TOKENS), F.ceil(F.count("*") / BLOCK_ROWS)).cast("int").alias("blocks")))
    wanted = scratch.keep(members.join(blocks, "group").groupBy("doc_id").agg(F.collect_list(F.struct("line", "h1", "h2", "group", "blocks")).alias("lines")))
    texts = documents.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "lines")
    held = _line_sets_of(texts).withColumn("node", F.xxhash64("h1", "h2"))
    matched = scratch.keep(blocked(held, "blocks").repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj")
                           .mapInArrow(_verifier(percent), "h1 long, h2 long").distinct())
    decided = scratch.keep(classes.join(matched.withColumn("again", F.lit(True)), ["h1", "h2"], "left")
                           .where("c > 1 OR again").select("h1", "h2", "n", F.col("doc_id").alias("first_doc"), F.col("line").alias("first_line"), F.coalesce("again", F.lit(False)).alias("again")))
    removed = scratch.keep(lines.join(decided, ["h1", "h2", "n"])
                           .where("again OR doc_id <> first_doc OR line <> first_line").select("doc_id", "line"))
    scratch.drop(classes, groups, members, blocks, wanted, matched, decided)
    return lines, removed


def dedup(documents: DataFrame, percent: int = 80, drop_emptied: bool = True) -> DataFrame:
    """``documents`` with removed lines cut from ``text``; ``n_chars``, where present, follows.

    Rows take part by id and text together (``common.row_keys``): texts that
    share an id, or have none, are documents of their own.
    A document that lost lines and has no word left is dropped, if asked.
    """
    scratch = Scratch(documents.sparkSession)
    keyed = row_keys(scratch, documents)
    lines, removed = removed_lines(keyed.select(F.col(ROW_KEY).alias("doc_id"), "text"), scratch, percent)
    gone = scratch.keep(removed.groupBy("doc_id").agg(F.collect_set("line").alias("__gone")))
    scratch.drop(lines, removed)
    parts = F.split(F.col("text"), "\n", -1)
    kept = F.array_join(F.transform(F.filter(F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.cast("long").alias("i"))),
                                             lambda s: ~F.array_contains("__gone", s.i)), lambda s: s.x), "\n")
    out = keyed.join(gone.withColumnRenamed("doc_id", ROW_KEY).hint("shuffle_hash"), ROW_KEY, "left")
    out = out.withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(documents.schema["n_chars"].dataType)))
    if drop_emptied:
        out = out.where(F.col("__gone").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(documents.columns)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its lines with words, how many go, and their numbers (from 0) in order."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    scratch = Scratch(spark)
    lines, removed = removed_lines(documents, scratch)
    per_doc = (lines.select("doc_id", F.lit(None).cast("long").alias("gone")).unionAll(removed.select("doc_id", "line"))
               .unionAll(documents.select("doc_id", F.lit(-1).cast("long")))
               .groupBy("doc_id").agg(F.count(F.when(F.col("gone").isNull(), 1)).alias("n_lines"),
                                      F.sort_array(F.collect_set(F.when(F.col("gone") >= 0, F.col("gone")))).alias("gone")))
    return per_doc.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"),
                          F.array_join(F.transform("gone", lambda x: x.cast("string")), ",").alias("removed"))


SQL = r"""
WITH split AS (SELECT doc_id, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) AS l FROM documents),
numbered AS (SELECT doc_id, unnest(range(len(l))) AS line, unnest(l) AS x FROM split),
sets AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS s FROM numbered),
lines AS (SELECT doc_id, line, s, len(s) AS n, dense_rank() OVER (ORDER BY s) AS class FROM sets WHERE len(s) > 0),
classes AS (SELECT class, any_value(s) AS s, any_value(n) AS n, min((doc_id, line)) AS place FROM lines GROUP BY class),
items AS (SELECT class, n, place, unnest(s) AS x FROM classes),
matched AS (
  SELECT DISTINCT class FROM (
    SELECT b.class FROM items a JOIN items b ON a.x = b.x AND a.place < b.place AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*)))),
judged AS (
  SELECT l.doc_id, l.line, (l.doc_id, l.line) <> c.place OR m.class IS NOT NULL AS gone
  FROM lines l JOIN classes c USING (class) LEFT JOIN matched m USING (class))
SELECT d.doc_id, count(j.line) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  coalesce(string_agg(CAST(j.line AS VARCHAR), ',' ORDER BY j.line) FILTER (WHERE gone), '') AS removed
FROM documents d LEFT JOIN judged j USING (doc_id) GROUP BY d.doc_id
"""
