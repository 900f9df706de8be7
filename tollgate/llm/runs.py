"""Periodic runs: suffix trees with constant-time longest common extensions.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), at least ``least`` words and ``exponent`` periods long, that no
neighbouring word extends with that period. All of them are found exactly:

* Ukkonen's algorithm builds the suffix tree of a word sequence and of its
  reversal. The Euler tour of a tree passes, between two leaves, its lowest
  point at their common ancestor; only these low points are kept, with a sparse
  table of minima, so the longest common extension of two positions, forwards
  or backwards, is two look-ups.
* The order of the leaves gives the longest Lyndon word that starts at each
  position, for the order of words and for its reverse (the end comes first in
  both). By the runs theorem each run has one of them as its root, so the at
  most 2n roots, extended to both sides, give every run.

Trees are built only where a run can be. In a run with ``least`` >= 24 and
``exponent`` >= 3 every 8-word window has an equal one a period away within
the run, so runs lie inside blocks of consecutive windows that recur nearby
within their block; blocks shrink until that holds for each of their windows.
The test never loses a run; a hash collision only builds a tree too many. Words
of a block are compared as they are, not by hash.

A word is dropped if any run contains it after that run's first period; the
words kept, joined by one space, are the collapsed text.

Memory follows the text, and about 600 bytes a word of the longest block; rows
need no shuffle, so a lost executor costs its tasks alone.

Cases: a null or blank text has no words, no runs and an empty collapsed text.
Repeated rows and ids are treated each by its own text; a null doc_id is kept.
Runs of equal exponent go by start, then period. Extra columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import slices, table

LEAST, EXPONENT, WINDOW = 24, 3, 8
_ODD = tc.U64(0x9FB21C651E98DF25)


def suffix_tree(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Ukkonen's tree of ``s``, whose last symbol is unique: (children, edge starts, edge stops, width).

    Node 0 is the root; ``children[node * width + symbol]`` is the child whose
    edge, the stretch from its start to its stop, begins with ``symbol``.
    """
    n, width = len(s), max(s) + 1
    children: dict[int, int] = {}
    start, stop, link = [0], [0], [0]
    node = edge = length = pending = 0
    for i, symbol in enumerate(s):
        pending += 1
        fresh = 0  # the inner node made last, which waits for its suffix link
        while pending:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = children.get(key)
            if child is None:
                children[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                span = stop[child] - start[child]
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                middle = start[child] + length
                if s[middle] == symbol:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                start += (start[child], i)
                stop += (middle, n)
                link += (0, 0)
                children[key] = inner
                children[inner * width + symbol] = inner + 1
                children[inner * width + s[middle]] = child
                start[child] = middle
                if fresh:
                    link[fresh] = inner
                fresh = inner
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return children, start, stop, width


class Extensions:
    """Longest common extensions of a sequence of symbols from 1 on, and the ranks of its suffixes."""

    def __init__(self, symbols: list[int]):
        self.n = len(symbols)
        children, start, stop, width = suffix_tree([*symbols, 0])
        keys = np.fromiter(children.keys(), np.int64, len(children))
        self._kids = np.fromiter(children.values(), np.int64, len(children))
        self._parent, self._symbol = keys // width, keys % width
        self._length = np.subtract(stop, start)
        del children, start, stop
        leaves, low = self._tour(self._symbol)
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[leaves] = np.arange(self.n + 1)
        levels = [np.array(low, np.int32)]
        while 1 << len(levels) <= self.n:
            half = 1 << (len(levels) - 1)
            upper = levels[-1].copy()
            np.minimum(upper[:-half], levels[-1][half:], out=upper[:-half])
            levels.append(upper)
        self._minima = np.stack(levels)

    def reversed_rank(self) -> np.ndarray:
        """Ranks of the suffixes when symbols are ordered the other way; the end still comes first."""
        leaves, _ = self._tour(np.where(self._symbol == 0, 0, self._symbol.max() + 1 - self._symbol))
        rank = np.empty(self.n + 1, np.int64)
        rank[leaves] = np.arange(self.n + 1)
        return rank

    def _tour(self, order: np.ndarray) -> tuple[list[int], list[int]]:
        """Suffixes by leaf, and the lowest depth that the tour passes before each leaf."""
        by = np.lexsort((order, self._parent))
        kids = self._kids[by].tolist()
        first = np.searchsorted(self._parent[by], np.arange(len(self._length) + 1)).tolist()
        length, whole = self._length.tolist(), self.n + 1
        leaves, low = [], []
        todo = [(0, 0, 0)]
        while todo:
            node, depth, turn = todo.pop()
            a, b = first[node], first[node + 1]
            if a == b:
                leaves.append(whole - depth)
                low.append(turn)
                continue
            for k in range(b - 1, a, -1):
                kid = kids[k]
                todo.append((kid, depth + length[kid], depth))
            kid = kids[a]
            todo.append((kid, depth + length[kid], turn))
        return leaves, low

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from positions ``i`` and ``j`` on (i != j, both at most n)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        return np.minimum(self._minima[level, a], self._minima[level, b - (1 << level)]).astype(np.int64)


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each position the next one with a smaller rank: the end of its longest Lyndon word."""
    r = rank.tolist()
    n = len(r) - 1
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, mine = i + 1, r[i]
        while j < n and r[j] > mine:
            j = out[j]
        out[i] = j
    return np.array(out, np.int64)


def find_runs(words: list, least: int = 2, exponent: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of hashable words, by start, then period."""
    if len(words) < 2:
        return []
    name: dict = {}
    symbols = [name.setdefault(w, len(name) + 1) for w in words]
    n = len(symbols)
    ahead, behind = Extensions(symbols), Extensions(symbols[::-1])
    at = np.arange(n)
    found = []
    for rank in (ahead.rank, ahead.reversed_rank()):
        after = next_smaller(rank)
        period = after - at
        right = ahead.common(at, after)
        left = behind.common(n - at, n - after)
        length = period + left + right
        keep = length >= np.maximum(least, exponent * period)
        found.append(np.stack([at[keep] - left[keep], period[keep], length[keep]], 1))
    return [(s, x, p) for s, p, x in np.unique(np.concatenate(found), axis=0).tolist()]


def recurring_blocks(codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [first, last) of word positions, within rows, that hold every run of LEAST words and EXPONENT periods."""
    m = len(codes) - WINDOW + 1
    if m < 1:
        return []
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.flatnonzero((row[:m] == row[WINDOW - 1:]) & (sizes[row[:m]] >= LEAST))
    window = np.zeros(len(at), tc.U64)
    for k in range(WINDOW):
        window = window * _ODD + codes[at + k]
    group, words = row[at], sizes[row[at]]
    while len(at):
        key = tc.mix(window + group.astype(tc.U64) * tc._GOLDEN)
        order = np.argsort(key, kind="stable")
        near = (key[order][1:] == key[order][:-1]) & (EXPONENT * np.diff(at[order]) <= words[order][1:])
        recurs = np.zeros(len(at), bool)
        recurs[order[1:][near]] = True
        recurs[order[:-1][near]] = True
        kept, old = at[recurs], group[recurs]
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) != 1) | (np.diff(old) != 0)
        block = np.cumsum(new) - 1
        size = np.bincount(block) + WINDOW - 1 if len(kept) else np.empty(0, np.int64)
        long = size[block] >= LEAST
        if len(kept) == len(at) and long.all():
            first = at[new]
            return list(zip(first.tolist(), (first + size).tolist()))
        at, group, words, window = kept[long], block[long], size[block][long], window[recurs][long]
    return []


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_COLLAPSED = "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string"


def collapse(documents: DataFrame) -> DataFrame:
    """(doc_id, runs, text): each row's runs of at least 24 words and 3 periods, and its text without their repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 21):
            codes, bounds, *_ = tc.words(*tc.utf8(b.column(1)), lower=False)
            blocks: dict[int, list[tuple[int, int]]] = {}
            for first, last in recurring_blocks(codes, bounds):
                r = int(np.searchsorted(bounds, first, "right")) - 1
                blocks.setdefault(r, []).append((first - int(bounds[r]), last - int(bounds[r])))
            runs, texts = [], []
            for r, raw in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                words = (raw or b"").split()  # splits at the bytes 0x20 and 0x09-0x0D
                found = [(first + s, x, p) for first, last in blocks.get(r, ()) for s, x, p in find_runs(words[first:last], LEAST, EXPONENT)]
                if found:
                    drop = np.zeros(len(words) + 1, np.int64)
                    for s, x, p in found:
                        drop[s + p] += 1
                        drop[s + x] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
                runs.append([dict(zip(("start", "length", "period"), f)) for f in sorted(found, key=lambda f: (f[0], f[2]))])
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(runs, pa.list_(_RUN)), pa.array(texts, pa.binary()).cast(pa.string())],
                                             ["doc_id", "runs", "text"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _COLLAPSED)


def with_repeated_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the ids, told by checksum, have their words from ``a`` on repeated with period ``p``.

    Other texts, blank ones and those of a null doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
            .withColumn("n", F.when(F.size("w") > 0, F.size("w")))
            .withColumn("a", F.col("g") % F.col("n"))
            .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    repeated = F.array_join(F.transform("w", lambda _, i: F.get("w", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its strongest run, and digests of all runs and of the collapsed text."""
    got = collapse(with_repeated_tails(table(spark, sf_dir, "documents")))
    # exponents are compared exactly: crossed products of whole numbers
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                       lambda b, r: F.when(b.isNull() | (r.length * b.period > b.length * r.period), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string"))), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return (got.withColumn("b", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "b.start", "b.length", "b.period",
                    F.expr("b.length * 1000 div b.period").alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256")))
