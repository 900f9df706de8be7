"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of three hashed embeddings: of the word and of its first
five and seven bytes. Filters of several widths slide over the words; each
filter is max-pooled over the whole text and over blocks of words (the blocks'
maxima are averaged, which tells one stray hit in a long text from many). A
logistic layer reads both poolings. Thresholds are calibrated for each
language group on a part of the sample kept from training; the group is told
from the text's own letters, and scores are rescaled so that every group's
threshold stands at 0.3.

Bounds (parameters): the sample takes about ``per_class`` labelled rows of
each class, of texts up to ``max_chars`` characters; scoring reads every whole
text. The model has a fixed size (under 6 MB) and is broadcast.

Cases: null and empty texts have no words and get the score of the bias alone
(below the threshold). Null labels are not learned from; of repeated labels
of one document the largest counts. Repeated documents are scored each. With
no labelled row of one class every score is that of an untrained model, below
the threshold. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import slices, table
from tollgate.llm.sampling import bounded_sample, fold

BITS, DIM, WIDTHS, FILTERS, BLOCK = 16, 12, (1, 2, 3), 8, 16
THRESHOLD = 0.3
GROUPS = ("en", "de", "fr", "es")
#: Second UTF-8 bytes, after 0xC3, of letters that mark a group.
MARKS = {"de": (0x9F, 0xA4, 0xB6, 0xBC, 0x84, 0x96, 0x9C), "fr": (0xA9, 0xA8, 0xAA, 0xA7, 0xA0, 0x89, 0x88), "es": (0xB1, 0xB3, 0xA1, 0xAD, 0xBA)}


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket ids (words, 3), row bounds, language group of each row)."""
    raw, off = tc.utf8(texts)
    codes, bounds, starts, ends = tc.words(raw, off)
    five = tc.span_codes(raw, starts, np.minimum(starts + 5, ends), True) + tc.U64(1)
    seven = tc.span_codes(raw, starts, np.minimum(starts + 7, ends), True) + tc.U64(2)
    ids = np.stack([(tc.mix(c) >> tc.U64(64 - BITS)).astype(np.int32) for c in (codes, five, seven)], 1)
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) else np.empty(0, np.int64)
    second = raw[lead + 1] if len(lead) else np.empty(0, np.uint8)
    at = np.searchsorted(off, lead, "right") - 1
    votes = np.zeros((len(off) - 1, len(GROUPS)))
    votes[:, 0] = np.diff(off) / 200
    for g, marks in MARKS.items():
        votes[:, GROUPS.index(g)] = np.bincount(at[np.isin(second, marks)], minlength=len(off) - 1)
    return ids, bounds, votes.argmax(1)


def _blocks(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each block, row of each block); rows without words have none."""
    n = -(-np.diff(bounds) // BLOCK)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return bounds[:-1][row] + at * BLOCK, row


class Model:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.emb = rng.normal(0, 0.05, (1 << BITS, DIM)).astype(np.float32)
        self.conv = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.cbias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, 2 * FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(-2.0)
        self.cut = np.full(len(GROUPS), 0.5)

    def activations(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(words, filters of all widths); windows stay within a row, missing words are zero."""
        n = len(x)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        parts = []
        for w, k, b in zip(WIDTHS, self.conv, self.cbias):
            a = x @ k[0]
            for j in range(1, w):
                same = row[j:] == row[:n - j]
                a[:n - j] += (x[j:] @ k[j]) * same[:, None]
            parts.append(np.maximum(a + b, 0))
        return np.concatenate(parts, 1)

    def pooled(self, act: np.ndarray, bounds: np.ndarray):
        rows, f = len(bounds) - 1, FILTERS * len(WIDTHS)
        first, row = _blocks(bounds)
        top, mean = np.zeros((rows, f), np.float32), np.zeros((rows, f), np.float32)
        best = np.zeros((0, f), np.float32)
        if len(first):
            best = np.maximum.reduceat(act, first, axis=0)
            has = np.flatnonzero(np.diff(bounds) > 0)
            begin = np.searchsorted(row, has)
            top[has] = np.maximum.reduceat(best, begin, axis=0)
            mean[has] = np.add.reduceat(best, begin, axis=0) / np.bincount(row, minlength=rows)[has][:, None]
        return top, mean, best, first, row

    def raw(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        x = self.emb[ids[:, 0]] + self.emb[ids[:, 1]] + self.emb[ids[:, 2]]
        top, mean, *_ = self.pooled(self.activations(x, bounds), bounds)
        return 1 / (1 + np.exp(-(np.concatenate([top, mean], 1) @ self.out + self.bias)))

    def score(self, texts: pa.Array) -> np.ndarray:
        ids, bounds, group = features(texts)
        p, cut = self.raw(ids, bounds).astype(np.float64), self.cut[group]
        return np.where(p < cut, THRESHOLD * p / cut, THRESHOLD + (1 - THRESHOLD) * (p - cut) / (1 - cut))

    def step(self, ids, bounds, y, weight, rate, state) -> None:
        """One Adagrad step on a mini-batch."""
        x = self.emb[ids[:, 0]] + self.emb[ids[:, 1]] + self.emb[ids[:, 2]]
        act = self.activations(x, bounds)
        top, mean, best, first, row = self.pooled(act, bounds)
        both = np.concatenate([top, mean], 1)
        p = 1 / (1 + np.exp(-(both @ self.out + self.bias)))
        g = ((p - y) * weight / len(y)).astype(np.float32)
        f = top.shape[1]
        blocks = np.maximum(np.bincount(row, minlength=len(y)), 1)
        to_block = g[row][:, None] * (self.out[f:] / blocks[row][:, None] + self.out[:f] * (best == top[row]))
        size = np.diff(np.append(first, len(x)))
        hit = (act == np.repeat(best, size, 0)) & (act > 0)
        d = np.where(hit, np.repeat(to_block, size, 0), 0).astype(np.float32)
        words = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        dx, n = np.zeros_like(x), len(x)

        def ada(name, param, grad):
            s = state.setdefault(name, np.full_like(param, 1e-3))
            s += grad * grad
            param -= rate * grad / np.sqrt(s)

        new = []
        for i, (w, k) in enumerate(zip(WIDTHS, self.conv)):
            di = d[:, i * FILTERS:(i + 1) * FILTERS]
            gk = np.zeros_like(k)
            for j in range(w):
                dj = di[:n - j] if j == 0 else di[:n - j] * (words[j:] == words[:n - j])[:, None]
                gk[j] = x[j:].T @ dj
                dx[j:] += dj @ k[j].T
            new.append((gk, di.sum(0)))
        for i, (gk, gb) in enumerate(new):
            ada(f"k{i}", self.conv[i], gk)
            ada(f"b{i}", self.cbias[i], gb)
        ada("out", self.out, both.T @ g + 1e-4 * self.out)
        s = state["bias"] = state.get("bias", 1e-3) + float(g.sum()) ** 2
        self.bias = np.float32(self.bias - rate * g.sum() / np.sqrt(s))
        live = np.flatnonzero(np.abs(dx).sum(1) > 0)
        flat, grad = ids[live].ravel(), np.repeat(dx[live], 3, 0)
        order = np.argsort(flat, kind="stable")
        u, begin = np.unique(flat[order], return_index=True)
        if len(u):
            total = np.add.reduceat(grad[order], begin, axis=0) * self.seen[u][:, None]
            s = state.setdefault("emb", np.full(len(self.emb), 1e-3, np.float32))
            s[u] += (total * total).mean(1)
            self.emb[u] -= rate * total / np.sqrt(s[u])[:, None]


def train(texts: list[str], y: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 0.08, least: int = 4, seed: int = 5) -> Model:
    """Fit on four fifths of the sample, calibrate thresholds on the rest.

    Buckets seen in fewer than ``least`` texts keep a zero embedding, so words
    the sample hardly knows say nothing.
    """
    model = Model(seed)
    rng = np.random.default_rng(seed)
    data = [features(pa.array([t])) for t in texts]
    seen = np.zeros(1 << BITS, np.int64)
    for ids, _, _ in data:
        seen[np.unique(ids)] += 1
    model.seen = (seen >= least).astype(np.float32)
    model.emb *= model.seen[:, None]
    if len(texts) == 0 or y.min() == y.max():
        model.out[:] = 0
        return model
    part = rng.random(len(texts)) < 0.8
    fit, check = np.flatnonzero(part), np.flatnonzero(~part)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
    state: dict = {}
    for _ in range(epochs):
        order = rng.permutation(fit)
        for i in range(0, len(order), batch):
            b = order[i:i + batch]
            bounds = np.concatenate(([0], np.cumsum([len(data[j][0]) for j in b])))
            model.step(np.concatenate([data[j][0] for j in b]), bounds, y[b], weight[b], rate, state)
    p = np.array([model.raw(data[j][0], data[j][1])[0] for j in check])
    group = np.array([data[j][2][0] for j in check])

    def threshold(p, t):
        grid = np.unique(np.clip(np.concatenate([p, [0.5]]), 0.02, 0.98))
        mid = (grid[1:] + grid[:-1]) / 2 if len(grid) > 1 else grid
        f1 = np.array([2 * ((p >= c) & (t == 1)).sum() / max(1, (p >= c).sum() + (t == 1).sum()) for c in mid])
        best = np.flatnonzero(f1 >= f1.max() - 1e-12)
        return float(mid[best[len(best) // 2]])

    overall = threshold(p, y[check]) if len(check) else 0.5
    for g in range(len(GROUPS)):
        m = group == g
        model.cut[g] = threshold(p[m], y[check][m]) if (y[check][m] == 1).sum() >= 5 else overall
    return model


def fit(documents: DataFrame, labels: DataFrame, per_class: int = 1800, max_chars: int = 20_000) -> Model:
    """Train on a bounded sample of the rows whose crc32 fold of 4 is not 2."""
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold("doc_id", 4) != 2)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    ids = bounded_sample(known, "toxic", "doc_id", per_class)
    rows = (documents.select("doc_id", "text").where((fold("doc_id", 4) != 2) & (F.length("text") <= max_chars))
            .join(F.broadcast(ids), "doc_id")  # ids: at most 4 * per_class rows
            .groupBy("doc_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("r")).select("doc_id", "r.text", "r.toxic").collect())
    rows.sort(key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows], np.float64))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Rows of ``documents`` (doc_id, text) with ``score``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(b.column(1)), pa.float64())], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep_clean(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns as they are, whose score is below THRESHOLD; no shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            yield b.filter(pa.array(shared.value.score(b.column(text)) < THRESHOLD))

    return documents.mapInArrow(run, documents.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, held_out, score, predicted."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    model = fit(documents, table(spark, sf_dir, "labels"))
    return (score(documents, model)
            .select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
