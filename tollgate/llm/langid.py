"""Hierarchical language identification: family first, then one-versus-one SVMs.

Features: hashed byte trigrams of the text, ASCII lower-cased, ASCII signs and
digits counted as spaces (other signs are bytes like any); relative counts, square-rooted and scaled
to unit length. Linear support vector machines (averaged Pegasos steps on the
hinge loss, in numpy) decide: one against the rest for each family, then for
each pair of languages within a family; a family's languages are ranked by
won duels, then by the sum of margins.

Families: the table below groups common languages; a learned value that it
does not name is a family of its own.

Bounds (parameters): every lang value is learned. Training takes about
``per_language`` rows of each with texts up to ``max_chars`` characters, fewer
of each once there are more than 20 values (12,000 rows in all); prediction reads every whole text.
The model holds (families + pairs) x 2**14 numbers, 64 KB each, and is
broadcast: values that the table does not name are families of their own and
make no pairs.

Cases: a null text, an empty text or one without a letter (general category L)
is ``und`` with score 0. Rows with null lang are not learned from but are
predicted. A null doc_id is in no fold: its row is not learned from, its
``held_out`` is null, its prediction is made. With a single learned language
every text with letters gets it with score 1; with none, ``und``. Repeated rows
are predicted each. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import slices, table
from tollgate.llm.sampling import bounded_sample, fold

BITS, SAMPLE_ROWS = 14, 12_000
#: Families of common language codes.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ur", "ne"),
    "sinitic": ("zh", "yue"),
}
_FAMILY = {lang: f for f, langs in FAMILIES.items() for lang in langs}
_MAP = np.full(256, 0x20, np.uint8)
_MAP[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_MAP[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_MAP[0x80:] = np.arange(0x80, 0x100)
_PLAIN_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether a character of general category L is there; numerals such as fractions and circled digits are none."""
    return _PLAIN_LETTER.search(text) is not None or any(category(c)[0] == "L" for c in text)


def family(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].lower(), lang)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram ids, row bounds) of texts padded with one space at either end."""
    texts = pc.fill_null(texts, "")
    raw, off = tc.utf8(pc.binary_join_element_wise(" ", texts, " ", ""))
    b = _MAP[raw].astype(np.uint32)
    code = b[:-2] | (b[1:-1] << 8) | (b[2:] << 16) if len(b) > 2 else np.empty(0, np.uint32)
    ids = ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)
    blank = code == 0x202020
    row_end = np.zeros(len(b), bool)
    row_end[off[1:] - 1] = True
    row_end[np.maximum(off[1:] - 2, 0)] = True
    live = ~(blank | row_end[:len(code)])
    kept = np.concatenate(([0], np.cumsum(live)))
    return ids[live], kept[np.minimum(off, len(code))]


def _matrix(texts: pa.Array) -> np.ndarray:
    ids, bounds = trigrams(texts)
    out = np.zeros((len(bounds) - 1, 1 << BITS), np.float32)
    for i in range(len(out)):
        c = np.sqrt(np.bincount(ids[bounds[i]:bounds[i + 1]], minlength=1 << BITS))
        out[i] = c / max(np.linalg.norm(c), 1e-9)
    return out


def svm(x: np.ndarray, y: np.ndarray, epochs: int = 12, reg: float = 1e-4, seed: int = 3, batch: int = 16) -> np.ndarray:
    """Averaged Pegasos: weights, the bias last; a row for each column of ``y`` (rows, problems) of signs.

    All problems of one call see the same mini-batches, so a step is two
    matrix products, however many problems there are.
    """
    rng = np.random.default_rng(seed)
    w, total, t = np.zeros((y.shape[1], x.shape[1] + 1)), np.zeros((y.shape[1], x.shape[1] + 1)), 0
    up = (y > 0).mean(0)
    balance = np.where(y > 0, 0.5 / np.maximum(up, 1e-6), 0.5 / np.maximum((y < 0).mean(0), 1e-6))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            b = order[i:i + batch]
            t += 1
            rate = 1 / (reg * (t + 1000))
            bad = y[b] * (x[b] @ w[:, :-1].T + w[:, -1]) < 1
            g = balance[b] * y[b] * bad
            w[:, :-1] *= 1 - rate * reg
            w[:, :-1] += rate / len(b) * (g.T @ x[b])
            w[:, -1] += 0.01 * rate / len(b) * g.sum(0)
            total += w
    return total / max(t, 1)


class Model:
    def __init__(self, languages: list[str], weights: dict):
        self.languages = languages
        self.families = sorted({family(x) for x in languages})
        self.names = list(weights)
        self.weights = np.stack([weights[k] for k in self.names], 1).astype(np.float32) if weights else np.zeros(((1 << BITS) + 1, 0), np.float32)

    def margins(self, texts: pa.Array) -> np.ndarray:
        ids, bounds = trigrams(texts)
        rows = len(bounds) - 1
        out = np.zeros((rows, len(self.names)))
        for i in range(rows):
            u, c = _counts(ids[bounds[i]:bounds[i + 1]])
            c = np.sqrt(c)
            out[i] = (c @ self.weights[u]) / max(np.linalg.norm(c), 1e-9) + self.weights[-1]
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        letters = np.array([bool(t) and has_letter(t) for t in texts.to_pylist()], bool)
        if not self.languages:
            return ["und"] * n, np.zeros(n)
        m = self.margins(texts)
        at = {k: m[:, i] for i, k in enumerate(self.names)}
        sure = lambda x: 1 / (1 + np.exp(-np.clip(2 * x, -50, 50)))
        fam = np.stack([at.get(("family", f), np.full(n, 9.0)) for f in self.families], 1)
        best = fam.argmax(1)
        other = np.partition(fam, -2, 1)[:, -2] if fam.shape[1] > 1 else np.full(n, -9.0)
        score = sure((fam.max(1) - other) / 2)
        lang = np.empty(n, object)
        for k, f in enumerate(self.families):
            members = [x for x in self.languages if family(x) == f]
            wins, margin = np.zeros((n, len(members))), np.zeros((n, len(members)))
            for (i, a), (j, b) in combinations(list(enumerate(members)), 2):
                d = at[("pair", a, b)]
                wins[:, i] += d >= 0
                wins[:, j] += d < 0
                margin[:, i] += d
                margin[:, j] -= d
            first = (wins + 1e-3 * np.tanh(margin)).argmax(1)
            here = best == k
            lang[here] = np.array(members, object)[first[here]]
            if len(members) > 1:
                score[here] *= sure(margin[np.arange(n), first] / (len(members) - 1))[here]
        lang[~letters], score[~letters] = "und", 0.0
        return lang.tolist(), score


def _counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4000:
        c = np.bincount(ids, minlength=1 << BITS)
        u = np.flatnonzero(c)
        return u, c[u].astype(np.float32)
    u, c = np.unique(ids, return_counts=True)
    return u, c.astype(np.float32)


def train(texts: list[str], langs: list[str]) -> Model:
    languages = sorted(set(langs))
    if not languages:
        return Model([], {})
    x, lang = _matrix(pa.array(texts, pa.string())), np.array(langs, object)
    fam = np.array([family(v) for v in langs], object)
    families, weights = sorted(set(fam)), {}
    if len(families) > 1:
        for f, w in zip(families, svm(x, np.where(fam[:, None] == np.array(families, object), 1.0, -1.0))):
            weights[("family", f)] = w
    for f in families:
        for a, b in combinations([v for v in languages if family(v) == f], 2):
            m = (lang == a) | (lang == b)
            weights[("pair", a, b)] = svm(x[m], np.where(lang[m] == a, 1.0, -1.0)[:, None])[0]
    return Model(languages, weights)


def fit(documents: DataFrame, per_language: int = 600, max_chars: int = 20_000) -> Model:
    """Train on a bounded sample of rows whose crc32 fold of 5 is not 0."""
    known = (documents.select("doc_id", "text", "lang")
             .where((fold("doc_id", 5) != 0) & F.col("lang").isNotNull() & (F.length("text") <= max_chars) & F.col("text").rlike(r"\p{L}")))
    rows = sorted(bounded_sample(known, "lang", "doc_id", per_language, total=SAMPLE_ROWS).collect(), key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Rows of ``documents`` (doc_id, text) with ``lang_pred`` and ``score``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lang, score = shared.value.predict(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, held_out, lang_pred, score."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", "lang")
    model = fit(documents)
    return predict(documents, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
