"""Personal data: base patterns and information-theoretic sanitisation.

Base spans (email, ip, card, phone) are found by pattern in every whole text.
Each distinct matched string is a protected entity e. Its contexts are the
windows of ``WINDOW`` words on either side, within the text. Over the corpus,
with n(t) occurrences of a term t, n(t, e) of them inside contexts of e, n(e)
contexts and W words in all:

    p(e) = min(1, n(e) * 2 * WINDOW / W)
    p(e|t) = s * min(1, n(t, e) / n(t)) + (1 - s) * p(e),  s = n(t)**2 / (n(t)**2 + PRIOR)
    disclosure(t, e) = PMI / IC = log(p(e|t) / p(e)) / -log p(e)

1 means that t appears with e alone; 0 that it says nothing. Support is part of
the estimate: s pulls a rarely seen term towards p(e), by two thirds at its
first occurrence and by a ninth at its fourth.
A term whose disclosure reaches REMOVE is removed from e's contexts; from
GENERALISE on it is generalised to its letter shape. The thresholds are the
whole rule: a term of a single context, or of a group of copies, is judged by
its disclosure like any. Counts cover all texts; corpus counts are taken only
for terms of contexts, found again through a bitmap of fixed size (2 MB) and
joined exactly afterwards.

A row is known by its id and text together, so rows that share an id but not
the text, and rows without an id, keep their own spans and are sanitised by
them.

Cases: a null text is empty and has no spans. Repeated rows are returned each,
with the same spans. Ties of start go by kind as listed. A term that overlaps a
base span is part of it and never a term. Very long texts cost in proportion.
Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import Scratch, slices, table
from tollgate.llm.tiling import FILTER_BITS, code_bitmap

KINDS = ("email", "ip", "card", "phone", "remove", "generalise")
WINDOW, PRIOR, REMOVE, GENERALISE = 20, 2.0, 0.95, 0.8
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is taken whole whether or not the rest follows, so no run is scanned twice.
_IP = re.compile(r"[0-9]++(?:(?:\.[0-9]++){3})?+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        done = m.end() if m else at + 1
        if m:
            out.append((start, done))
        at = text.find("@", done)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(s, e, "email") for s, e in emails(text)]
    for m in _IP.finditer(text):
        if "." in m.group():
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _codes(strings: list[str]) -> np.ndarray:
    raw, off = tc.utf8(pa.array(strings, pa.string()))
    return tc.span_codes(raw, off[:-1], off[1:], True).view(np.int64)


def contexts(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[str, list[tuple[int, int]]]]:
    """(entity, term spans) of each base span: WINDOW words on either side that touch no base span."""
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [w[0] for w in words]
    out = []
    merged: list[list[int]] = []
    for s, e, _ in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    covered = [m[0] for m in merged]

    def free(w):
        i = bisect.bisect_left(covered, w[1]) - 1
        return i < 0 or merged[i][1] <= w[0]

    for s, e, kind in spans:
        first = bisect.bisect_right(starts, s) - 1
        after = bisect.bisect_left(starts, e)
        near = words[max(0, first - WINDOW):first] + words[after:after + WINDOW]
        out.append((f"{kind}:{text[s:e].lower()}", [w for w in near if free(w)]))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
_TERM = pa.struct([("code", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_CONTEXT = pa.struct([("entity", pa.int64()), ("terms", pa.list_(_TERM))])
_FOUND = "doc_id long, row binary, spans array<struct<start:long,end:long,kind:string>>, contexts array<struct<entity:long,terms:array<struct<code:long,start:long,end:long>>>>"


def row_key():
    """16 bytes that tell a row by its id and text; a null text is as an empty one."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.unhex(F.substring(F.sha2(name.cast("binary"), 256), 1, 32))


def find(documents: DataFrame) -> DataFrame:
    """(doc_id, row, spans, contexts) of each row: base spans, and the coded terms around each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            spans, held = [], []
            for text in b.column(2).to_pylist():
                got = base_spans(text) if text else []
                spans.append([{"start": s, "end": e, "kind": k} for s, e, k in got])
                rows = []
                if got:
                    ctx = contexts(text, got)
                    entity = _codes([c[0] for c in ctx])
                    flat = [w for c in ctx for w in c[1]]
                    code = _codes([text[s:e] for s, e in flat])
                    at = 0
                    for (_, terms), ent in zip(ctx, entity.tolist()):
                        mine = code[at:at + len(terms)]
                        at += len(terms)
                        rows.append({"entity": ent, "terms": [{"code": c, "start": s, "end": e} for c, (s, e) in zip(mine.tolist(), terms)]})
                held.append(rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(_SPAN)), pa.array(held, pa.list_(_CONTEXT))],
                                             ["doc_id", "row", "spans", "contexts"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", row_key().alias("row"), "text").mapInArrow(run, _FOUND)


def term_counts(documents: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(code, n) of the words that the bitmap lets pass, and code null: all words; summed within tasks first."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, size, words = shared.value, [], 0, 0

        def merged():
            c, n = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            u, at = np.unique(c, return_inverse=True)
            return u, np.bincount(at, n).astype(np.int64)

        for b in slices(batches, "text"):
            codes, *_ = tc.words(*tc.utf8(b.column(0)))
            words += len(codes)
            bit = (codes & tc.U64((1 << FILTER_BITS) - 1)).astype(np.int64)
            codes = codes[((bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1) == 1]
            held.append(np.unique(codes, return_counts=True))
            size += len(held[-1][0])
            if size > 1_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], ["code", "n"])
                    held, size = [], 0
        if held:
            c, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)), pa.array(n)], ["code", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([words], pa.int64())], ["code", "n"])

    return documents.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def disclosing_terms(documents: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(entity, code, disclosure, kind) of the terms that reveal an entity."""
    context = found.select(F.explode("contexts").alias("c")).select("c.entity", "c.terms")
    entities = scratch.keep(context.groupBy("entity").agg(F.count("*").alias("n_e")))  # written: a hot entity's pairs can then be split
    pairs = context.select("entity", F.explode("terms.code").alias("code")).groupBy("entity", "code").agg(F.count("*").alias("n_te"))
    pairs = scratch.keep(pairs.join(entities, "entity"))
    counts = scratch.keep(term_counts(documents, code_bitmap(pairs.select("code"))))
    total = counts.where("code IS NULL").agg(F.coalesce(F.max("n"), F.lit(1)).cast("double").alias("w")).scalar()
    p_e = F.least(F.lit(1.0), F.col("n_e") * (2.0 * WINDOW) / F.col("w"))
    square = F.col("n").cast("double") * F.col("n")
    support = square / (square + PRIOR)
    p_et = support * F.least(F.lit(1.0), F.col("n_te") / F.col("n")) + (1 - support) * F.col("p_e")
    flagged = (pairs.join(counts.where("code IS NOT NULL"), "code").withColumn("w", total)
               .withColumn("p_e", p_e).where("p_e < 1")
               .withColumn("disclosure", 1 - F.log(p_et) / F.log("p_e"))
               .where(F.col("disclosure") >= GENERALISE)
               .select("entity", "code", "disclosure", F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise").alias("kind")))
    out = scratch.keep(flagged)
    scratch.drop(entities, pairs, counts)
    return out


def term_spans(found: DataFrame, flagged: DataFrame) -> DataFrame:
    """(row, terms): spans of flagged terms inside contexts of the entity they reveal."""
    at = (found.select("row", F.explode("contexts").alias("c"))
          .select("row", "c.entity", F.explode("c.terms").alias("t")).select("row", "entity", "t.code", "t.start", "t.end"))
    return (at.join(flagged, ["entity", "code"])
            .groupBy("row", "start", "end").agg(F.max("kind").alias("kind"))  # removal outranks generalisation
            .groupBy("row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("terms")))


def detect(documents: DataFrame) -> DataFrame:
    """(doc_id, row, spans, terms) of each row: base spans and term spans, structs of (start, end, kind)."""
    scratch = Scratch(documents.sparkSession)
    found = scratch.keep(find(documents))
    flagged = disclosing_terms(documents, found, scratch)
    terms = scratch.keep(term_spans(found, flagged))
    return found.join(terms, "row", "left").select("doc_id", "row", "spans", F.coalesce("terms", F.array().cast("array<struct<start:long,end:long,kind:string>>")).alias("terms"))


_SHAPES = ((re.compile(r"[0-9]+"), "0"), (re.compile(r"[^\W\d_]+"), "x"))


def sanitise_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with entities named by kind, removed terms left out and generalised ones as letter shapes."""
    out, at = [], 0
    for s, e, kind in sorted(spans):
        if s < at:
            at = max(at, e) if kind in KINDS[:4] else at  # what reaches past an earlier span is as personal as the span
            continue
        out.append(text[at:s])
        if kind == "generalise":
            shape = text[s:e]
            for pattern, to in _SHAPES:
                shape = pattern.sub(to, shape)
            out.append(shape)
        elif kind != "remove":
            out.append(f"[{kind.upper()}]")
        at = e
    return "".join(out) + text[at:]


def sanitise(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with personal data and disclosing terms replaced."""
    spans = detect(documents).select("row", F.concat("spans", "terms").alias("all")).where(F.size("all") > 0).dropDuplicates(["row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = [None if t is None else sanitise_text(t, [(s["start"], s["end"], s["kind"]) for s in a or []])
                     for t, a in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    joined = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", row_key()).join(spans, "row", "left")
    return joined.select("doc_id", "text", "all").mapInArrow(run, "doc_id long, text string")


def span_string(spans):
    """kind:start:end by start, then kind as listed, comma-joined."""
    rank = F.array([F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.array_position(rank, s.kind).alias("rank"), s.end.alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(rank, s.rank.cast("int")), s.start.cast("string"), s.end.cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: counts of base spans, their digest, and all spans."""
    got = detect(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", *[number(k) for k in KINDS[:4]], F.sha2(span_string(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                      span_string(F.concat("spans", "terms")).alias("spans"), F.size("terms").cast("long").alias("n_terms"))
