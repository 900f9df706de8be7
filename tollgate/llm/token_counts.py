"""Token counts of sections: offset-mapped attribution.

A document is encoded once, whole, with a public byte-level vocabulary. The
byte span of every token follows from the running sum of token lengths; the
spans are interval-joined (two binary searches over the section bounds) to the
document's sections. Both sides carry the document's key and ride in one row,
so the join needs no shuffle. Work and memory follow one text at a time.

Rule for a token that crosses a boundary: it belongs, whole, to the section
that holds most of its bytes; on a tie to the earlier one. Tokens that touch
no section count as ``outside``.

Cases: null and empty texts have no tokens; null section lists count as none.
Sections are code point intervals; they are taken by start, then end, cut at
the next one's start where they overlap and at the text's end; null or empty
ones hold nothing but keep their place. Section names may repeat. Very long
texts are encoded whole; their long runs of white space pass the vocabulary's
merge step directly (same tokens, no regular expression stack). Repeated rows
are counted each. Extra columns are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import slices, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A sentence or line ends after these; it keeps the white space that follows it.
_SENTENCE = re.compile(r"[.!?]+\s+|\n")
_LONG = re.compile(r"\s{4096,}")


class Encoder:
    def __init__(self, vocabulary: str = VOCABULARY):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            self.lengths[i] = len(piece)

    def encode(self, text: str) -> list[int]:
        out, at = [], 0
        for run in _LONG.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.bpe.encode_ordinary(text[at:run.start()])
            out += self.bpe._encode_single_piece(text[run.start():end])
            at = end
        return out + self.bpe.encode_ordinary(text[at:])


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def attribute(lengths: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(tokens of each section, crossing tokens, outside tokens).

    ``lengths``: bytes of each token; ``begin``/``end``: disjoint ascending
    byte intervals (empty ones allowed).
    """
    counts = np.zeros(len(begin), np.int64)
    stop = np.cumsum(lengths)
    start = stop - lengths
    full = np.flatnonzero(end > begin)
    if len(full) == 0 or len(lengths) == 0:
        return counts, 0, len(lengths)
    b, e = begin[full], end[full]
    first = np.searchsorted(e, start, "right")
    last = np.searchsorted(b, stop, "left") - 1
    inside = (first == last) & (b[np.minimum(first, len(b) - 1)] <= start) & (e[np.minimum(first, len(e) - 1)] >= stop)
    counts[full] += np.bincount(first[inside], minlength=len(full))
    outside = int((last < first).sum())
    crossing = np.flatnonzero((last >= first) & ~inside)
    for t in crossing:
        s = np.arange(first[t], last[t] + 1)
        held = np.minimum(e[s], stop[t]) - np.maximum(b[s], start[t])
        counts[full[s[held.argmax()]]] += 1
    return counts, len(crossing), outside


def _bytes_at(text: bytes, points: np.ndarray) -> np.ndarray:
    """Byte positions of code point positions (past the end: the end)."""
    lead = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    lead = np.append(lead, len(text))
    return lead[np.clip(points, 0, len(lead) - 1)]


SCHEMA = "doc_id long, n_tokens long, crossing long, outside long, sections array<struct<name:string,start:long,end:long,tokens:long>>"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("crossing", pa.int64()), ("outside", pa.int64()),
                  ("sections", pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("tokens", pa.int64())])))])


def _disjoint(sections: list, length: int) -> tuple[list, np.ndarray, np.ndarray]:
    whole = [s for s in sections or [] if s is not None]
    whole.sort(key=lambda s: (s["start"] is None, s["start"] or 0, s["end"] or 0))
    begin = np.array([min(max(s["start"], 0), length) if s["start"] is not None and s["end"] is not None else length for s in whole], np.int64)
    end = np.array([min(max(s["end"], 0), length) if s["start"] is not None and s["end"] is not None else length for s in whole], np.int64)
    end = np.maximum(np.minimum(end, np.append(begin[1:], length)), begin)
    return whole, begin, end


def count(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (doc_id, text, sections) with their tokens attributed to ``sections``.

    ``sections``: array<struct<name, start, end>>; without the column the
    sections are the text's sentences, with the white space that follows
    them, named by number.
    """
    own = "sections" not in documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in slices(batches, "text"):
            rows = []
            given = [None] * b.num_rows if own else b.column(2).to_pylist()
            for key, text, sections in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), given):
                text = text or ""
                raw = text.encode()
                lengths = enc.lengths[enc.encode(text)] if text else np.empty(0, np.int64)
                if own:
                    cut = [m.end() for m in _SENTENCE.finditer(text)]
                    cut = [0, *cut, *([len(text)] if not cut or cut[-1] < len(text) else [])] if text else [0]
                    begin, end = np.array(cut[:-1], np.int64), np.array(cut[1:], np.int64)
                    names = [str(i) for i in range(len(begin))]
                else:
                    whole, begin, end = _disjoint(sections, len(text))
                    names = [s["name"] for s in whole]
                held, crossing, outside = attribute(lengths, _bytes_at(raw, begin), _bytes_at(raw, end))
                rows.append({"doc_id": key, "n_tokens": len(lengths), "crossing": crossing, "outside": outside, "sections": [
                    {"name": n, "start": s, "end": e, "tokens": t} for n, s, e, t in zip(names, begin.tolist(), end.tolist(), held.tolist())]})
            yield pa.RecordBatch.from_pylist(rows, _OUT)

    return documents.select("doc_id", "text", *([] if own else ["sections"])).mapInArrow(run, SCHEMA)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its tokens by sentence; the digest covers all section counts in order."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    counts = F.array_join(F.transform("sections", lambda s: s.tokens.cast("string")), ",")
    return count(documents).select("doc_id", "n_tokens", "crossing", "outside", F.size("sections").cast("long").alias("n_sections"),
                                   F.coalesce(F.array_max(F.transform("sections", lambda s: s.tokens)), F.lit(0)).cast("long").alias("max_section_tokens"),
                                   F.sha2(counts.cast("binary"), 256).alias("sections_sha256"))
