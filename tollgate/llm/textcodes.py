"""Vectorised word and shingle codes: numpy over a whole Arrow batch of texts.

A batch's UTF-8 bytes are handled as one array, so no Python object is made
per word. A word's code is a 64-bit polynomial hash of its bytes (modulo
2**64, a fixed odd base, random 64-bit byte values) finished by an avalanche
mix; it is read off one running sum over the batch. Equal words have equal
codes in every task; two different words collide with a probability of the
order of 2**-58 or less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (the public splitmix64 finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values that depend on ``seed`` alone."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 32)) * _GOLDEN)


_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = stream(256, 11)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, U64(base))
        out[0] = U64(1)
        return np.multiply.accumulate(out)


_POWERS = {}


def power_table(base: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of ``base``; the tables of common batch sizes are kept."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = _powers(base, max(n, 1 << 16))
        if len(have) <= 1 << 21:
            _POWERS[base] = have
    return have


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset:]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut at row offsets."""
    n = len(inside)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < n]
    first[inner] = True
    starts = np.flatnonzero(first & inside)
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    last[inner[inner > 0] - 1] = True
    return starts, np.flatnonzero(last & inside) + 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTES_LOWER = _BYTES[_LOWER]


def is_space(raw: np.ndarray) -> np.ndarray:
    """True at the bytes 0x20 and 0x09-0x0D."""
    return (raw == 0x20) | ((raw - np.uint8(9)) <= 4)


def span_codes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit code of the bytes of each span; A-Z count as a-z if ``lower``."""
    if len(starts) == 0:
        return np.empty(0, U64)
    n = len(raw)
    running = np.empty(n + 1, U64)
    running[0] = 0
    terms = (_BYTES_LOWER if lower else _BYTES)[raw]
    terms *= power_table(_BASE, n)[:n]
    np.cumsum(terms, out=running[1:])
    code = running[ends] - running[starts]
    code *= power_table(_BASE_INVERSE, n)[starts]
    code += (ends - starts).astype(U64) * _GOLDEN
    return mix(code)


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row, A-Z lower-cased if asked.

    Returns (codes, row bounds into codes, starts, ends); starts and ends are
    byte positions in ``raw``.
    """
    starts, ends = spans(~is_space(raw), offsets)
    codes = span_codes(raw, starts, ends, lower)
    return codes, np.searchsorted(starts, offsets), starts, ends


def shingles(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ``width``-word shingles of each row, with repeats.

    A row with fewer words, but at least one, has its whole sequence as one
    shingle; a row without words has none. Returns (codes, row bounds).
    """
    n = np.diff(bounds)
    made = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out = np.concatenate(([0], np.cumsum(made)))
    row = np.repeat(np.arange(len(n)), made)
    first = bounds[:-1][row] + np.arange(out[-1]) - out[:-1][row]
    if width == 1:
        return codes[first], out
    full = n[row] >= width
    last = len(codes) - 1
    acc = np.zeros(len(first), U64)
    for i in range(width):
        part = codes[np.minimum(first + i, max(last, 0))] if len(codes) else acc
        use = full | (i < n[row])
        acc = np.where(use, mix(acc * U64(3) + part + U64((i + 1) * int(_GOLDEN) % 2**64)), acc)
    return acc, out


def row_sets(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of each row, ascending, with the new row bounds."""
    out, sizes = [], np.zeros(len(bounds) - 1, np.int64)
    for i in range(len(bounds) - 1):
        c = np.sort(codes[bounds[i]:bounds[i + 1]])
        if len(c) > 1:
            c = c[np.concatenate(([True], c[1:] != c[:-1]))]
        out.append(c)
        sizes[i] = len(c)
    return (np.concatenate(out) if out else codes[:0]), np.concatenate(([0], np.cumsum(sizes)))
