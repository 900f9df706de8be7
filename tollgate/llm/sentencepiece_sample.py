"""SentencePiece sampling without replacement: Gumbel top-k by perturbed A* search.

Lattice. A text is written with ``U+2581`` for spaces and one in front. Where no
piece of the vocabulary holds a code point and the next one side by side, no
arc passes, so the lattice falls into units between such places, of any length.
Pairs are told by the last ten bits of both code points: a pair that shares
them with a piece's is not cut, which makes a unit longer and changes no
sample. Pieces never hold a space sign after another character, so a unit ends
at a space at the latest. Arcs are the vocabulary's pieces; a code point
without a piece is written as its UTF-8 bytes. The vocabulary file has merge
ranks, no probabilities: a piece of rank r weighs 1 / (r + 2.7), a byte
``BYTE_PENALTY`` nats less than the rarest piece.

Search. The perturbed log probability of a whole segmentation is its log
probability plus Gumbel noise. Top down, a node's value is the maximum over
its subtree: the root's is a standard Gumbel (log probabilities are relative
to the lattice's total, which a backward pass gives for every distinct unit of
a batch), and a node's children get Gumbels conditioned on their maximum being
the node's value. Popping the best node of the queue and following its best
children yields the next segmentation; the siblings passed on the way join the
queue. So the first k pops are an exact sample of k distinct segmentations in
order, without replacement. The k+1-st value kappa gives each its inclusion
score 1 - exp(-exp(log p - kappa)).

Noise is a hash of (seed, row key, pop, place in the text, arc): a row's
samples are the same in every run, partitioning and batch. Units repeat within
and between batches, so a worker keeps the lattices it has built (up to
``KEPT_ARCS`` arcs and those of a batch, some 140 MB; then it starts afresh) and
builds only those of units it has not met; all walks of a batch advance
together in numpy; the few longest units are finished place by place. Long texts are walked in segments of ``SEGMENT`` to twice as
many code points; only the best k+1 queue nodes are kept. Where a segment ends
within a unit, its arcs reach over the end: they take the backward values of
the places there from the next segment, which the walk enters where the last
arc ended.

Cases: null and empty texts have one empty segmentation (log p 0, score 1). A
text with fewer than k segmentations has them all, with score 1. Texts may
hold ``U+2581`` themselves: those are written as bytes, so decoding always
returns the text exactly. Rows that repeat a key and text repeat their
samples; a null key counts as key 0. Extra columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import slices, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES, BYTE_PENALTY = 2, 10.0
BATCH_BYTES, SEGMENT = 1 << 19, 1 << 19
#: So few units are finished place by place, in blocks of so many places.
FEW, BLOCK = 32, 4096
KEPT_ARCS = 3_000_000
#: Least weight that noise is divided by.
_TINY = 1e-300
SPACE, LITERAL = 0x2581, 0x110000
_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLOT_BITS = 20
#: Neighbouring code points of pieces are told by their last ten bits.
_PAIR_BITS = 10
_LOW = (1 << _PAIR_BITS) - 1


@functools.cache
def _cp_values() -> np.ndarray:
    return tc.mix(np.arange(LITERAL + 1, dtype=np.uint64) + tc.U64(0x1234567))


def _cp_value(cp: np.ndarray) -> np.ndarray:
    return _cp_values()[cp]


class CodeIndex:
    """Numbers of distinct 64-bit codes, in the order they were added."""

    def __init__(self, codes: np.ndarray | None = None):
        self.count, self.codes, self.slots = 0, np.empty(0, np.uint64), []
        if codes is not None:
            self.add(codes)

    @staticmethod
    def _slot(codes: np.ndarray, level: int) -> np.ndarray:
        return (tc.mix(codes + tc.U64(level * 77)) >> tc.U64(64 - _SLOT_BITS)).astype(np.int64)

    def add(self, codes: np.ndarray) -> None:
        """Number codes that are not there yet; a taken slot sends a code to the next level."""
        left = np.arange(self.count, self.count + len(codes))
        self.codes = extended(self.codes, self.count, codes)
        self.count += len(codes)
        level = 0
        while len(left):
            if level == len(self.slots):
                self.slots.append(np.full(1 << _SLOT_BITS, -1, np.int32))
            at = self._slot(self.codes[left], level)
            free = np.flatnonzero(self.slots[level][at] < 0)
            self.slots[level][at[free]] = left[free]
            left = left[self.slots[level][at] != left]
            level += 1

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Number of each code, or -1."""
        if not self.slots:
            return np.full(len(codes), -1, np.int32)
        out = self.slots[0][self._slot(codes, 0)]
        bad = np.flatnonzero((self.codes[out] != codes) & (out >= 0))
        for level in range(1, len(self.slots)):
            if len(bad) == 0:
                break
            got = self.slots[level][self._slot(codes[bad], level)]
            out[bad] = got
            bad = bad[(self.codes[got] != codes[bad]) & (got >= 0)]
        out[bad] = -1
        return out


def extended(have: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """An array whose first ``n`` values are those of ``have``, followed by ``more``; room doubles when it is used up."""
    if n + len(more) > len(have):
        have = np.concatenate((have[:n], np.empty(n + len(more), have.dtype)))
    have[n:n + len(more)] = more
    return have


class Vocabulary:
    def __init__(self, path: str = VOCABULARY):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        pieces = []
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.text[i] = bytes([int(p[1:-1], 16)])
                self.byte_id[self.text[i][0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if chr(SPACE) in p.lstrip(chr(SPACE)):
                    raise ValueError("a piece holds a space sign after another character")
                self.text[i] = p.replace(chr(SPACE), " ").encode()
                pieces.append((i, p))
        weight = -np.log(np.arange(len(pieces)) + 2.7)
        weight -= np.logaddexp.reduce(weight)
        self.byte_weight = float(weight.min()) - BYTE_PENALTY
        self.longest = max(len(p) for _, p in pieces)
        self.ids = np.array([i for i, _ in pieces], np.int32)
        self.weight = weight
        # Pieces have the first numbers; the other beginnings of pieces follow.
        codes = [self._codes(p) for _, p in pieces]
        whole = dict.fromkeys(c[-1] for c in codes)
        begun = dict.fromkeys(x for c in codes for x in c)
        self.index = CodeIndex(np.array([*whole, *(x for x in begun if x not in whole)], np.uint64))
        self.joined = np.zeros(1 << 2 * _PAIR_BITS, bool)
        for _, p in pieces:
            low = np.array([ord(c) for c in p]) & _LOW
            self.joined[(low[:-1] << _PAIR_BITS) + low[1:]] = True
        self.kept = KeptUnits()
        self.size = np.array([len(t) for t in self.text])
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(self.text), np.uint8)

    @staticmethod
    def _codes(piece: str) -> list[int]:
        """Codes of the piece's beginnings, the whole piece last."""
        v = _cp_value(np.array([ord(c) for c in piece]))
        return np.cumsum(v * tc.power_table(_BASE, len(v))[:len(v)]).tolist()

    def decode(self, ids: bytes | np.ndarray) -> str:
        ids = np.frombuffer(ids, "<i4") if isinstance(ids, (bytes, memoryview)) else ids
        place, _ = ranges(self.at[ids], self.at[ids] + self.size[ids])
        return self.bytes[place].tobytes().decode()[1:]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _unit_begins(vocab: Vocabulary, cp: np.ndarray) -> np.ndarray:
    """Where units begin, by code point; the first place begins one."""
    sign, low = cp == SPACE, cp & _LOW
    begin = np.ones(len(cp), bool)
    begin[1:] = ~vocab.joined[(low[:-1] << _PAIR_BITS) + low[1:]]
    begin[1:] |= sign[1:] & ~sign[:-1]
    return begin


def _units(vocab: Vocabulary, cp: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, code) of each unit of a stretch, and the value of each code point."""
    begin = _unit_begins(vocab, cp)
    begin[breaks] = True
    start = np.flatnonzero(begin)
    size = np.diff(np.append(start, len(cp)))
    value = _cp_value(cp)
    running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * tc.power_table(_BASE, len(cp))[:len(cp)])))
    code = (running[start + size] - running[start]) * tc.power_table(_INVERSE, len(cp))[start] + size.astype(np.uint64)
    return start, size, code, value


class KeptUnits:
    """Lattices of whole units that a worker has met, by unit code."""

    def __init__(self):
        self.index, self.places, self.arcs = CodeIndex(), 0, 0
        self.head, self.ptr, self.left = np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.int32)
        self.length, self.ident, self.logq, self.q = np.empty(0, np.int16), np.empty(0, np.int32), np.empty(0), np.empty(0)

    def clear(self) -> None:
        if len(self.logq) > 3 * KEPT_ARCS:  # a very long unit came
            self.__init__()
        self.index, self.places, self.arcs = CodeIndex(), 0, 0

    def add(self, codes: np.ndarray, built: Lattice) -> None:
        """Keep units that are not there yet, one for each start of ``built``."""
        self.head = extended(self.head, self.index.count, self.places + built.head[built.unit])
        self.index.add(codes)
        self.ptr = extended(self.ptr, self.places + 1, self.arcs + built.ptr[1:])
        self.left = extended(self.left, self.places, built.left)
        self.places += len(built.left)
        for name in ("length", "ident", "logq", "q"):
            setattr(self, name, extended(getattr(self, name), self.arcs, getattr(built, name)))
        self.arcs += len(built.logq)


class Lattice:
    """Units of a stretch of written text and the arcs of each distinct one.

    ``cp``: code points; ``breaks``: places where a text begins; ``tail``: the
    backward values of the last places and the end, which belong to the stretch
    after this one and only end arcs.
    """

    def __init__(self, vocab: Vocabulary, cp: np.ndarray, breaks: np.ndarray, tail: np.ndarray | None = None):
        start, size, code, value = _units(vocab, cp, breaks)
        over = 0 if tail is None else len(tail) - 1
        if tail is not None:  # a unit that goes on is none of those that end
            code[-1] = ~code[-1]
        _, first, unit = np.unique(code, return_index=True, return_inverse=True)
        self.start, self.size, self.unit = start, size, unit
        n = size[first]
        head = np.concatenate(([0], np.cumsum(n + 1)))
        slot_unit = np.repeat(np.arange(len(n)), n + 1)
        within = np.arange(head[-1]) - head[:-1][slot_unit]
        reach = n[slot_unit] - within
        source = np.minimum(start[first][slot_unit] + within, len(cp) - 1)
        points = np.where(reach > 0, cp[source], 0)
        v = np.where(reach > 0, value[source], 0)
        self.left = np.where(slot_unit == unit[-1], np.maximum(reach - over, 0), reach) if over else reach
        total = len(points)
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v * tc.power_table(_BASE, total)[:total])))
        back = tc.power_table(_INVERSE, total)
        found_, degree = [], np.zeros(total, np.int64)
        pieces = len(vocab.ids)
        at = np.flatnonzero(self.left > 0)
        for k in range(1, vocab.longest + 1):
            at = at[reach[at] >= k]
            if len(at) == 0:
                break
            found = vocab.index.find((run[at + k] - run[at]) * back[at])
            if k == 1:
                found[points[at] == LITERAL] = -1
                none = at[(found < 0) | (found >= pieces)]
                width = 1 + (points[none] >= 0x80) + (points[none] >= 0x800) + ((points[none] >= 0x10000) & (points[none] != LITERAL))
                found_.append((none, 1, degree[none], -1 - points[none], vocab.byte_weight * width))
                degree[none] = 1
            begun = found >= 0  # other places begin no longer piece
            at, found = at[begun], found[begun]
            ok = found < pieces
            src, number = at[ok], found[ok]
            found_.append((src, k, degree[src], vocab.ids[number], vocab.weight[number]))
            degree[src] += 1
        self.ptr = np.concatenate((np.zeros(1, np.int64), np.cumsum(degree)))
        arcs = int(self.ptr[-1])
        src, weight = np.repeat(np.arange(total), degree), np.empty(arcs)
        self.length, self.ident = np.empty(arcs, np.int64), np.empty(arcs, np.int64)
        for from_, k, rank, ident, w in found_:
            to = self.ptr[from_] + rank
            self.length[to], self.ident[to], weight[to] = k, ident, w
        self.src = src
        self.head = head[:-1]
        # Backward pass: places by what is left of their unit, all units at once; the few longest place by place.
        beta = np.zeros(total)
        if over:
            end = head[unit[-1]] + size[-1]
            beta[end - over:end + 1] = tail
        places = np.flatnonzero(self.left > 0)
        places = places[np.argsort(self.left[places], kind="stable")]
        cuts = np.searchsorted(self.left[places], np.arange(1, int(self.left.max()) + 2))
        many = int(np.searchsorted(-np.diff(cuts), -FEW, "right")) if len(cuts) > BLOCK // 8 else len(cuts) - 1
        for a, b in zip(cuts[:many], cuts[1:many + 1]):
            p = places[a:b]
            arcs, begin_ = ranges(self.ptr[p], self.ptr[p + 1])
            x = weight[arcs] + beta[src[arcs] + self.length[arcs]]
            top = np.maximum.reduceat(x, begin_)
            deg = self.ptr[p + 1] - self.ptr[p]
            beta[p] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, deg)), begin_))
        if cuts[many] < len(places):
            known = beta.tolist()
            for a in range(int(cuts[many]), len(places), BLOCK):
                p = places[a:a + BLOCK]
                arcs, begin_ = ranges(self.ptr[p], self.ptr[p + 1])
                w, to, stop = weight[arcs].tolist(), (src[arcs] + self.length[arcs]).tolist(), np.append(begin_, len(arcs)).tolist()
                for i, at in enumerate(p.tolist()):
                    x = [w[j] + known[to[j]] for j in range(stop[i], stop[i + 1])]
                    top = max(x)
                    known[at] = top + math.log(sum([math.exp(y - top) for y in x]))
            beta = np.array(known)
        # What the stretch before needs, relative to the first place.
        self.ahead = beta[head[unit[0]]:][:min(vocab.longest - 1, int(size[0])) + 1] - beta[head[unit[0]]]
        self.logq = weight + beta[src + self.length] - beta[src]
        self.q = np.maximum(np.exp(self.logq), _TINY)


def kept_lattice(vocab: Vocabulary, cp: np.ndarray, breaks: np.ndarray) -> Lattice:
    """The lattice of whole texts; only units that the worker has not met are built."""
    start, size, code, _ = _units(vocab, cp, breaks)
    kept = vocab.kept
    if kept.arcs > KEPT_ARCS:
        kept.clear()
    number = kept.index.find(code)
    new = np.flatnonzero(number < 0)
    if len(new):
        codes, first = np.unique(code[new], return_index=True)
        first = new[first]
        place, begin = ranges(start[first], start[first] + size[first])
        kept.add(codes, Lattice(vocab, cp[place], begin))
        number[new] = kept.index.find(code[new])
    out = Lattice.__new__(Lattice)
    out.start, out.size, out.unit = start, size, number
    out.head, out.ptr, out.left, out.length, out.ident, out.logq, out.q = kept.head, kept.ptr, kept.left, kept.length, kept.ident, kept.logq, kept.q
    return out


def ranges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated ranges [a, b) and where each begins."""
    n = b - a
    begin = np.cumsum(n) - n
    return np.repeat(a - begin, n) + np.arange(n.sum()), begin


def _counter(place: np.ndarray) -> np.ndarray:
    return place.astype(np.uint64) * tc.U64(64 * 0x9E3779B97F4A7C15 % 2**64)


def exponential(key: np.ndarray, counter: np.ndarray) -> np.ndarray:
    h = tc.mix(key + counter.astype(np.uint64) * tc.U64(0x9E3779B97F4A7C15))
    h >>= tc.U64(11)
    x = h.astype(np.float64)
    x += 0.5
    x *= 2.0**-53
    return np.negative(np.log(x, out=x), out=x)


def gumbel(key: np.ndarray, counter: np.ndarray) -> np.ndarray:
    return -np.log(exponential(key, counter))


def walk(lat: Lattice, units: np.ndarray, offset: np.ndarray, doc: np.ndarray, key: np.ndarray, origin: np.ndarray,
         g: np.ndarray, phi: np.ndarray, keep: int):
    """Follow the best children from the given places to the end of every unit.

    units: occurrences to walk, in text order; offset: place within the unit at
    which each begins; doc: its document. key, g, phi by document: noise key,
    value and log probability of the node walked from; origin: what turns a
    place of the stretch into one of the document, by document.

    Returns the steps in text order (document, place, arc), phi at the end by
    document, and the best ``keep`` siblings of each document as
    (value, place, arc, phi).
    """
    ndoc = len(g)
    live = np.arange(len(units))
    at = lat.head[lat.unit[units]] + offset
    shift = origin[doc] + lat.start[units] - lat.head[lat.unit[units]]
    open_ = lat.left[at] > 0
    live, at = live[open_], at[open_]
    noise = key[doc] + _counter(shift)
    who, where, arc, turn, gap = [], [], [], [], []

    def choose(live: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best arc at each place (the greatest logq + Gumbel is the least exponential / q) and the next one's distance."""
        first, mark = lat.ptr[at], noise[live] + _counter(at)
        count = lat.ptr[at + 1] - first
        least = exponential(mark, lat.length[first])
        least /= lat.q[first]
        pick, second = first.copy(), np.full(len(at), np.inf)
        j, some = 1, np.flatnonzero(count > 1)
        while len(some):
            arcs = first[some] + j
            x = exponential(mark[some], lat.length[arcs])
            x /= lat.q[arcs]
            have = least[some]
            second[some] = np.minimum(second[some], np.maximum(x, have))
            better = x < have  # a tie: the shortest piece
            won = some[better]
            least[won], pick[won] = x[better], arcs[better]
            j += 1
            some = some[count[some] > j]
        return pick, second - least

    while len(live) > FEW or len(live) and lat.left[at].max() <= BLOCK // 8:
        pick, behind = choose(live, at)
        gap.append(behind)
        turn.append(len(who))
        who.append(live)
        where.append(at)
        arc.append(pick)
        at = at + lat.length[pick]
        more = lat.left[at] > 0
        live, at = live[more], at[more]
    rounds = len(who)
    for u, p in zip(live.tolist(), at.tolist()):
        # A choice depends on its place alone: choose at every place of a block, then follow.
        stop, done = p + int(lat.left[p]), rounds
        while p < stop:
            here = np.arange(p, min(p + BLOCK, stop))
            pick, behind = choose(np.full(len(here), u), here)
            step, path, x = lat.length[pick].tolist(), [], 0
            while x < len(here):
                path.append(x)
                x += step[x]
            turn.append(np.arange(done, done + len(path)))
            who.append(np.full(len(path), u))
            where.append(here[path])
            arc.append(pick[path])
            gap.append(behind[path])
            done += len(path)
            p += x
    end, best = phi.astype(float), [[] for _ in range(ndoc)]
    if not who:
        none = np.empty(0, np.int64)
        return none, none, none, end, best
    # Text order: the steps of a unit follow each other by turn.
    steps = np.zeros(len(units), np.int64)
    for i, u in enumerate(who):
        if i < rounds:
            steps[u] = i + 1
        else:
            steps[u[0]] = turn[i][-1] + 1
    begin = np.cumsum(steps) - steps
    at, a, behind = np.empty(steps.sum(), np.int64), np.empty(steps.sum(), np.int64), np.empty(steps.sum())
    for u, t, *found in zip(who, turn, where, arc, gap):
        to = begin[u] + t
        at[to], a[to], behind[to] = found
    d, lq = np.repeat(doc, steps), lat.logq[a]
    total = np.cumsum(lq)
    first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
    base = np.zeros(ndoc)
    base[d[first]] = total[first] - lq[first]
    before = phi[d] + total - lq - base[d]
    last = np.append(first[1:], len(d)) - 1
    end[d[last]] = before[last] + lq[last]
    place = np.repeat(shift, steps) + at

    # Siblings: Gumbels conditioned on the parent's value being the maximum. A
    # step's best one is the next best arc; its value falls as behind / exp(before)
    # grows, so the best ``keep`` of a document leave its best ``keep`` steps.
    with np.errstate(divide="ignore"):
        of = np.sort(_best_of(d, before - np.log(behind), keep))
    arcs, _ = ranges(lat.ptr[at[of]], lat.ptr[at[of] + 1])
    owner = np.repeat(of, lat.ptr[at[of] + 1] - lat.ptr[at[of]])
    v = lat.logq[arcs] + gumbel(key[d[owner]] + _counter(place[owner]), lat.length[arcs])
    z = lq[owner] + gumbel(key[d[owner]] + _counter(place[owner]), lat.length[a[owner]])
    other = arcs != a[owner]
    arcs, owner, v, z = arcs[other], owner[other], v[other], z[other]
    gd, from_ = g[d[owner]], before[owner]
    with np.errstate(divide="ignore"):
        t = gd - (from_ + v) + np.log1p(-np.exp(v - z))
    value = gd - np.maximum(t, 0) - np.log1p(np.exp(-np.abs(t)))
    for i, *e in zip(d[owner].tolist(), value.tolist(), place[owner].tolist(), arcs.tolist(), (from_ + lat.logq[arcs]).tolist()):
        best[i].append(tuple(e))
    return d, place, a, end, [sorted(x, key=lambda e: -e[0])[:keep] for x in best]


def _best_of(doc: np.ndarray, value: np.ndarray, keep: int) -> np.ndarray:
    """Where the ``keep`` greatest values of each document are; its rows follow each other."""
    begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    count = np.diff(np.append(begin, len(doc)))
    out = []
    for _ in range(keep):
        hit = np.flatnonzero((value == np.repeat(np.maximum.reduceat(value, begin), count)) & (value > -np.inf))
        hit = hit[np.unique(doc[hit], return_index=True)[1]]
        out.append(hit)
        value[hit] = -np.inf
    return np.concatenate(out)


class _Stretch:
    """A lattice over several whole documents, or over a part of one."""

    def __init__(self, vocab: Vocabulary, cps: list[np.ndarray], begin: int = 0, tail: np.ndarray | None = None):
        self.off = np.concatenate(([0], np.cumsum([len(c) for c in cps])))
        self.begin = begin
        cp = np.concatenate(cps)
        whole = tail is None and begin == 0
        self.lat = kept_lattice(vocab, cp, self.off[:-1]) if whole else Lattice(vocab, cp, self.off[:-1], tail)
        self.occ = np.searchsorted(self.lat.start, self.off)

    def walk(self, docs: np.ndarray, pos: np.ndarray, key, g, phi, keep):
        """Walk ``docs`` from document places ``pos``."""
        lat = self.lat
        place = self.off[docs] + np.maximum(pos - self.begin, 0)
        first = np.searchsorted(lat.start, place, "right") - 1
        first = np.where(place >= self.off[docs + 1], self.occ[docs + 1], first)
        units, begin = ranges(first, self.occ[docs + 1])
        owner = np.repeat(np.arange(len(docs)), self.occ[docs + 1] - first)
        offset = np.zeros(len(units), np.int64)
        some = self.occ[docs + 1] > first
        offset[begin[some]] = (place - lat.start[np.minimum(first, len(lat.start) - 1)])[some]
        return walk(lat, units, offset, owner, key, self.begin - self.off[docs], g, phi, keep)


def _cut(vocab: Vocabulary, cp: np.ndarray) -> list[int]:
    """Places to cut a long text: starts of units, or within units longer than a segment."""
    start = np.flatnonzero(_unit_begins(vocab, cp))
    want = np.arange(SEGMENT, len(cp), SEGMENT)
    unit = start[np.searchsorted(start, want, "right") - 1]
    return [0, *np.unique(np.where(unit > want - SEGMENT, unit, want)).tolist()]


def _parts(vocab: Vocabulary, cp: np.ndarray) -> list[tuple[int, int, np.ndarray | None]]:
    """(begin, end, backward values from the end on, if within a unit) of the parts of a long text."""
    cuts, out, tail = _cut(vocab, cp), [], None
    within = ~_unit_begins(vocab, cp)
    for a, b in zip(cuts[::-1], [len(cp), *cuts[:0:-1]]):
        out.append((a, b, tail))
        tail = _part(vocab, cp, a, b, tail).lat.ahead if within[a] else None
    return out[::-1]


def _part(vocab: Vocabulary, cp: np.ndarray, a: int, b: int, tail: np.ndarray | None) -> _Stretch:
    return _Stretch(vocab, [cp[a:b + (0 if tail is None else len(tail) - 1)]], a, tail)


def sample_group(vocab: Vocabulary, cps: list[np.ndarray], keys: np.ndarray, k: int, seed: int) -> list[list[tuple]]:
    """For each written text its k samples (ids, log p, value, inclusion)."""
    ndoc = len(cps)
    single = ndoc > 1 or len(cps[0]) <= 2 * SEGMENT
    if single:
        whole = _Stretch(vocab, cps)
        stretches = [lambda: whole]
        ends = [max(len(c) for c in cps)]
    else:
        parts = _parts(vocab, cps[0])
        ends = [p[1] for p in parts]
        # A part of a long text is built when it is walked and dropped after.
        stretches = [lambda p=p: _part(vocab, cps[0], *p) for p in parts]
    base = tc.mix(keys.astype(np.uint64) ^ tc.U64(seed * 0x9E3779B97F4A7C15 % 2**64))
    queue: list[list] = [[(float(v), -1, 0, 0, 0, 0.0)] for v in gumbel(base, np.zeros(ndoc))]
    paths: list[list] = [[] for _ in range(ndoc)]
    for pop in range(k):
        docs = np.array([d for d in range(ndoc) if queue[d]], np.int64)
        if len(docs) == 0:
            break
        node = []
        for d in docs:
            queue[d].sort(key=lambda e: -e[0])
            node.append(queue[d].pop(0))
        pos = np.array([n[2] + n[4] for n in node], np.int64)
        g, phi = np.array([n[0] for n in node]), np.array([n[5] for n in node])
        key = tc.mix(base[docs] + tc.U64(pop + 1))
        place = [[] for _ in docs]
        ident = [[] for _ in docs]
        for i, n in enumerate(node):
            if n[1] >= 0:
                old_place, old_ident = paths[docs[i]][n[1]][:2]
                cut = np.searchsorted(old_place, n[2])
                place[i] += [old_place[:cut], [n[2]]]
                ident[i] += [old_ident[:cut], [n[3]]]
        for make, stop in zip(stretches, ends):
            if not single and pos[0] >= stop:
                continue
            s = make()
            d, at, arcs, phi, best = s.walk(docs, pos, key, g, phi, k + 1)
            if not single:
                pos = at[-1:] + s.lat.length[arcs[-1:]]
            names = s.lat.ident[arcs]
            cuts = np.searchsorted(d, np.arange(len(docs) + 1))
            for i in range(len(docs)):
                place[i].append(at[cuts[i]:cuts[i + 1]])
                ident[i].append(names[cuts[i]:cuts[i + 1]])
                queue[docs[i]] += [(v, pop, p, int(s.lat.ident[a]), int(s.lat.length[a]), f) for v, p, a, f in best[i]]
                queue[docs[i]] = sorted(queue[docs[i]], key=lambda e: -e[0])[:k + 1]
        for i, d in enumerate(docs):
            paths[d].append((np.concatenate(place[i]).astype(np.int64), np.concatenate(ident[i]).astype(np.int64), float(phi[i]), float(g[i])))
    out = []
    for d in range(ndoc):
        kappa = max((e[0] for e in queue[d]), default=None)
        out.append([(piece_ids(vocab, ident), phi, g, 1.0 if kappa is None else float(-np.expm1(-np.exp(min(phi - kappa, 700.0)))))
                    for _, ident, phi, g in paths[d]])
    return out


def piece_ids(vocab: Vocabulary, ident: np.ndarray) -> np.ndarray:
    """Vocabulary ids; a code point without a piece (-1 - it) becomes its bytes."""
    plain = ident.copy()
    one = (ident < 0) & (ident >= -0x80)
    plain[one] = vocab.byte_id[-1 - ident[one]]
    many = np.flatnonzero(ident < -0x80)
    if len(many):
        raw = [chr(SPACE if c == LITERAL else c).encode() for c in (-1 - ident[many]).tolist()]
        count = np.ones(len(ident), np.int64)
        count[many] = [len(r) for r in raw]
        begin = np.cumsum(count) - count
        plain = np.repeat(plain, count)
        for b, r in zip(begin[many].tolist(), raw):
            plain[b:b + len(r)] = vocab.byte_id[list(r)]
    return plain.astype("<i4")


def written(text: str) -> np.ndarray:
    """Code points of the text as the lattice sees it."""
    cp = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    cp[cp == SPACE] = LITERAL
    cp[cp == 0x20] = SPACE
    return np.concatenate(([SPACE], cp))


def sample_texts(vocab: Vocabulary, keys: list, texts: list, k: int, seed: int) -> list[list[tuple]]:
    out: list = [None] * len(texts)
    group, size = [], 0

    def flush():
        nonlocal group, size
        if group:
            got = sample_group(vocab, [c for _, c in group], np.array([(keys[i] or 0) % 2**64 for i, _ in group], np.uint64), k, seed)
            for (i, _), r in zip(group, got):
                out[i] = r
        group, size = [], 0

    for i, t in enumerate(texts):
        if not t:
            out[i] = [(np.empty(0, "<i4"), 0.0, 0.0, 1.0)]
            continue
        cp = written(t)
        if size + len(cp) > SEGMENT:
            flush()
        group.append((i, cp))
        size += len(cp)
    flush()
    return out


SAMPLE = "array<struct<ids:binary,log_prob:double,value:double,inclusion:double>>"
_SAMPLE = pa.list_(pa.struct([("ids", pa.binary()), ("log_prob", pa.float64()), ("value", pa.float64()), ("inclusion", pa.float64())]))


def sample(documents: DataFrame, k: int = SAMPLES, seed: int = 1, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, samples, decoded) of each row of ``documents`` (doc_id, text).

    ``ids``: little-endian 32-bit piece ids; ``decoded``: every sample decodes
    to the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in slices(batches, "text", BATCH_BYTES):
            texts = b.column(1).to_pylist()
            got = sample_texts(vocab, b.column(0).to_pylist(), texts, k, seed)
            rows = [[{"ids": i.tobytes(), "log_prob": p, "value": v, "inclusion": q} for i, p, v, q in r] for r in got]
            ok = [all(vocab.decode(s[0]) == (t or "") for s in r) for t, r in zip(texts, got)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, _SAMPLE), pa.array(ok)], ["doc_id", "samples", "decoded"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, samples {SAMPLE}, decoded boolean")


def decode(rows: DataFrame, ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``rows`` with ``decoded_text`` from packed piece ids (null for null)."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for b in batches:
            text = [None if x is None else vocab.decode(x) if x else "" for x in b.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*names, "decoded_text"])

    from pyspark.sql.types import StringType, StructField, StructType
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded_text", StringType())]))


def digests(sampled: DataFrame) -> DataFrame:
    """A row per document: samples, pieces, log p, inclusion scores and a digest of all piece ids."""
    s = F.col("samples")
    return sampled.select(
        "doc_id", F.size(s).cast("long").alias("n_samples"),
        F.transform(s, lambda x: (F.octet_length(x.ids) / 4).cast("long")).alias("n_pieces"),
        F.transform(s, lambda x: x.log_prob).alias("log_probs"),
        F.transform(s, lambda x: x.inclusion).alias("inclusion"),
        F.transform(s, lambda x: F.sha2(x.ids, 256)).alias("ids_sha256"),
        (F.size(F.array_distinct(F.transform(s, lambda x: F.sha2(x.ids, 256)))) == F.size(s)).alias("distinct"),
        "decoded")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: two sampled segmentations without replacement."""
    return digests(sample(table(spark, sf_dir, "documents")))
