"""Phrase collocations: n-gram counts by top-order marginalisation.

Words of 2 to 4 are counted without one explosion per length. At each word the
words that lead on from it within its piece make one longest window, padded
with nulls; only these windows are counted, and ``ROLLUP`` over the third and
fourth word sums them to the counts of the shorter phrases they begin with.

Most windows of a large corpus can hold no phrase of ``LEAST`` occurrences. A
first pass counts the phrases of 2, 3 and 4 words by a hash of language and
words (32 bits and more, as the text grows): a task sorts its hashes, and their
steps and counts are dealt out packed, by ranges, and added up. A hash counts at
least as often as each phrase behind it, so a window is cut before a word whose
phrase has a hash below LEAST, and no phrase of LEAST occurrences loses any of
them. What reaches the tasks is a bit for each hash of LEAST or more, in three
tables whose size follows the number of frequent phrases, not the text (3 x 2
to 3 x 16 MB); past some millions of frequent phrases a table lets more windows
through, and counts stay exact.

A phrase is scored by its weakest cut: floor(2000000 * a / (l + r)), with a, l
and r the counts of the phrase, its first words and the rest; decimals hold
products past 64 bits. A candidate inside a longer one with at least 0.8 of its
count goes. All of this joins tables of phrases with at least LEAST
occurrences, keyed by language and text; hot keys meet partial sums first.

Words are told apart by 64 bits of BLAKE2; texts of words are kept in the
words table, which is counted by the texts themselves.

Cases: a null text is empty; a null language is ``und`` (with rows that say
so). Empty pieces have no words; a text without words adds nothing. Ties of
score and count go by phrase, ties of a cut's score to the shorter first part.
Repeated rows count each. A very long text is one row's work. A task's counts of
windows are dealt out packed, and added up before they are written. Extra columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.llm import textcodes as tc
from tollgate.llm.common import Scratch, slices, table

LEAST, TOP, LONGEST = 30, 2000, 4
#: Bits that address a table of frequent hashes, at least and at most.
BITS, WIDEST = 24, 27
#: Bits of a phrase's hash below its range; bits of a partial count.
REST, COUNT = 28, 5
#: Bytes of text whose phrases of one length make a range of hashes.
DEALT = 1 << 23
#: Bytes of text taken at a time.
TEXT = 1 << 20
#: Partial counts of words, hashes of phrases and windows that a task holds before it hands them on.
HELD, HELD_HASHES, HELD_WINDOWS = 100_000, 1 << 20, 1 << 17
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _code(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blake2b(t, digest_size=8).digest() for t in texts), np.int64)


def words_of(texts: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray, list, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch, in order: (language number, word number, languages, word texts, word codes, reach).

    ``reach`` is how many words follow without a break, the word included, at most LONGEST.
    """
    raw, off = tc.utf8(texts)
    raw = _LOWER[raw]
    starts, ends = tc.spans(~_GAP[raw], off)
    inside = ~_GAP[raw]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[inside].tobytes())])
    words = held.dictionary_encode()
    names = langs.fill_null("und").dictionary_encode()
    row = np.searchsorted(off, starts, "right") - 1
    breaks = np.concatenate(([0], np.cumsum(_BREAK[raw])))
    n = len(starts)
    joined = np.zeros(n, bool)  # the next word follows in the same piece
    if n:
        joined[:-1] = (row[1:] == row[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]])
    reach = np.ones(n, np.int8)
    for k in range(1, LONGEST):
        more = joined.copy()
        for j in range(1, k):
            more[:-j] &= joined[j:]
            more[-j:] = False
        reach[more] = k + 1
    texts_ = words.dictionary.to_pylist()
    return (names.indices.to_numpy()[row] if n else np.empty(0, np.int64), words.indices.to_numpy(), names.dictionary.to_pylist(), texts_, _code(texts_), reach)


def phrase_places(lang: np.ndarray, code: np.ndarray, reach: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3 and 4 words: (positions with that many words ahead, hash of the phrase there)."""
    acc = tc.mix(lang.view(tc.U64) + tc._GOLDEN)
    out = []
    n = len(code)
    for k in range(LONGEST):
        at = np.flatnonzero(reach > k)
        nxt = np.zeros(n, tc.U64)
        nxt[at] = tc.mix(acc[at] * tc.U64(3) + code[at + k].view(tc.U64))
        acc = nxt
        if k:
            out.append((at, acc[at]))
    return out


def _lang_codes(names: list[str], lang: np.ndarray) -> np.ndarray:
    return _code([x.encode() for x in names])[lang] if names else np.empty(0, np.int64)


def width_for(documents: DataFrame) -> int:
    """Bits by which hashes are dealt out: a range of hashes of one length holds those of about DEALT bytes of text."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(16, max(4, (size // DEALT).bit_length()))


def _pack(keys: np.ndarray, counts: np.ndarray, width: int) -> tuple[list[int], list[int], list[bytes]]:
    """Ascending keys (length, ``width`` bits of range, REST bits) and counts as (range, size, bytes) of each range.

    A range's keys are steps of REST bits: two bytes as they are, the others, nearly all equal, with the counts in zstd.
    """
    bounds = np.searchsorted(keys, np.arange(((LONGEST - 1) << width) + 1, dtype=tc.U64) << tc.U64(REST))
    parts = np.flatnonzero(np.diff(bounds))
    step = np.diff(keys, prepend=tc.U64(0)).astype(np.uint32)
    step[bounds[parts]] = keys[bounds[parts]] & tc.U64((1 << REST) - 1)
    low, rest = step.astype("<u2"), np.stack(((step >> 16).astype(np.uint8), (step >> 24).astype(np.uint8), counts.astype(np.uint8)))
    ends = zip(bounds[parts].tolist(), bounds[parts + 1].tolist())
    return parts.tolist(), (bounds[parts + 1] - bounds[parts]).tolist(), [low[a:b].tobytes() + pa.compress(rest[:, a:b].tobytes(), "zstd", asbytes=True) for a, b in ends]


def _unpack(n: int, data: bytes) -> np.ndarray:
    """Keys within their range, each with its count in the lowest COUNT bits."""
    rest = np.frombuffer(pa.decompress(memoryview(data)[2 * n:], 3 * n, "zstd", asbytes=True), np.uint8).reshape(3, n).astype(tc.U64)
    step = np.frombuffer(data, "<u2", n).astype(tc.U64) | rest[0] << tc.U64(16) | rest[1] << tc.U64(24)
    return np.cumsum(step, dtype=tc.U64) << tc.U64(COUNT) | rest[2]


_FIRST = pa.schema([("lang", pa.string()), ("word", pa.string()), ("code", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("width", pa.int32()), ("data", pa.binary())])


def first_pass(documents: DataFrame, width: int) -> DataFrame:
    """Partial counts of words (lang, word, code, n), and of phrases by hash (n hashes, part, width, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        hashes: list[np.ndarray] = []

        def flush():
            keys = list(seen)
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()).cast(pa.string()),
                                              pa.array(_code([k[1] for k in keys])), pa.array(list(seen.values()), pa.int64()), *(pa.nulls(n, t) for t in _FIRST.types[4:])], schema=_FIRST)
            seen.clear()

        def flush_hashes():
            keys = np.concatenate(hashes)
            hashes.clear()
            keys.sort()
            first = _firsts(keys)
            parts, sizes, data = _pack(keys[first], np.minimum(np.diff(first, append=len(keys)), LEAST), width)
            n = len(parts)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(n, t) for t in _FIRST.types[:3]), pa.array(sizes, pa.int64()), pa.array(parts, pa.int32()),
                                              pa.array([width] * n, pa.int32()), pa.array(data, pa.binary())], schema=_FIRST)

        for b in slices(batches, "text", TEXT):
            lang, word, names, texts, codes, reach = words_of(b.column("text"), b.column("lang"))
            if not len(word):
                continue
            both, n = np.unique(lang.astype(np.int64) * len(texts) + word, return_counts=True)
            for x, c in zip(both.tolist(), n.tolist()):
                key = (names[x // len(texts)], texts[x % len(texts)])
                seen[key] = seen.get(key, 0) + c
            if len(seen) > HELD:
                yield from flush()
            for k, (_, h) in enumerate(phrase_places(_lang_codes(names, lang), codes[word], reach)):
                if len(h):
                    hashes.append(h >> tc.U64(64 - width - REST) | tc.U64(k << (width + REST)))
            if sum(map(len, hashes)) > HELD_HASHES:
                yield from flush_hashes()
        if seen:
            yield from flush()
        if hashes:
            yield from flush_hashes()

    return documents.select("text", F.col("lang").cast("string")).mapInArrow(run, "lang string, word string, code long, n long, part int, width int, data binary")


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Row numbers at which a new run of equal ``keys`` begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


def frequent_hashes(partial: DataFrame) -> DataFrame:
    """(part, width, n, data): the hashes of each range whose counts add up to LEAST; one range is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def row():
            v = np.concatenate(held)
            v.sort()
            h = v >> tc.U64(COUNT)
            first = _firsts(h)
            h = h[first[np.add.reduceat(v & tc.U64((1 << COUNT) - 1), first) >= LEAST]].astype("<u4")
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([len(h)], pa.int64()), pa.array([h.tobytes()], pa.binary())],
                                              ["part", "width", "n", "data"])

        for b in batches:
            for part, width, n, data in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (part, width) != key:
                    if held:
                        yield row()
                    key, held = (part, width), []
                held.append(_unpack(n, data))
        if held:
            yield row()

    return (partial.select("part", "width", "n", "data").repartition("part").sortWithinPartitions("part")
            .mapInArrow(run, "part int, width int, n long, data binary"))


def frequent_bits(chunks: DataFrame) -> np.ndarray:
    """Three tables of bits (2, 3 and 4 words), addressed by the first bits of a hash: set for each hash of ``chunks``.

    64 bits or more for each hash of the fullest table, from 3 x 2 MB on and 3 x 16 MB at most.
    """
    most = chunks.groupBy(F.expr("part >> width")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = min(WIDEST, max(BITS, (64 * most).bit_length()))
    out = np.zeros((LONGEST - 1, (1 << bits) // 8), np.uint8)
    for r in chunks.where("n > 0").toLocalIterator():
        own = np.zeros(1 << (bits - r.width), bool)
        own[np.frombuffer(r.data, "<u4") >> np.uint32(REST - bits + r.width)] = True
        k, part = r.part >> r.width, r.part & ((1 << r.width) - 1)
        out[k, part * len(own) // 8:(part + 1) * len(own) // 8] = np.packbits(own, bitorder="little")
    return out


_WINDOWS = pa.schema([("lang", pa.string()), *((f"w{i}", pa.int64()) for i in range(1, LONGEST + 1)), ("n", pa.int64())])
_DEALT = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("size", pa.int32()), ("counts", pa.binary()), ("words", pa.binary())])


def _counted(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Equal windows as one row, in the order of their hashes; columns: hash, language, words present, four words (0 where absent), count."""
    order = np.argsort(rows[0], kind="stable")
    rows = [c[order] for c in rows]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in rows[:-1]:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in rows[:-1]] + [np.add.reduceat(rows[-1], first) if len(first) else rows[-1]]


def _joined(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    return _counted([np.concatenate(c) for c in zip(*held)])


def longest_windows(documents: DataFrame, bits: np.ndarray, width: int = 4) -> DataFrame:
    """(lang, w1..w4, n), each once: windows of two words or more, cut where no frequent phrase goes on.

    A task counts its windows, HELD_WINDOWS at a time, and deals the counts out, packed, by 2**``width`` ranges of a
    hash; one range of a language is added up at a time.
    """
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        shift = tc.U64(64 - (frequent.shape[1] * 8 - 1).bit_length())
        numbers: dict[str, int] = {}
        held: list[list[np.ndarray]] = []

        def flush():
            (h, lang, present, *words, n), names = held[0], list(numbers)
            held.clear()
            run = lang.astype(np.int64) << width | (h >> tc.U64(64 - width)).astype(np.int64)
            order = np.argsort(run, kind="stable")
            run, present, words, n = run[order], present[order], [w[order] for w in words], n[order]
            cuts = np.append(_firsts(run), len(run)).tolist()
            data = []
            for a, b in zip(cuts, cuts[1:]):
                there = present[a:b]
                data.append((names[run[a] >> width], run[a] & ((1 << width) - 1), b - a,
                             pa.compress(there.tobytes() + n[a:b].view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True),
                             b"".join(w[a:b][there > k].tobytes() for k, w in enumerate(words))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*data), _DEALT.types)], schema=_DEALT)

        for b in slices(batches, "text", TEXT):
            lang, word, names, _, codes, reach = words_of(b.column("text"), b.column("lang"))
            code = codes[word]
            keep = np.ones(len(word), np.int8)
            for k, (at, h) in enumerate(phrase_places(_lang_codes(names, lang), code, reach)):
                bucket = (h >> shift).astype(np.int64)
                on = (frequent[k, bucket >> 3] >> (bucket & 7).astype(np.uint8)) & 1 == 1
                keep[at[on & (keep[at] == k + 1)]] = k + 2
            at = np.flatnonzero(keep >= 2)
            if not len(at):
                continue
            present = keep[at]
            words = [np.zeros(len(at), np.int64) for _ in range(LONGEST)]
            h = tc.mix(present.astype(tc.U64))
            for k, w in enumerate(words):
                there = present > k
                w[there] = code[at[there] + k]
                h = tc.mix(h * tc.U64(3) + w.view(tc.U64))
            held.append(_counted([h, np.array([numbers.setdefault(x, len(numbers)) for x in names], np.int32)[lang[at]], present, *words, np.ones(len(at), np.int64)]))
            if sum(len(x[0]) for x in held) > HELD_WINDOWS:
                held[:] = [_joined(held)]
                if len(held[0][0]) > HELD_WINDOWS // 2:
                    yield from flush()
        if held:
            held[:] = [_joined(held)]
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def row():
            _, _, present, *words, n = _joined(held)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(n), pa.string()), *(pa.array(w, pa.int64(), mask=present <= k) for k, w in enumerate(words)), pa.array(n)], schema=_WINDOWS)

        for b in batches:
            for lang, part, size, counts, data in zip(*(c.to_pylist() for c in b.columns)):
                if (lang, part) != key:
                    if held:
                        yield row()
                    key, held = (lang, part), []
                tail = np.frombuffer(pa.decompress(counts, 9 * size, "zstd", asbytes=True), np.uint8)
                present, n = tail[:size].view(np.int8), np.ascontiguousarray(tail[size:].reshape(8, size).T).view(np.int64)[:, 0]
                flat, words, h, at = np.frombuffer(data, np.int64), [], np.zeros(size, tc.U64), 0
                for k in range(LONGEST):
                    there = np.flatnonzero(present > k)
                    words.append(np.zeros(size, np.int64))
                    words[k][there] = flat[at:at + len(there)]
                    at += len(there)
                    h = tc.mix(h * tc.U64(3) + words[k].view(tc.U64))
                held.append([h, np.zeros(size, np.int8), present, *words, n])
        if held:
            yield row()

    return (documents.select("text", F.col("lang").cast("string")).mapInArrow(run, "lang string, part int, size int, counts binary, words binary")
            .repartition("lang", "part").sortWithinPartitions("lang", "part")
            .mapInArrow(add, "lang string, w1 long, w2 long, w3 long, w4 long, n long"))


def frequent_phrases(windows: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, w1..w4, length, a) of the phrases of 2 to 4 words with a >= ``least``: rolled up over words 3 and 4."""
    rolled = windows.sparkSession.sql("""
        SELECT lang, w1, w2, w3, w4, 4 - bit_count(grouping_id()) AS length, sum(n) AS a FROM {windows}
        GROUP BY lang, w1, w2, ROLLUP (w3, w4)""", windows=windows)
    padded = ((F.col("length") == 4) & F.col("w4").isNull()) | ((F.col("length") == 3) & F.col("w3").isNull())
    return rolled.where(~padded & (F.col("a") >= least)).withColumn("length", F.col("length").cast("int"))


#: Weakest-cut score in decimals: the products pass 64 bits.
SCORE = "(CAST(a AS DECIMAL(20, 0)) * 2000000) div (CAST(l AS DECIMAL(20, 0)) + r)"


def collocations(documents: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    width = width_for(documents)
    first = scratch.keep(first_pass(documents, width))
    counted = first.where("part IS NULL")
    words = scratch.keep(counted.groupBy("lang", "word").agg(F.first("code").alias("code"), F.sum("n").alias("n")).where(F.col("n") >= LEAST))
    total = scratch.keep(counted.groupBy("lang").agg(F.sum("n").alias("n")))
    chunks = scratch.keep(frequent_hashes(first.where("part IS NOT NULL")))
    scratch.drop(first)
    coded = scratch.keep(longest_windows(documents, frequent_bits(chunks), width))
    scratch.drop(chunks)
    phrases = scratch.keep(frequent_phrases(coded).withColumn("id", F.monotonically_increasing_id()))
    scratch.drop(coded)

    named = scratch.keep(_spelled(phrases, words))
    counts = named.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")).unionAll(
        words.select("lang", F.col("word").alias("part"), F.col("n").alias("f")))
    cuts = named.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("rest"))
    l = counts.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))  # noqa: E741
    r = counts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = (cuts.join(l, ["lang", "head"]).join(r, ["lang", "rest"]).withColumn("score", F.expr(SCORE))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), F.first("a").alias("a")))

    inner = (named.where(F.size("words") > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("m"))
             .select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("s"))
             .select("lang", F.array_join(F.slice("words", F.col("s"), F.col("m")), " ").alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * 80)))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = scratch.keep(kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return (ranked.join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score"))


def _spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, words, a): coded words as their texts; a phrase's words meet again by its number."""
    at = phrases.select("id", "lang", "length", "a", F.posexplode(F.slice(F.array("w1", "w2", "w3", "w4"), 1, F.col("length"))).alias("place", "code"))
    return (at.join(words.select("lang", "code", "word"), ["lang", "code"])
            .groupBy("id").agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("length").alias("length"),
                               F.array_sort(F.collect_list(F.struct("place", "word"))).alias("x"))
            .select("lang", "a", F.col("x.word").alias("words"), F.array_join("x.word", " ").alias("phrase")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
k AS (SELECT lang, w, unnest(range(1, 5)) AS k FROM w),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM k WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {LEAST}),
x AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT x.lang, x.phrase, x.a, x.cut, h.f AS l, t.f AS r, (2000000::HUGEINT * x.a) // (h.f::HUGEINT + t.f) AS score
  FROM x JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(w[1:cut], ' ') JOIN f t ON t.lang = x.lang AND t.phrase = array_to_string(w[cut + 1:x.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
m AS (SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM c WHERE k > 2),
i AS (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM m),
o AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM i GROUP BY ALL),
r AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM b LEFT JOIN o USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= {TOP}
"""
