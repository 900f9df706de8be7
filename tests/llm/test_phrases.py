"""Collocations against plain counting, with odd rows, hot languages and full counter tables."""

import random
import re
from collections import Counter

import numpy as np

from helpers import LOWER, ODD
from tollgate.llm import phrases as P


def expected(rows, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= 30}
    out = []
    for (lang, p), a in found.items():
        inside = any(100 * b >= 80 * a for (m, q), b in found.items()
                     if m == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
        if not inside:
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(mine[:top])]
    return sorted(ranked)


def corpus(rng):
    v = ["w%d" % i for i in range(12)] + ["NEW", "York", "é", "日本", "a-b", "x\x01y"]
    sets = [[rng.choice(v) for _ in range(rng.randint(2, 6))] for _ in range(8)]
    rows = []
    for _ in range(700):
        w = []
        for _ in range(rng.randint(0, 8)):
            w += rng.choice(sets) if rng.random() < 0.6 else [rng.choice(v)]
            w.append(rng.choice([",", ".", "\n", ""] + [""] * 6))
        rows.append((rng.choice(["en"] * 5 + ["de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(w)))
    return rows + [("en", t) for t in ODD] + [("only", "a b"), ("fr", None)]


def result(spark, rows, top, partitions=3):
    d = spark.createDataFrame([(t, lang, "c", 1, "w") for lang, t in rows], "text string, lang string, phrase string, n int, word string").repartition(partitions)
    got = P.collocations(d, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_matches_plain_counts(spark):
    rows = corpus(random.Random(1))
    want = expected(rows, 25)
    assert len(want) > 40 and result(spark, rows, 25) == want


def test_full_counter_tables_change_nothing(spark, monkeypatch):
    """What a huge corpus does to the tables: every counter is high, so windows reach the rollup uncut."""
    rows = corpus(random.Random(2))
    monkeypatch.setattr(P, "frequent_bits", lambda chunks: np.full((3, (1 << P.BITS) // 8), 255, np.uint8))
    assert result(spark, rows, 2000) == expected(rows, 2000)


def test_counts_past_the_held_bound_are_summed(spark, monkeypatch):
    rows = corpus(random.Random(3))
    monkeypatch.setattr(P, "HELD", 5)
    assert result(spark, rows, 2000, 1) == expected(rows, 2000)


def test_overlaps_and_ties(spark):
    rows = [("en", "a a a a a a"), ("en", "b c")] * 30 + [("en", "c b")] * 30
    assert result(spark, rows, 2000) == expected(rows, 2000)


def test_products_past_64_bits(spark):
    windows = spark.createDataFrame([("en", 1, 2, None, None, 2**62), ("en", 1, 3, 4, None, 7)], "lang string, w1 long, w2 long, w3 long, w4 long, n long")
    assert [(r.length, r.a) for r in P.frequent_phrases(windows).collect()] == [(2, 2**62)]
    assert spark.sql(f"SELECT {P.SCORE} FROM VALUES (9000000000000000000L, 9000000000000000000L, 9000000000000000001L) AS t(a, l, r)").first()[0] == 999999


def test_nothing_to_count(spark):
    assert result(spark, [("en", None), (None, ""), ("de", "one")], 10) == []
    assert P.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def windows_made(monkeypatch):
    made, windows = [], P.longest_windows

    def spy(*a):
        made.append(windows(*a))
        return made[-1]

    monkeypatch.setattr(P, "longest_windows", spy)
    return made


def test_rare_phrases_that_share_a_counter_make_no_windows(spark, monkeypatch):
    """What a large corpus does to tables of counters of a fixed size: many rare phrases meet in each."""
    names = ["x%d" % i for i in range(400)]
    code = P._code([w.encode() for w in names]).view(np.uint64)
    lang = P.tc.mix(P._code([b"en"]).view(np.uint64) + P.tc._GOLDEN)
    h = P.tc.mix(P.tc.mix(lang * np.uint64(3) + code)[:, None] * np.uint64(3) + code[None, :]).ravel()
    order = np.argsort(h)
    met = np.flatnonzero((h[order][1:] >> np.uint64(40) == h[order][:-1] >> np.uint64(40)) & (h[order][1:] >> np.uint64(34) != h[order][:-1] >> np.uint64(34)))
    pairs = [" ".join((names[x // 400], names[x % 400])) for i in met[:20] for x in order[i:i + 2]]
    assert len(pairs) == 40
    rows = [("en", t) for t in [*pairs] * 20 + ["often met"] * 30]
    made = windows_made(monkeypatch)
    assert result(spark, rows, 2000) == expected(rows, 2000)
    assert [r.n for r in made[0].collect()] == [30]


def test_windows_are_added_up_before_they_are_written(spark, monkeypatch):
    rows = [("en" if i % 2 else "de", t) for i in range(80) for t in ("a b c d e", "a b c", "c d e f", "x%d a b" % i)]
    cut = P.slices
    monkeypatch.setattr(P, "slices", lambda batches, column, limit: cut(batches, column, 8))
    made = windows_made(monkeypatch)
    assert result(spark, rows, 2000, 4) == expected(rows, 2000)
    got = [tuple(r)[:-1] for r in made[0].collect()]
    assert len(got) == len(set(got)) and 0 < len(got) < 40


def test_held_bounds_change_nothing(spark, monkeypatch):
    rows = corpus(random.Random(4))
    cut = P.slices
    monkeypatch.setattr(P, "slices", lambda batches, column, limit: cut(batches, column, 500))
    monkeypatch.setattr(P, "HELD_HASHES", 300, raising=False)
    monkeypatch.setattr(P, "HELD_WINDOWS", 100, raising=False)
    monkeypatch.setattr(P, "DEALT", 64, raising=False)
    assert result(spark, rows, 2000, 2) == expected(rows, 2000)


def test_packed_hashes_come_back():
    rng = np.random.default_rng(1)
    for width in (4, 9, 16):
        keys = np.unique(np.concatenate((rng.integers(0, 3 << (width + P.REST), 5000, np.uint64), np.array([0, (1 << P.REST) - 1, (3 << (width + P.REST)) - 1], np.uint64))))
        n = rng.integers(1, P.LEAST + 1, len(keys))
        back = [(part << P.REST | int(v) >> P.COUNT, int(v) & 31) for part, size, data in zip(*P._pack(keys, n, width)) for v in P._unpack(size, data)]
        assert back == list(zip(keys.tolist(), n.tolist()))
