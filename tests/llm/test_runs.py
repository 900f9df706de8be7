"""Periodic runs against a scan of every period, alone and through the query's columns."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from helpers import ODD, WORD
from pyspark.sql import functions as F
from tollgate.llm import runs as R


def slow_runs(words, least=2, exponent=2):
    """Every run by trying each period; a stretch counts under its smallest period only."""
    name = {}
    a = np.array([name.setdefault(w, len(name)) for w in words], np.int64)
    out, seen = [], set()
    for p in range(1, len(a) // exponent + 1):
        same = np.concatenate(([False], a[p:] == a[:-p], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i >= p and (i, j + p) not in seen:  # a multiple of the period gives the same stretch
                seen.add((i, j + p))
                if j + p - i >= max(least, exponent * p):
                    out.append((i, j + p - i, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rng, letters, parts):
    w = []
    for _ in range(parts):
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        w += (unit * rng.randint(1, 7))[:rng.randint(3, 80)]
    return w


def test_all_runs_of_small_alphabets():
    rng = random.Random(1)
    for k in range(400):
        w = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 60))] if k % 2 else periodic(rng, "abcd", 4)
        assert R.find_runs(w) == slow_runs(w), w


def test_known_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a  # Fibonacci words are rich in runs
    for w in (b, [1] * 300, [0, 1] * 100, list(range(50)) * 3, []):
        assert R.find_runs(w) == slow_runs(w)


def test_common_extensions():
    rng = random.Random(2)
    s = [rng.randint(1, 2) for _ in range(300)]
    x = R.Extensions(s)
    for _ in range(2000):
        i, j = rng.sample(range(301), 2)
        k = 0
        while i + k < 300 and j + k < 300 and s[i + k] == s[j + k]:
            k += 1
        assert x.common(np.array([i]), np.array([j]))[0] == k
    order = sorted(range(301), key=lambda i: s[i:])
    assert [int(x.rank[i]) for i in order] == list(range(301))
    order = sorted(range(301), key=lambda i: [-c for c in s[i:]])
    assert [int(x.reversed_rank()[i]) for i in order] == list(range(301))


def expected(doc_id, text, tails):
    w = WORD.findall(text or "")
    n = len(w)
    if tails and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = slow_runs(w, 24, 3)
    gone = {i for s, x, p in found for i in range(s + p, s + x)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def texts(rng):
    v = ["w%d" % i for i in range(60)]
    out = [*ODD, " ".join(["a"] * 24), " ".join(["a"] * 23), " ".join(["a", "b"] * 12), " ".join(v[:8] * 3), " ".join(v[:9] * 3), " ".join(v[:9] * 3)[:-3]]
    for _ in range(150):
        kind = rng.random()
        if kind < 0.3:
            w = rng.choices(v, k=rng.randint(0, 300))
        elif kind < 0.8:
            w = periodic(rng, v[:rng.choice([2, 5, 60])], rng.randint(1, 8))
        else:
            line = rng.choices(v, k=rng.randint(3, 30))
            w = sum((line + rng.choices(v, k=rng.choice([0, 0, 2])) for _ in range(rng.randint(2, 9))), [])
        out.append(rng.choice([" ", "\n", "\t \x0b"]).join(w))
    return out


@pytest.mark.parametrize("partitions", [1, 4])
def test_query_columns_match_the_slow_scan(spark, tmp_path, partitions):
    rows = [(None if i % 17 == 3 else i, t, "y", 5) for i, t in enumerate(texts(random.Random(3)) * 2)] + [(4, "other text of the same id", "z", 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, runs string, length int")
    d.repartition(partitions).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in R.op13_runs(spark, str(tmp_path)).collect()), key=repr)
    want = sorted(((i, *expected(i, t, True)) for i, t, *_ in rows), key=repr)
    assert got == want
    plain = sorted(((r.doc_id, len(r.runs), hashlib.sha256(r.text.encode()).hexdigest()) for r in R.collapse(d).collect()), key=repr)
    assert plain == sorted(((i, (e := expected(i, t, False))[0], e[-1]) for i, t, *_ in rows), key=repr)


def test_a_long_text_is_one_run(spark):
    n = 200_000
    d = spark.createDataFrame([(1, "ab cd " * (n // 2)), (2, " ".join(map(str, range(n))))], "doc_id long, text string")
    got = {r.doc_id: r for r in R.collapse(d).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, n, 2)] and got[1].text == "ab cd"
    assert got[2].runs == [] and len(got[2].text.split()) == n


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert R.collapse(R.with_repeated_tails(d)).collect() == []
    assert R.with_repeated_tails(spark.createDataFrame([(None, "a a")], "doc_id long, text string")).select(F.col("text")).first()[0] == "a a"
