import collections
import math

import numpy as np
import pytest

from helpers import ODD
from tollgate.llm import sentencepiece_sample as M


@pytest.fixture(scope="module")
def vocab():
    return M.Vocabulary()


def segmentations(vocab, text):
    """Every segmentation (place, length)* with its log probability."""
    cp = M.written(text).tolist()
    pieces = {tuple(ord(c) for c in vocab.text[i].decode().replace(" ", chr(M.SPACE))): w for i, w in zip(vocab.ids, vocab.weight)}

    def rec(p):
        if p == len(cp):
            yield (), 0.0
            return
        single = tuple(cp[p:p + 1]) in pieces
        for n in range(1, vocab.longest + 1):
            t = tuple(cp[p:p + n])
            if len(t) == n and t in pieces:
                for r, s in rec(p + n):
                    yield ((p, n), *r), s + pieces[t]
        if not single:
            width = 3 if cp[p] == M.LITERAL else len(chr(cp[p]).encode())
            for r, s in rec(p + 1):
                yield ((p, 1), *r), s + width * vocab.byte_weight

    every = list(rec(0))
    z = np.logaddexp.reduce([s for _, s in every])
    return {a: s - z for a, s in every}


def split(vocab, ids):
    at, out = 0, []
    for i in ids.tolist():
        n = len(vocab.text[i].decode())
        out.append((at, n))
        at += n
    return tuple(out)


def test_samples_follow_the_lattice(vocab):
    text, n = "the in a", 6000
    exact = segmentations(vocab, text)
    got = M.sample_texts(vocab, list(range(n)), [text] * n, 3, 1)
    first, second = collections.Counter(), collections.Counter()
    for r in got:
        assert len({x[0].tobytes() for x in r}) == 3 and r[0][2] >= r[1][2] >= r[2][2]
        for x in r:
            assert abs(exact[split(vocab, x[0])] - x[1]) < 1e-9
        first[split(vocab, r[0][0])] += 1
        second[split(vocab, r[1][0])] += 1
    p = {k: math.exp(v) for k, v in exact.items()}
    for k in sorted(p, key=p.get)[-3:]:
        two = sum(q * p[k] / (1 - q) for o, q in p.items() if o != k)
        assert abs(first[k] / n - p[k]) < 4 * math.sqrt(p[k] / n) + 1e-3
        assert abs(second[k] / n - two) < 4 * math.sqrt(two / n) + 1e-3
    pieces = sum(q * len(k) for k, q in p.items())
    weighted = np.mean([sum(math.exp(x[1]) / x[3] * len(x[0]) for x in r) for r in got])
    assert abs(weighted - pieces) < 0.01 * pieces


def test_all_segmentations_of_a_tiny_text(vocab):
    exact = segmentations(vocab, "ab")
    r = M.sample_texts(vocab, [3], ["ab"], len(exact) + 2, 1)[0]
    assert {split(vocab, x[0]) for x in r} == set(exact) and all(x[3] == 1.0 for x in r)


def test_segments_and_batches_change_nothing(vocab, monkeypatch):
    texts = [" ".join(f"word{i} thing" for i in range(1500)), "x" * 3000, "short one"]
    whole = M.sample_texts(vocab, [1, 2, 3], texts, 2, 1)
    monkeypatch.setattr(M, "SEGMENT", 1000)
    parts = [M.sample_texts(vocab, [k], [t], 2, 1)[0] for k, t in zip((1, 2, 3), texts)]
    for a, b in zip(whole, parts):
        assert [x[0].tobytes() for x in a] == [x[0].tobytes() for x in b]
        assert np.allclose([x[1:3] for x in a], [x[1:3] for x in b])


def total(vocab, text):
    """Log of the summed weight of every segmentation of an ASCII text, and the weight of each piece."""
    cp = M.written(text).tolist()
    pieces = {tuple(ord(c) for c in vocab.text[i].decode().replace(" ", chr(M.SPACE))): w for i, w in zip(vocab.ids, vocab.weight)}
    ahead = [0.0] * (len(cp) + 1)
    for p in range(len(cp) - 1, -1, -1):
        x = [pieces[t] + ahead[p + n] for n in range(1, vocab.longest + 1) if p + n <= len(cp) and (t := tuple(cp[p:p + n])) in pieces]
        ahead[p] = np.logaddexp.reduce([*x, vocab.byte_weight + ahead[p + 1]] if (cp[p],) not in pieces else x)
    return ahead[0], dict(zip(vocab.ids.tolist(), vocab.weight))


RUNS = ["internationalization" * 70, "https://example.com/" + "path/to/the/resource?query=" * 50, "word\nother\n" * 120, "x" * 1500, " " * 1300]


@pytest.mark.parametrize("segment", [1 << 19, 300])
def test_long_runs_without_spaces_are_one_lattice(vocab, monkeypatch, segment):
    monkeypatch.setattr(M, "SEGMENT", segment)
    crossed = 0
    for text in RUNS:
        z, weight = total(vocab, text)
        for key in range(4):
            samples = M.sample_texts(vocab, [key], [text], 3, 1)[0]
            assert len({x[0].tobytes() for x in samples}) == 3 and samples[0][2] >= samples[1][2] >= samples[2][2]
            for x in samples:
                assert vocab.decode(x[0]) == text
                assert abs(sum(weight.get(i, vocab.byte_weight) for i in x[0].tolist()) - z - x[1]) < 1e-6
                crossed += any(a < 512 < a + n for a, n in split(vocab, x[0]))
    assert crossed


def test_parts_and_blocks_of_long_runs_change_nothing(vocab, monkeypatch):
    texts = [*RUNS, "日本語テキスト" * 200 + " and " + "東京都" * 400, "a " * 400 + "ab" * 700 + " c" * 300]
    whole = M.sample_texts(vocab, list(range(len(texts))), texts, 3, 1)
    for name, value in (("FEW", 0), ("BLOCK", 128), ("SEGMENT", 200)):
        monkeypatch.setattr(M, name, value)
        parts = [M.sample_texts(vocab, [k], [t], 3, 1)[0] for k, t in enumerate(texts)]
        for a, b in zip(whole, parts):
            assert [x[0].tobytes() for x in a] == [x[0].tobytes() for x in b]
            assert np.allclose([x[1:] for x in a], [x[1:] for x in b], rtol=1e-7)


def test_round_trip_of_odd_texts(spark, vocab):
    odd = [*ODD, "  two  spaces ", "日本語テキスト", "a▁b ▁", "\t", "é́", "\x00\x7f"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(odd)] + [(None, "null key", "x"), (5, odd[5], "x")], "doc_id long, text string, samples string")
    got = M.sample(df).collect()
    assert len(got) == len(odd) + 2 and all(r.decoded for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.samples)
    assert by[5][0] == by[5][1] and len(by[5][0]) == 2
    assert [len(s.ids) for s in by[0][0]] == [0] and by[0][0][0].inclusion == 1.0
    rows = M.decode(spark.createDataFrame([(i, s[0][0].ids) for i, s in by.items() if i is not None], "doc_id long, ids binary")).collect()
    assert {r.doc_id: r.decoded_text for r in rows} == {i: (t or "") for i, t in enumerate(odd)}
    assert M.sample(df.limit(0)).collect() == []
    assert M.digests(M.sample(df)).where("NOT distinct OR NOT decoded").count() == 0


def test_units_end_where_no_piece_passes(vocab):
    vocab.kept.clear()
    M.sample_texts(vocab, [1], ["one,\ntwo.\nthree (four)\n\n1.\tone"], 2, 1)
    known = vocab.kept.index.count
    M.sample_texts(vocab, [2], ["one.\ntwo,\nthree)\n\n1.\tone"], 2, 1)
    # Known words in another order, joined by other line breaks and marks, are no new units.
    assert vocab.kept.index.count == known > 3
    pieces = {tuple(ord(c) for c in vocab.text[i].decode().replace(" ", chr(M.SPACE))) for i in vocab.ids}
    pairs = {x for p in pieces for x in zip(p, p[1:])}
    cp = M.written("Hello,\nwörld... (日本語) Ёxࠁy\t--\r\n  a▁b " + "http://x.y/z?a=1&b=2")
    begin = M._unit_begins(vocab, cp)
    assert not any(begin[i] for i in range(1, len(cp)) if (cp[i - 1], cp[i]) in pairs) and begin[cp == M.SPACE].any()


def test_samples_across_units_follow_the_lattice(vocab):
    for text in ("a.\nb", "x,\n\ny", "(1)\t2"):
        exact = segmentations(vocab, text)
        for key in range(50):
            r = M.sample_texts(vocab, [key], [text], min(4, len(exact)), 1)[0]
            assert len({x[0].tobytes() for x in r}) == min(4, len(exact)) and all(a[2] >= b[2] for a, b in zip(r, r[1:]))
            assert all(abs(exact[split(vocab, x[0])] - x[1]) < 1e-9 for x in r)
        r = M.sample_texts(vocab, [1], [text], len(exact), 1)[0]
        assert {split(vocab, x[0]) for x in r} == set(exact)


def test_kept_units_change_nothing(vocab, monkeypatch):
    texts = [" ".join(f"item{i * 7 % 300},\nno{i}" for i in range(a, a + 200)) for a in range(0, 1000, 100)] + ["x" * 700]
    keys = list(range(len(texts)))
    whole = M.sample_texts(vocab, keys, texts, 3, 1)
    for arcs, bits in ((0, 20), (2000, 20), (3_000_000, 4)):
        monkeypatch.setattr(M, "KEPT_ARCS", arcs)
        monkeypatch.setattr(M, "_SLOT_BITS", bits)
        fresh = M.Vocabulary() if bits == 20 else vocab
        monkeypatch.setattr(fresh, "kept", M.KeptUnits())
        if bits != 20:
            monkeypatch.setattr(fresh, "index", M.CodeIndex(vocab.index.codes[:vocab.index.count]))
        for _ in range(2):
            parts = [M.sample_texts(fresh, [k], [t], 3, 1)[0] for k, t in zip(keys, texts)]
            for a, b in zip(whole, parts):
                assert [x[0].tobytes() for x in a] == [x[0].tobytes() for x in b]
                assert np.allclose([x[1:] for x in a], [x[1:] for x in b], rtol=1e-9)


def test_codes_in_one_slot_are_told_apart(monkeypatch):
    monkeypatch.setattr(M, "_SLOT_BITS", 3)
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 2**64, 500, np.uint64))
    rng.shuffle(codes)
    index = M.CodeIndex()
    assert index.find(codes[:3]).tolist() == [-1, -1, -1]
    index.add(codes[:150])
    index.add(codes[150:400])
    assert index.find(codes[:400]).tolist() == list(range(400)) and set(index.find(codes[400:]).tolist()) == {-1}
