import random

import numpy as np
import pytest

from helpers import ODD, random_texts, removed_lines, words
from tollgate.llm import line_dedup as M
from tollgate.llm.common import Scratch

SCHEMA = "doc_id long, text string, n_chars long, line string, h1 long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "x", 1) for d, t in rows], SCHEMA)


def got(spark, rows):
    _, removed = M.removed_lines(frame(spark, rows), Scratch(spark))
    return {(r.doc_id, r.line) for r in removed.collect()}


def test_removed_lines_match_brute_force(spark):
    rows = list(enumerate(random_texts(random.Random(4), 160, vocabulary=150)))
    want = removed_lines(rows)
    assert 50 < len(want) and got(spark, rows) == want


@pytest.mark.parametrize("name,value", [("HOT", 3), ("WIDE", 2), ("BLOCK_ROWS", 5), ("FLUSH_POSTINGS", 7)])
def test_limits_change_nothing(spark, monkeypatch, name, value):
    rows = list(enumerate(random_texts(random.Random(8), 80, vocabulary=60)))
    monkeypatch.setattr(M, name, value)
    assert got(spark, rows) == removed_lines(rows)


def test_odd_texts_and_dedup(spark):
    rows = list(enumerate(ODD)) + [(20, "keep this line\nOne\nx y\n\nx y"), (None, "one"), (20, "keep this line\nOne\nx y\n\nx y")]
    out = M.dedup(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "n_chars", "line", "h1"]
    kept = out.collect()
    texts = {r.doc_id: r.text for r in kept}
    assert [r.text for r in kept if r.doc_id == 20] == ["keep this line\nx y\n"] * 2
    assert all(r.n_chars == len(r.text or "") for r in kept)
    assert texts[0] is None and texts[1] == "" and texts[2] == " \n\t " and texts[None] == "one"
    assert 3 in texts and 4 not in texts and 6 in texts and 7 not in texts
    assert M.dedup(frame(spark, [])).collect() == []


def test_prefixes_keep_every_similar_pair():
    rng = random.Random(1)
    counters = np.zeros(1 << M.BITS, np.int32)
    import pyarrow as pa
    base = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(60):
        w = [x for x in base if rng.random() > 0.05] + [f"e{rng.randrange(999)}" for _ in range(rng.randint(0, 4))]
        texts.append(" ".join(w))
    codes, bounds, _, _ = M.line_sets(pa.array(texts))
    line, word, at, _ = M.prefixes(codes, bounds, counters, 80)
    pre = [set(word[line == i].tolist()) for i in range(60)]
    sets = [set(words(t)) for t in texts]
    pairs = 0
    for i in range(60):
        assert len(pre[i]) == len(sets[i]) - -(-80 * len(sets[i]) // 100) + 1
        for j in range(i):
            c = len(sets[i] & sets[j])
            if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                pairs += 1
                assert pre[i] & pre[j]
    assert pairs > 50
