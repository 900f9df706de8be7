import random

import numpy as np
import pyarrow as pa
import pytest

from helpers import ODD, near_components, random_texts, shingles
from tollgate.llm import minhash as M

SCHEMA = "doc_id long, text string, n long, component_id string, h1 string"


def run(spark, rows, width=2):
    return M.near_duplicates(spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA), width=width).collect()


@pytest.mark.parametrize("width", [2, 5])
def test_components_match_brute_force(spark, width):
    rows = list(enumerate(random_texts(random.Random(width), 150, lines=3, length=25)))
    want = near_components(rows, width)
    assert len(set(want.values())) < 140
    for r in run(spark, rows, width):
        assert (r.n_shingles, r.component_id, r.kept) == (len(shingles(rows[r.doc_id][1], width)), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_small_blocks_give_the_same(spark, monkeypatch):
    base = [f"t{i}" for i in range(60)]
    rng = random.Random(1)
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(60)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    want = near_components(rows, 2)
    monkeypatch.setattr(M, "BUCKET_ROWS", 20)
    monkeypatch.setattr(M, "BLOCK_ROWS", 25)
    assert {r.doc_id: r.component_id for r in run(spark, rows)} == want


def test_odd_rows(spark):
    rows = list(enumerate(ODD)) + [(6, ODD[6]), (None, "a b c d e f"), (None, None)]
    got = run(spark, rows)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    want = near_components(list(enumerate(ODD)), 2)
    assert {k: v.component_id for k, v in by.items()} == want
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (0, 1, 2, 11))
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert by[3].component_id == by[4].component_id == 3 and by[7].component_id == 6
    assert run(spark, []) == []


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 60_000, M.POSITIONS).astype(np.uint16)
    for _ in range(50):
        b = a.copy()
        at = rng.choice(M.INDEXED, M.NEAR_INDEXED, replace=False)
        b[at] ^= 1
        chunks = (a[:M.INDEXED] != b[:M.INDEXED]).reshape(M.CHUNKS, M.CHUNK).sum(1)
        assert chunks.min() <= 1


def test_signature_estimates_similarity():
    x = pa.array([" ".join(f"w{i}" for i in range(1000)), " ".join(f"w{i}" for i in range(100, 1100))])
    sig = M.signatures(*M.sets_of(x, 1))
    assert abs((sig[0] == sig[1]).mean() - 900 / 1100) < 0.12
