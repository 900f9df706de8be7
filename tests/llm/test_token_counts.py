import random

from helpers import ODD
from tollgate.llm import token_counts as M


def brute(enc, text, sections):
    """Tokens by section: each byte of each token looks for its section."""
    starts, pieces = 0, []
    for i in enc.encode(text):
        pieces.append((starts, starts + int(enc.lengths[i])))
        starts += int(enc.lengths[i])
    at = [len(text[:k].encode()) for k in range(len(text) + 1)]
    spans = [(at[s], at[e]) for s, e in sections]
    counts, crossing, outside = [0] * len(spans), 0, 0
    for a, b in pieces:
        held = [max(0, min(b, e) - max(a, s)) for s, e in spans]
        if not any(held):
            outside += 1
            continue
        counts[held.index(max(held))] += 1
        crossing += max(held) < b - a
    return counts, crossing, outside


def test_attribution_matches_brute_force(spark):
    rng = random.Random(3)
    enc = M.Encoder()
    rows = []
    for i in range(60):
        text = "".join(rng.choice(["hello", " world", "é", "\U0001F600", "  ", "\n", "x1", "."]) for _ in range(rng.randint(0, 40)))
        cuts = sorted(rng.choices(range(len(text) + 1), k=rng.randint(0, 8)))
        spans = [(f"s{k}", a, b) for k, (a, b) in enumerate(zip(cuts[::2], cuts[1::2]))]
        rows.append((i, text, spans, "extra"))
    got = M.count(spark.createDataFrame(rows, "doc_id long, text string, sections array<struct<name:string,start:long,end:long>>, n_tokens string")).collect()
    for r in got:
        text, spans = rows[r.doc_id][1], rows[r.doc_id][2]
        want = brute(enc, text, [(a, b) for _, a, b in spans])
        assert ([s.tokens for s in r.sections], r.crossing, r.outside) == want
        assert r.n_tokens == len(enc.encode(text)) == sum(s.tokens for s in r.sections) + r.outside


def test_white_space_runs_encode_alike():
    e = M.Encoder()
    for s in (" " * 5000 + "a", "x" + "\n" * 5000, "a" + " " * 4999 + "\n" + "b c", "\t" * 6000 + "é"):
        assert e.encode(s) == e.bpe.encode_ordinary(s)
    assert len(e.encode(" " * 400_000)) > 0


def test_odd_rows(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(5, ODD[5]), (None, "null id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = M.op4_token_counts(spark, str(tmp_path)).collect()
    enc = M.Encoder()
    assert len(got) == len(rows) and all(r.outside == 0 for r in got)
    assert all(r.n_tokens == len(enc.encode(dict(rows)[r.doc_id] or "")) for r in got)
    overlapping = [(1, "abc def", [("a", 0, 5), None, ("a", 3, 90), ("z", None, 2), ("e", 4, 4)])]
    r = M.count(spark.createDataFrame(overlapping, "doc_id long, text string, sections array<struct<name:string,start:long,end:long>>")).collect()[0]
    assert [(s.name, s.start, s.end) for s in r.sections] == [("a", 0, 3), ("a", 3, 4), ("e", 4, 4), ("z", 7, 7)]
    assert M.count(spark.createDataFrame([], "doc_id long, text string")).collect() == []
