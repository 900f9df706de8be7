import random

from helpers import ODD, words
from tollgate.llm import tiling as M


def greedy(a, b, width=5):
    """Brute-force greedy string tiling of word lists: words of ``b`` under tiles."""
    ma, mb = [False] * len(a), [False] * len(b)
    while True:
        best = (width - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < width:
            return sum(mb)
        for x in range(best[0]):
            ma[best[1] + x] = mb[best[2] + x] = True


def test_coverage_matches_brute_force(spark):
    rng = random.Random(6)
    v = [f"w{i}" for i in range(30)]
    items = [" ".join(rng.choices(v, k=rng.randint(3, 30))) for _ in range(6)]
    docs = []
    for _ in range(40):
        parts = [" ".join(rng.choices(v, k=rng.randint(0, 15)))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items).split()
            a = rng.randrange(len(w))
            parts.append(" ".join(w[a:a + rng.randint(3, 25)]).upper())
        rng.shuffle(parts)
        docs.append("\n".join(parts))
    found = M.coverage(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    got = {(r.doc_id, r.item_id): round(r.coverage, 9) for r in found.collect()}
    want = {}
    for d, t in enumerate(docs):
        for i, x in enumerate(items):
            w = words(x)
            share = greedy(words(t), w) / len(w) if len(w) >= M.MATCH else 0
            if share >= M.THRESHOLD:
                want[d, i] = round(share, 9)
    assert len(want) > 20 and got == want


def test_periodic_items_are_caught(spark):
    items = ["one two three four five " * 13, "yes no " * 13, "spam " * 13, "la di da " * 20, "a b c d e f g h i j k l m n o p q r s t u v w x y z"]
    docs = [*(f"some words before {x} and some after" for x in items), "yes no yes no yes", "spam " * 5, "spam " * 6, "clean " * 50]
    found = M.coverage(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    got = {(r.doc_id, r.item_id): round(r.coverage, 9) for r in found.collect()}
    share = {(d, i): greedy(words(t), words(x)) / len(words(x)) for d, t in enumerate(docs) for i, x in enumerate(items)}
    assert all(share[i, i] == 1.0 for i in range(len(items)))
    assert got == {k: round(v, 9) for k, v in share.items() if v >= M.THRESHOLD}


def test_reordered_passages_are_caught(spark):
    item = " ".join(f"q{i}" for i in range(40))
    w = item.split()
    doc = " ".join(["x y z", *w[30:], "filler words", *w[10:20], "more", *w[:10], "and", *w[20:30]])
    r = M.coverage(spark.createDataFrame([(1, doc), (2, "clean " * 50)], "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert [(x.doc_id, x.item_id, x.coverage) for x in r] == [(1, 9, 1.0)]


def test_odd_rows(spark, tmp_path):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(6, ODD[6], 1), (None, "a b c d e f", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, code long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "A B C D E F"), (0, "a b c d e f"), (2, None), (3, ""), (4, "two words"), (None, "a b c d e f")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = M.op5_tiling(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    hit = [r for r in got if r.contaminated]
    assert sorted(r.doc_id for r in hit) == [6, 6, 7] and all((r.n_items, r.item_id, r.coverage) == (2, 0, 1.0) for r in hit)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert M.coverage(docs, none).collect() == []
    assert M.coverage(docs.limit(0), spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")).collect() == []
