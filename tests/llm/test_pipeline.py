"""Every stage on its own input against brute force, at the smallest scale."""

import random

import corpus_pipeline as P
from conftest import sf_dir
from helpers import ODD, near_components, random_texts, removed_lines, words
from tollgate.llm import line_dedup, minhash, tiling, toxicity
from tollgate.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "minhash", "decontamination", "sentencepiece"] and P.ORACLE_SQL is None


def test_stages_on_the_smallest_tables(spark):
    d = sf_dir("0.001")
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    bench = [words(r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    for name, stage in P.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        given, docs = docs, scratch.keep(stage(spark, docs, d))
        if name != "sentencepiece":
            assert docs.columns == COLUMNS
        after = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            model = toxicity.fit(given, spark.read.parquet(f"{d}/labels.parquet"))
            assert set(after) == {r.doc_id for r in toxicity.score(given, model).where("score < 0.3").collect()}
        elif name == "line_dedup":
            gone = removed_lines(list(before.items()))
            want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in before.items()}
            touched = {i for i, _ in gone}
            assert {i: r.text for i, r in after.items()} == {i: t for i, t in want.items() if i not in touched or words(t)}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "minhash":
            assert set(after) == {i for i, c in near_components(sorted(before.items()), 5).items() if i == c}
        elif name == "decontamination":
            for i in set(before) - set(after):
                w = " ".join(words(before[i]))
                assert any(" ".join(b[k:k + 5]) in w for b in bench for k in range(len(b) - 4))
            assert not any(" ".join(b) in " ".join(words(before[i])) for i in after for b in bench)
        else:
            assert set(after) == set(before) and all(r.decoded and r.distinct for r in after.values())


def test_odd_documents_pass_through(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, t, None, "s", len(t or "")) for i, t in enumerate(ODD)] + [(None, "null id text", "en", None, 12), (3, "one", "en", "s", 3)]
    rows += [(100 + i, t, "en", "s", len(t)) for i, t in enumerate(random_texts(rng, 30))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(100, 0), (101, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(f"b{i}" for i in range(20)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = P.run(spark, str(tmp_path)).collect()
    assert {None, 0, 1, 2, 3} <= {r.doc_id for r in out} and all(r.decoded for r in out)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []


def test_rows_that_share_an_id_are_told_by_their_text(spark):
    rng = random.Random(8)
    v = [f"v{i}" for i in range(900)]
    para = lambda n=40: " ".join(rng.choices(v, k=n))
    first, other, near = para(), para(), para(60)
    item = para(20)
    rows = [(1, first), (2, first), (2, other), (5, near), (5, near + " tail"), (5, para()), (None, first), (None, para()), (7, f"{item} {para(5)}"), (7, para()), (8, "same"), (8, "same")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in minhash.keep_one(docs).collect()), key=repr)
    want = [x for x in rows if x not in ((2, first), (None, first))]
    gone = {(5, near), (5, near + " tail")}
    assert sorted((x for x in want if x not in gone), key=repr) == [x for x in kept if x not in gone] and len(gone & set(kept)) == 1
    lines = sorted(((r.doc_id, r.text) for r in line_dedup.dedup(docs).collect()), key=repr)
    assert (2, other) in lines and (2, first) not in lines and (None, first) not in lines and (1, first) in lines and sum(i == 5 for i, _ in lines) == 2
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = [(r.doc_id, r.text) for r in tiling.keep_clean(docs, bench).collect()]
    assert sorted(clean, key=repr) == sorted((x for x in rows if not x[1].startswith(item)), key=repr)
