import hashlib
import random
import re

from pyspark.sql import functions as F

from tollgate.llm import chat_format as M

PARTS = "conv_id long, turn long, role string, parts array<%s>" % M.PART


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_parts_become_ordered_placeholders(spark):
    rows = [(1, 0, "user", [part("text", "see <"), part("image", ref="a.png", width=28, height=29), part("text", "| and"), None,
                            part("audio", ref="b.wav", seconds=2.0), part("pdf", ref="c.pdf", pages=3), part("image", ref="d.png")]),
            (1, 1, "assistant", None)]
    got = M.format_turns(spark.createDataFrame(rows, PARTS)).orderBy("turn").collect()
    assert got[0].formatted == "<|im_start|>user\nsee <|lt|><|image:1|>| and<|audio:2|><|document:3|><|image:4|><|im_end|>\n"
    assert [(a.place, a.kind, a.ref, a.tokens) for a in got[0].attachments] == [(1, "image", "a.png", 6), (2, "audio", "b.wav", 50), (3, "document", "c.pdf", 1536), (4, "image", "d.png", 1)]
    assert got[0].expanded_tokens == 1593 and got[0].loss_start is None
    assert got[1].formatted == "<|im_start|>assistant\n<|im_end|>\n" and got[1].loss_length == 0


def digests(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, body string")
    formatted = M.format_turns(df.withColumn("parts", M.text_parts(F.col("text"))))
    return {r.conv_id: r for r in M.conversation_digests(M.read_turns(formatted)).collect()}


def test_round_trip_of_control_strings(spark):
    rng = random.Random(5)
    bits = ["<", "|", ">", "<|", "|>", M.START, M.END, M.ESCAPED, M.NEWLINE, "\n", "é", "a", "\U0001F600", "assistant"]
    rows = [(c, t, rng.choice(["user", "assistant", "a<|b\nc", "system"]), "".join(rng.choices(bits, k=rng.randint(0, 12))), "x") for c in range(60) for t in range(4)]
    got = digests(spark, rows)
    for c in range(60):
        mine = [r for r in rows if r[0] == c]
        loss = "".join(r[3] for r in mine if r[2] == "assistant")
        assert got[c].n_turns == 4
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in mine).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", None, None), (1, 0, "assistant", "b", None), (1, 0, "assistant", "b", None), (1, None, None, "z", None), (None, 1, "assistant", "n" * 50_000, None)]
    got = digests(spark, rows)
    assert got[1].turns_sha256 == hashlib.sha256(b"\nz\nassistant\nb\nassistant\nb\nuser\n\n").hexdigest()
    assert got[1].loss_chars == 2 and got[None].loss_chars == 50_000
    assert digests(spark, []) == {}


def test_injected_control_strings_stay_text(spark, tmp_path):
    spark.createDataFrame([(7, 0, "user", "hi", "extra")], "conv_id long, turn long, role string, text string, parts string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in M.op1_chat_format(spark, str(tmp_path)).collect()}
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len(M.INJECTION)
    assert got[-1].loss_sha256 == hashlib.sha256(M.INJECTION.encode()).hexdigest()


def test_references_in_texts_become_parts_and_come_back(spark):
    rng = random.Random(6)
    bits = ["![a](b.png)", "![x y](http://h/s.WAV)", "![](doc.pdf)", "![no](", "<", "|", "<|image:1|>", M.ESCAPED, " ", "\n", "text", "![q](<|document:2|>)"]
    rows = [(c, t, rng.choice(["user", "assistant"]), "".join(rng.choices(bits, k=rng.randint(0, 9))), "x") for c in range(50) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, body string")
    formatted = M.format_turns(df.withColumn("parts", M.parse_parts(F.col("text"))))
    got = {r.conv_id: r for r in M.conversation_digests(M.read_turns(formatted)).collect()}
    kind = lambda r: "image" if r.lower().endswith(".png)") else "audio" if r.lower().endswith(".wav)") else "document"
    for c in range(50):
        mine = [r for r in rows if r[0] == c]
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in mine).encode()).hexdigest()
        loss = "".join(r[3] for r in mine if r[2] == "assistant")
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        refs = ["".join(f"{kind(x)}:{i + 1}:{x}\n" for i, x in enumerate(re.findall(M.REFERENCE, r[3]))) for r in mine]
        assert got[c].refs_sha256 == hashlib.sha256("".join(refs).encode()).hexdigest()
        assert got[c].n_attachments == got[c].expanded_tokens == sum(x.count("\n") for x in refs)


def test_references_match_sql(spark, tmp_path):
    import duckdb

    rows = [(1, 0, "user", "see ![a](b.png) and <![c](d.mp3)"), (1, 1, "assistant", "a <"), (2, 0, "assistant", "![x](y.pdf)![z](w.gif)"), (3, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = M.op1_chat_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.sql(M.SQL)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[i] for i in order) for r in want.fetchall())
