import hashlib
import math
import random
import re

from helpers import ODD
from tollgate.llm import pii as M

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [(m.start(), 0, f"email:{m.start()}:{m.end()}") for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, f"ip:{m.start()}:{m.end()}") for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    out += [(m.start(), 3, f"phone:{m.start()}:{m.end()}") for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    for alphabet, n in (("ab1.@+- ()9%_\n:é0", 30), ("1234567890 -.+", 40), ("4-0 ", 60)):
        for _ in range(8000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))
            assert ",".join(f"{k}:{s}:{e}" for s, e, k in M.base_spans(t)) == brute(t), t


def test_long_runs_cost_in_proportion():
    for t in ("1" * 300_000, "a" * 300_000, "@" * 100_000, "1." * 100_000, "+1" + " " * 100_000, "a@" * 100_000):
        M.base_spans(t)


def test_terms_that_reveal_an_entity(spark):
    filler = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{filler} note{i} zorblax writes from bob@example.com today {filler}") for i in range(4)] + [(10 + i, f"{filler} plain text {filler}") for i in range(40)]
    got = {r.doc_id: r for r in M.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(4):
        terms = {rows[i][1][s.start:s.end]: s.kind for s in got[i].terms}
        assert terms["zorblax"] == "remove" and "word59" not in terms and f"note{i}" not in terms
    assert all(not got[10 + i].terms for i in range(40))
    clean = {r.doc_id: r.text for r in M.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "zorblax" not in clean[0] and "[EMAIL]" in clean[0] and clean[10] == rows[4][1]


def test_odd_rows(spark, tmp_path):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(30, "mail a.b@c.de and 10.0.0.1", "s")] * 2 + [(None, "mail a.b@c.de", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(str(tmp_path / "documents.parquet"))
    got = M.op3_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = next(t for d, t, _ in rows if d == r.doc_id) or ""
        assert r.base_sha256 == hashlib.sha256(brute(t).encode()).hexdigest()
    assert sorted((r.n_email, r.n_ip) for r in got if r.doc_id == 30) == [(1, 1), (1, 1)]
    assert M.detect(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_that_share_an_id_or_have_none_are_sanitised_by_their_own_text(spark):
    rows = [(1, "mail a@b.cc"), (1, "10.0.0.1 is up, ask x.y@z.org"), (None, "mail a.b@c.de now"), (None, "call +49 30 1234567 now"), (2, "mail a@b.cc"), (2, "mail a@b.cc"), (3, None)]
    got = sorted(((r.doc_id, r.text) for r in M.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert len(got) == len(rows)
    for _, text in got:
        assert text is None or "@" not in text and "10.0" not in text and "1234" not in text
    assert all("[EMAIL]" in t for d, t in got if d in (1, 2))


def counted(rows):
    """Flagged (entity, term) pairs by plain counting over windows."""
    n, n_te, n_e, total = {}, {}, {}, 0
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        total += len(words)
        for w in words:
            n[w] = n.get(w, 0) + 1
        spans = M.base_spans(t or "")
        for entity, terms in M.contexts(t or "", spans):
            n_e[entity] = n_e.get(entity, 0) + 1
            for s, e in terms:
                k = (entity, t[s:e].lower())
                n_te[k] = n_te.get(k, 0) + 1
    out = {}
    for (entity, w), both in n_te.items():
        p = min(1, n_e[entity] * 2 * M.WINDOW / max(1, total))
        if p < 1:
            sure = n[w] ** 2 / (n[w] ** 2 + M.PRIOR)
            q = sure * min(1, both / n[w]) + (1 - sure) * p
            d = 1 - math.log(q) / math.log(p)
            if d >= M.GENERALISE:
                out[entity, w] = "remove" if d >= M.REMOVE else "generalise"
    return out


def test_disclosure_matches_plain_counting(spark):
    rng = random.Random(7)
    v = ["w%d" % i for i in range(3000)]
    people = ["p%d@mail.org" % i for i in range(12)] + ["10.1.2.%d" % i for i in range(5)]
    rows = []
    for i in range(250):
        w = rng.choices(v, k=rng.randint(5, 200))
        for _ in range(rng.randint(0, 2)):
            j = rng.randrange(len(people))
            w[rng.randrange(len(w)):0] = [f"secret{j}", people[j]] if rng.random() < 0.7 else [people[j]]
        rows.append((i if i % 9 else None, " ".join(w)))
    rows += [(1000, rows[5][1])] * 40  # a group of copies
    want = counted(rows)
    assert any(k == "remove" for k in want.values()) and len(want) > 10
    got = M.detect(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    by_text = {}
    for i, t in rows:
        by_text.setdefault(i, []).append(t)
    for r in got:
        texts = by_text[r.doc_id]
        expect = []
        for t in texts:
            marks = {}
            for entity, terms in M.contexts(t, M.base_spans(t)):
                for s, e in terms:
                    kind = want.get((entity, t[s:e].lower()))
                    if kind:
                        marks[s, e] = max(kind, marks.get((s, e), ""))
            expect.append(sorted((s, e, k) for (s, e), k in marks.items()))
        assert sorted((x.start, x.end, x.kind) for x in r.terms) in expect


def test_one_context_at_full_disclosure_is_flagged(spark):
    """In a corpus of size a term seen once, beside one email, passes the threshold."""
    filler = " ".join(f"f{i % 500}" for i in range(60_000))
    rows = [(1, "zorblax writes from bob@example.com"), (2, filler), (3, filler)]
    got = {r.doc_id: r for r in M.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {rows[0][1][x.start:x.end] for x in got[1].terms} == {"zorblax", "writes", "from"}
