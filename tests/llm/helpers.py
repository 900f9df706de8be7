"""Brute-force versions that the operators' tests compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def similar(a, b, percent=80):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= percent * (len(a) + len(b) - common)


def components(ids, linked):
    """id -> smallest id reachable, for a symmetric predicate on positions."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = root(ids[i]), root(ids[j])
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_components(rows, width):
    """doc_id -> component of (doc_id, text) rows."""
    sets = [shingles(t, width) for _, t in rows]
    return components([i for i, _ in rows], lambda i, j: similar(sets[i], sets[j]))


def removed_lines(rows, percent=80):
    """(doc_id, line) of lines that an earlier line of (doc_id, text) rows repeats."""
    lines = [(d, n, set(words(x))) for d, t in sorted(rows) for n, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    return {(d, n) for i, (d, n, s) in enumerate(lines) if any(similar(s, o, percent) for _, _, o in lines[:i])}


def random_texts(rng, n, vocabulary=400, lines=4, length=12):
    """Texts with copies, near copies and repeated lines."""
    v = ["w%d" % i for i in range(vocabulary)]
    shared = [" ".join(rng.choices(v, k=length)) for _ in range(3)]
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.15:
            t = rng.choice(out)
        elif out and kind < 0.5:
            w = re.split(r"( |\n)", rng.choice(out))
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(0, len(w), 2)] = rng.choice(v)
            t = "".join(w)
        else:
            t = "\n".join(rng.choice(shared) if rng.random() < 0.2 else " ".join(rng.choices(v, k=rng.randint(1, length))) for _ in range(rng.randint(1, lines)))
        out.append(t)
    return out


#: Texts that every text operator must take.
ODD = [None, "", " \n\t ", "one", "One", "two words", "a b c d e f", "a b c d e f", "x" * 50_000, "long " * 30_000 + "end", "naïve ▁ \U0001F600 text", "\n\n\n"]
