"""Near copies and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np

from pulsefold.llm import components, lempel, superminhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def brute_groups(rows, k):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        s = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets[d] = s
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(2, 5)))
    rows = []
    base = [word() for _ in range(60)]
    for k in range(120):
        w = list(base)
        # From light to heavy edits, so that similarities lie on both sides of the threshold.
        for _ in range(k % 12):
            w[draw.randrange(len(w))] = word()
        rows.append((1000 - k, " ".join(w) if k % 3 else "  ".join(w).upper()))
    for k in range(40):
        rows.append((k, " ".join(word() for _ in range(draw.randint(0, 30)))))
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "two words"), (2004, "Two WORDS"), (2005, "words two"), (2006, rows[0][1])]
    return rows


def test_groups_equal_brute_force(spark, frame):
    rows = near_copies()
    docs = frame("doc_id long, text string, bands string, root string", *[(d, t, "x", "y") for d, t in rows])
    for settings in (superminhash.Settings(), superminhash.Settings(shingle=5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.group(docs, settings).collect()}
        want = brute_groups(rows, settings.shingle)
        assert got == want
        assert len(set(want.values())) > 50


def test_group_edge_rows(spark, frame):
    docs = frame("doc_id long, text string", (None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (3, None), (2, "a b c d e"))
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in superminhash.group(docs).collect())
    assert [x for x in got if x[0] > 0] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    assert [x[2] for x in got if x[0] < 0] == [True]
    kept = superminhash.first_of_groups(docs).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 1, 3]
    assert superminhash.group(docs.limit(0)).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        both, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 50, 50))
        grams = np.concatenate([np.sort(np.concatenate([both, a])), np.sort(np.concatenate([both, b]))])
        sign = superminhash.signatures(grams, np.repeat([0, 1], 350), 2, 128)
        errors.append((sign[0] == sign[1]).mean() - 300 / 400)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05
    few = superminhash.signatures(np.array([7], np.uint64), np.array([0]), 2, 128)
    assert len(set(few[0].tolist())) == 128 and (few[1] == np.iinfo(np.uint64).max).all()


def test_components_of_chains_and_stars(spark, frame):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(frame("a long, b long", *edges)).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(frame("a long, b long")).count() == 0


def brute_passages(rows, n=50):
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    low = {}
    for d, w in words:
        for i in range(len(w) - n + 1):
            key = tuple(w[i:i + n])
            if d is not None:
                low[key] = min(low.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if d is not None and low[tuple(w[i:i + n])] < d:
                gone[i:i + n] = [True] * n
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


def test_passages_equal_brute_force(spark, frame):
    draw = random.Random(8)
    word = lambda: draw.choice("abcdefghij") + draw.choice("éxyz") * draw.randint(0, 3)
    fresh = lambda n: [word() for _ in range(n)]
    shared = [fresh(n) for n in (49, 50, 51, 70, 120)]
    rows = []
    for k in range(60):
        parts = [fresh(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 3)):
            source = draw.choice(shared)
            cut = draw.randint(0, 20)
            parts += [source[cut:], fresh(draw.randint(0, 3))]
        rows.append((k * 37 % 101, draw.choice([" ", "\n", " \t"]).join(sum(parts, []))))
    rows += [(500, None), (501, ""), (502, "the " * 130), (503, "the " * 140), (504, rows[0][1]), (504, rows[0][1]), (505, "\n" + rows[0][1]), (None, rows[0][1])]
    docs = frame("doc_id long, text string, start string, digest string", *[(d, t, "x", "y") for d, t in rows])
    got = sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in lempel.deduplicate(docs).collect()], key=str)
    assert got == brute_passages(rows)
    assert sum(x[2] > 0 for x in got) > 10
    assert lempel.deduplicate(docs.limit(0)).count() == 0


def test_factors(spark, frame):
    found = frame("doc_id long, text_key long, start int, reference long", (9, 1, 4, 2), (9, 1, 5, 2), (9, 1, 6, 3), (9, 1, 60, 3))
    row = lempel.parse(found, lempel.Settings()).first()
    assert list(zip(row.begin, row.length, row.reference)) == [(4, 51, 2), (6, 50, 3), (60, 50, 3)]
