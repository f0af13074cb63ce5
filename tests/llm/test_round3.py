"""Fingerprints, whitening and the conversation trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from stationlink.llm import fingerprint, linededup, prefixtrie, whitening

WORDS = "the of and river stone light cold green north house walked slowly under bridge morning water table seven paper glass".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


# ---- conversation trie --------------------------------------------------------------

def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in members[p] if len(full[c]) == len(p)).encode()).hexdigest()) for p in members)


def trie_rows(seed, n=160):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        c = r.choice([i, i, 100 * r.randrange(3), i + 100, -i])
        stem = r.randrange(3)
        for t in range(r.choice([1, 2, 3, 5, 8, 12])):
            text = f"turn {stem} {t}" if t < 6 else prose(r.random(), 3)
            rows.append((c, t, r.choice(["user", "user", None]) if t % 2 else "assistant", r.choice([text, text, text, None, "é日"])))
    # distinct (conv_id, turn) only: ties are ordered by hash
    rows = list({(c, t): (c, t, a, b) for c, t, a, b in rows}.values())
    return [*rows, (7001, None, "user", "null first"), (7001, 0, "user", "then"), (None, 0, "user", "no conversation"), (7002, 5, None, None)]


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(spark, rows, **kw):
    df = spark.createDataFrame([(*x, 1, 2, 3) for x in rows], "conv_id long, turn long, role string, text string, k1 int, depth int, m int")
    out = prefixtrie.conversation_trie(df, **kw)
    assert out.columns == COLS and {t for c, t in out.dtypes if c != "ends_sha256"} == {"bigint"}
    return sorted((tuple(x) for x in out.collect()), key=lambda x: x[:2])


@pytest.mark.parametrize("in_task", [prefixtrie.IN_TASK, 40])
def test_trie_equals_brute_force(spark, in_task):
    rows = trie_rows(3)
    assert trie(spark, rows, in_task=in_task) == brute_trie(rows)


def test_trie_long_conversations_copies_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BLOCK", 8)
    deep = [(c, t, "user", f"t{t}" if t < 40 else f"t{t} {c}") for c in (100, 101, 102) for t in range(70)]
    copies = [(c, t, "user", f"same {t}") for c in range(201, 260) for t in range(8)]
    rows = deep + copies + [(300, 0, "user", "twice")] * 9
    got = trie(spark, rows, in_task=25)
    assert got == brute_trie(rows)
    assert trie(spark, [(5, 0, "user", "x")]) == brute_trie([(5, 0, "user", "x")])


def test_trie_of_nothing(spark):
    assert trie(spark, [(None, 0, "user", "x")]) == []


def test_split_in_task_equals_plain_sums():
    r = random.Random(1)
    for n in (1, 2, 3, 50, 400):
        for shape in ("random", "chain", "star"):
            parent = np.array([-1] + [{"random": r.randrange(v), "chain": v - 1, "star": 0}[shape] for v in range(1, n)])
            leaf, saved = np.array([r.randrange(9) for _ in range(n)]), np.array([r.randrange(9) for _ in range(n)])
            want = np.stack([leaf, saved])
            for v in range(n - 1, 0, -1):
                want[:, parent[v]] += want[:, v]
            got = prefixtrie.split_in_task(np.zeros(n, np.int64), parent, leaf, saved)
            assert (np.stack(got) == want).all()


# ---- whitening ----------------------------------------------------------------------

SCHEMA = "vec_id long, embedding array<float>, label int, n long, w int"


def white(spark, vectors, **kw):
    df = spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], 0, 1, 2) for i, v in vectors], SCHEMA)
    return whitening.whiten(df, **kw).collect()


def check_white(rows, kept, components):
    x = np.floor(1024 * np.array([np.array(v, np.float32) for _, v in kept], np.float64)).astype(np.int64) + 100000
    n = len(x)
    values, vectors = np.linalg.eigh(np.cov(x.T.astype(float), bias=True).reshape(x.shape[1], -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    by = defaultdict(dict)
    for r in rows:
        by[r.component].setdefault(r.vec_id, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
    assert sorted(by) == list(range(1, components + 1)) and len(rows) == n * components
    dev = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    for (i, _), want in zip(kept, dev.tolist(), strict=True):
        assert {r.deviation for r in by[1][i]} == {want}
    for k in range(components):
        z = (x - x.mean(axis=0)) @ vectors[:, k] / math.sqrt(values[k])
        got = np.array([by[k + 1][i][0].whitened for i, _ in kept])
        if np.isclose(values, values[k], rtol=1e-9).sum() == 1:
            assert np.abs(got * np.sign(got @ z) - z).max() < 1e-8
        assert abs(by[k + 1][kept[0][0]][0].explained - values[k] / values.sum()) < 1e-9
    return by


def test_whitening_equals_numpy(spark):
    r = np.random.default_rng(5)
    mix = r.normal(size=(6, 6)) * [3, 2, 1, 1, 0.5, 0.1]
    kept = [(i, (r.normal(size=6) @ mix).tolist()) for i in range(150)]
    kept += [(150, kept[0][1]), (151, [0.0] * 6)]
    odd = [(900, None), (901, [1.0, None, 0, 0, 0, 0]), (902, [float("nan")] * 6), (903, [float("inf"), 0, 0, 0, 0, 0]), (904, []), (905, [1.0, 2.0])]
    check_white(white(spark, kept + odd), kept, 6)
    check_white(white(spark, kept + odd, components=2), kept, 2)


def test_whitening_repeated_roots_constant_dimension_and_repeated_ids(spark):
    """A square's corners: two equal eigenvalues; the third dimension does not vary."""
    kept = [(1, [1.0, 1.0, 4.0]), (2, [1.0, -1.0, 4.0]), (3, [-1.0, 1.0, 4.0]), (4, [-1.0, -1.0, 4.0])]
    by = check_white(white(spark, kept), kept, 2)
    for i, _ in kept:
        assert abs(sum(by[k][i][0].whitened ** 2 for k in (1, 2)) - 2) < 1e-9
    again = white(spark, [(1, kept[0][1]), (1, kept[1][1]), (None, kept[2][1]), (None, kept[3][1])])
    assert len(again) == 8 and all(r.identity_error < 1e-9 for r in again)


def test_whitening_of_nothing_and_of_huge_entries(spark):
    assert white(spark, []) == [] and white(spark, [(1, None)]) == [] and white(spark, [(1, [1.0, 2.0])]) == []
    rows = white(spark, [(i, [1e30 * (i % 2), float(i), 0.5 * (i % 3)]) for i in range(12)])
    assert len(rows) == 36 and rows[0].deviation is None and all(math.isfinite(r.whitened) for r in rows)


def test_characteristic_polynomial(spark):
    whitening.python_workers(spark)
    r = random.Random(2)
    for d, rank in ((1, 1), (3, 3), (6, 4)):
        b = np.array([[r.randrange(-10 ** 9, 10 ** 9) for _ in range(rank)] for _ in range(d)], object)
        a = b.dot(b.T)
        m, want = np.zeros((d, d), object), [0] * d + [1]
        for k in range(1, d + 1):           # Faddeev and LeVerrier
            m = a.dot(m) + want[d - k + 1] * np.eye(d, dtype=int).astype(object)
            want[d - k] = -a.dot(m).trace() // k
        poly = whitening.charpoly(spark, a.tolist())
        assert poly == want and [c != 0 for c in poly[:d - rank]] == [False] * (d - rank)
    # (x - 2)^2 (x - 5): a double root is found as one
    poly = [-20, 24, -9, 1]
    assert [whitening.kth_root(poly, k, 10)[2:] for k in (1, 2, 3)] == [(1, 1), (2, 3), (2, 3)]


# ---- fingerprints -------------------------------------------------------------------

def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest((v & ((1 << 64) - 1)).to_bytes(8, "little"), seed=h)
    return signed(h)


def brute_fingerprint(text):
    import re
    words = [signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return ""
    if len(words) < 5:
        h = 0
        for w in words:
            h = chain([h, w])
        grams = [h]
    else:
        grams = [chain(words[i:i + 5]) for i in range(len(words) - 4)]
    least = {}
    for g in grams:
        b = (g >> 56) + 128
        least[b] = min(least.get(b, g), g)
    out = ""
    for i in range(256):
        k = next(k for k in range(256) if i in least or (fingerprint._STEP[i] * k + fingerprint._START[i]) % 256 in least)
        out += "%x" % (least[i if i in least else (fingerprint._STEP[i] * k + fingerprint._START[i]) % 256] & 15)
    return out


def like(a, b):
    if not a or not b:
        return float(a == b)
    return max(0.0, (sum(x == y for x, y in zip(a, b, strict=True)) / 256 - 1 / 16) / (1 - 1 / 16))


def fingerprint_rows(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, h string, block int, p string")
    return fingerprint.edited_likeness(df).collect()


def check_fingerprints(got, ordered):
    """``ordered``: (id, text) in the order of ids."""
    want = []
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        f, e, n = (brute_fingerprint(x) for x in (t, edited, after))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, round(like(f, e), 9), round(like(f, n), 9)))
    rows = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_fingerprints_equal_brute_force(spark):
    texts = [None, "", " \n\t ", "one", "a b c d", "é ñ 日本 語 x y", "\va b\fc d e f ", "x" * 5000, " ".join(f"w{i}" for i in range(20000)),
             *[prose(i, n) for i, n in enumerate((5, 6, 30, 90, 400))], prose(3, 90).upper(), "same", "same"]
    rows = [(7 * i - 20, t) for i, t in enumerate(texts)]
    check_fingerprints(fingerprint_rows(spark, random.Random(1).sample(rows, len(rows))), rows)
    check_fingerprints(fingerprint_rows(spark, rows[3:4]), rows[3:4])
    assert fingerprint_rows(spark, []) == []


def test_fingerprints_null_and_repeated_ids(spark):
    """Null ids come first, equal ids in the order of the hash of their texts; an id of a
    third of all rows spreads over blocks."""
    def h(t):
        return signed(xxhash.xxh64_intdigest((t or "").encode(), seed=42))
    rows = [(None, "n one"), (None, "n two"), *[(5, prose(i, 8)) for i in range(60)], *[(i, prose(100 + i, 8)) for i in range(6, 60)], (5, None), (2, "x"), (2, "x")]
    check_fingerprints(fingerprint_rows(spark, rows), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h(r[1]))))


def test_likeness_estimates_jaccard(spark):
    pairs = []
    for k in range(60):
        a, b = prose(k, 300).split(), prose(1000 + k, 300).split()
        cut = 5 * k
        pairs.append((k, " ".join(a), " ".join(a[:cut] + b[cut:])))
    df = spark.createDataFrame(pairs, "doc_id long, a string, b string")
    fa, fb = ({r.doc_id: r.fingerprint for r in fingerprint.fingerprints(df, text_col=c).collect()} for c in ("a", "b"))
    errors = []
    for k, a, b in pairs:
        x, y = ({tuple(t.split()[i:i + 5]) for i in range(296)} for t in (a, b))
        errors.append(like(fa[k], fb[k]) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


# ---- line dedup in groups of near copies ----

def _word_edits(a, b, most):
    """Edits of words between two lists, or more than ``most``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != b[j - 1]))
        row = new
    return row[-1]


def test_near_copies_of_a_line_are_not_paired_with_all_others(spark, monkeypatch):
    """Members of a large group that differ from most of it are compared with few lines, and
    the components are those of all pairs."""
    r = random.Random(77)
    vocabulary = ["".join(r.choice("abdefhinorst") for _ in range(r.randint(2, 8))) for _ in range(300)]
    lines = []
    for n, m in ((130, 90), (60, 70)):
        base = [r.choice(vocabulary) for _ in range(m)]
        for _ in range(n):
            w = list(base)
            for _ in range(r.randint(0, 8)):
                k, o = r.randrange(len(w)), r.random()
                w[k:k + 1] = [r.choice(vocabulary)] if o < 0.6 else [] if o < 0.8 else [w[k], r.choice(vocabulary)]
            lines.append(w)
    lines += [[r.choice(vocabulary) for _ in range(40)] for _ in range(50)]
    lines = [x.split() for x in dict.fromkeys(" ".join(w) for w in lines)]
    up = list(range(len(lines)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    links = 0
    for i, x in enumerate(lines):
        for j in range(i):
            t = max(len(x), len(lines[j])) // linededup.WORDS_AN_EDIT
            if abs(len(x) - len(lines[j])) <= t and _word_edits(x, lines[j], t) <= t:
                links += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    compared, link_buckets = [], linededup.link_buckets

    def counting(members, verify, *args, **more):
        def counted(pairs):
            compared.append(pairs.count())
            return verify(pairs)
        return link_buckets(members, counted, *args, **more)
    monkeypatch.setattr(linededup, "link_buckets", counting)
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {x.doc_id: x.kept for x in linededup.line_marks(df).collect()}
    assert got == {i: root(i) == i for i in range(len(lines))}
    assert links > 500 and 80 < sum(not k for k in got.values())
    assert sum(compared) < 4 * len(lines), (compared, links)
