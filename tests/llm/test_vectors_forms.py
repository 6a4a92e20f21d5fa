"""Whitening, fill-in-the-middle and SimHash against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from helpers import empty, strange

from loomdex.llm import fim, simhash, whitening
from loomdex.llm.common import table
from loomdex.llm.queries import QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


# fill in the middle


def plain_form(doc_id, text, seed=42):
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def digested(row):
    return (*row[:5], row[5], *(hashlib.sha256(t.encode()).hexdigest() for t in row[5:]))


@pytest.mark.parametrize("size", [1 << 16, 7, 1])
def test_forms_equal_plain_ones_at_every_frame_size(spark, size):
    r = random.Random(5)
    parts = ["a", "é", "漢字", "🙂", " ", "  ", "\n", "\t", "\x0b", " ", "word", "<", "<P", "S>", "x" * 40]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " \n "), (None, "no id here"), (903, "a <M> b"), (904, "y" * 300), (904, "y" * 300), (905, "é" * 200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = fim.outputs(fim.fill_in_middle(fim.frame_store(docs, size))).collect()
    assert Counter(tuple(x) for x in got) == Counter(digested(plain_form(*row)) for row in rows)
    assert len({x.form for x in got}) == 3


def test_forms_of_whole_table_equal_plain_ones(spark, data):
    rows = table(spark, data, "documents").select("doc_id", "text").collect()
    want = Counter((*x[:5], *x[6:]) for x in (digested(plain_form(*row)) for row in rows))
    assert Counter(tuple(x) for x in QUERIES["op12_fill_in_middle"](spark, data).collect()) == want


def test_only_cut_frames_are_compressed_anew():
    import zstandard

    data = ("word " * 4000).encode()
    units, rows = fim.framed(np.frombuffer(data, np.uint8), zstandard.ZstdCompressor(), 1000)
    frames = fim.Frames(*map(list, zip(*rows)))
    assert units == 4001 and len(frames.data) in (20, 21)
    a, b = frames.cut(501)[0], frames.cut(1502)[0]
    whole = [w for _, w in frames.parts(a, b)]
    assert whole.count(False) == 2 and not whole[0] and not whole[-1]
    assert b"".join(frames.span(a, b)) == data[a:b] and data[:a].split() == ["word".encode()] * 501


def test_forms_of_strange_rows(spark):
    docs = strange(spark, "one two three")
    got = fim.outputs(fim.fill_in_middle(fim.frame_store(docs))).collect()
    assert Counter(tuple(x) for x in got) == Counter(digested(plain_form(r.doc_id, r.text)) for r in docs.collect())
    assert fim.outputs(fim.fill_in_middle(fim.frame_store(empty(spark)))).count() == 0


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, limit=4):
    """Smallest place of each one's component."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= limit:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(fps))]


def crowd(seed, centres, n, flips):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        x = r.choice(base)
        for _ in range(r.randint(0, flips)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out, key=lambda x: r.random())


def as_longs(fps):
    return [x - (1 << 64) if x >> 63 else x for x in fps]


def partition(nodes, roots):
    out: dict = {}
    for a, b in zip(nodes, roots):
        out.setdefault(b, set()).add(a)
    return {frozenset(v) for v in out.values()}


@pytest.mark.parametrize("seed", range(4))
def test_gray_index_connects_what_brute_force_does(seed):
    fps = crowd(seed, 3 + 20 * seed, 700, 9)
    u, v = simhash.connect(np.array(fps, np.uint64))
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(u.tolist(), v.tolist()):
        root[find(a)] = find(b)
    assert partition(fps, [find(x) for x in fps]) == partition(fps, plain_components(fps))


def test_gray_rank_orders_codes_that_differ_in_one_bit():
    order = np.argsort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert all((int(a) ^ int(b)).bit_count() == 1 for a, b in zip(order, order[1:]))


def test_search_leaves_whole_groups():
    fps = np.array(crowd(1, 400, 4000, 3), np.uint64)
    index = simhash.GrayIndex(fps)
    visited = []
    below = index._below
    index._below = lambda who, *rest: (lambda out: (visited.append(len(out[0])), out)[1])(below(who, *rest))
    index.near(np.arange(100), 4)
    assert visited[-1] < 0.5 * 100 * len(fps)  # of codes with few bits in common; all pairs would be 1


@pytest.mark.parametrize("group", [8192, 40, 6])
def test_links_connect_what_brute_force_does_at_every_group_size(spark, group):
    fps = crowd(7, 6, 400, 7) + [0, 1, (1 << 64) - 1]
    fps = list(dict.fromkeys(fps))
    from loomdex.llm.components import components

    found = components(simhash.links(spark.createDataFrame([(x,) for x in as_longs(fps)], "fp long"), 4, group))
    root = {r.node: r.root for r in found.collect()}
    got = partition(fps, [root.get(x, x) for x in as_longs(fps)])
    assert got == partition(fps, plain_components(fps))


def test_components_of_whole_table_equal_brute_force(spark, data):
    rows = sorted((r.doc_id, r.text) for r in table(spark, data, "documents").collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    want = {(rows[i][0], f"{fps[i]:016x}", rows[c][0]) for i, c in enumerate(plain_components(fps))}
    got = QUERIES["op13_simhash_near_dedup"](spark, data).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(rows)


def test_fingerprints_of_strange_rows(spark, monkeypatch):
    docs = strange(spark, "One two three four five\x0bsix")
    rows = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    assert Counter((x.doc_id, x.fingerprint) for x in got) == Counter((r.doc_id, f"{plain_fingerprint(r.text):016x}") for r in rows)
    assert {x.component_id for x in got if x.fingerprint == "0" * 16} == {2}
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.near_duplicates(spark.createDataFrame([(None, "a b c d")], SCHEMA)).first().component_id is None
    long = " ".join(random.Random(2).choice(["a", "bb", "C", "é,"]) for _ in range(3000))
    want = plain_fingerprint(long)
    monkeypatch.setattr(simhash, "SLICE", 50)
    assert simhash.fingerprint(long.encode()) == want and simhash.fingerprint(b"a b c") == plain_fingerprint("a b c")


# whitening


def exact_determinant(matrix):
    a = [[Fraction(v) for v in row] for row in matrix]
    out = Fraction(1)
    for k in range(len(a)):
        pivot = next((i for i in range(k, len(a)) if a[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            a[k], a[pivot], out = a[pivot], a[k], -out
        out *= a[k][k]
        for i in range(k + 1, len(a)):
            f = a[i][k] / a[k][k]
            a[i] = [x - f * y for x, y in zip(a[i], a[k])]
    return out


def test_polynomial_is_the_determinant(spark):
    rng = np.random.default_rng(3)
    for d in (1, 2, 5, 9):
        x = rng.integers(-300, 300, (d + 3, d))
        m = (x.T @ x).tolist()
        found = whitening.characteristic(spark, m)
        for at in (-3, 0, 7, 1000):
            shifted = [[(at if i == j else 0) - m[i][j] for j in range(d)] for i in range(d)]
            assert sum(c * at**k for k, c in enumerate(found)) == exact_determinant(shifted)


def test_roots_with_repeats_and_zeros():
    roots = [7, 7, 7, 3, 0, 0, 10**12, 1]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    solver = whitening.RealRoots(poly)
    assert solver.count == 6
    for rank, want in enumerate([10**12, 7, 7, 7, 3, 1], 1):
        place, shift = solver.root(rank)
        assert abs(Fraction(place, 1 << shift) - want) <= Fraction(want, 2**200)
    close = whitening.RealRoots([10**40 + 10**20, -(2 * 10**20 + 1), 1])  # 10^20 and 10^20 + 1
    assert [round(Fraction(p, 1 << s)) for p, s in (close.root(1), close.root(2))] == [10**20 + 1, 10**20]


def plain_whitening(rows, size):
    """n, deviation by vector, eigenvalues and absolute whitened values by numpy."""
    kept = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows if v and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    different = sorted({x for _, x in kept})
    n, sums = len(different), [sum(c) for c in zip(*different)]
    x = np.array(different, float)
    x = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(x.T @ x / n)
    mean = np.array(sums) / n
    out = {}
    for i, v in kept:
        white = [abs((np.array(v) - mean) @ vectors[:, -k]) / math.sqrt(values[-k]) for k in (1, 2, 3, 4)]
        out[i] = (sum((n * a - s) ** 2 for a, s in zip(v, sums)), white)
    return n, out, [values[-k] / values.sum() for k in (1, 2, 3, 4)]


def test_whitening_of_whole_table_equals_plain_one(spark, data):
    vectors = table(spark, data, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    size = Counter(len(v) for _, v in rows if v).most_common(1)[0][0]
    n, want, explained = plain_whitening(rows, size)
    got = QUERIES["op11_embedding_whitening"](spark, data).collect()
    assert len(got) == 4 * len(want)
    for r in got:
        deviation, white = want[r.vec_id]
        assert r.n == n and r.deviation == deviation and r.identity_error < 1e-10
        assert abs(abs(r.whitened) - white[r.component - 1]) < 1e-8 and abs(r.explained - explained[r.component - 1]) < 1e-12


def test_whitening_of_strange_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100, None), (101, []), (102, [1.0] * 5), (103, [1.0, None, 0.0, 0.0, 0.0, 0.5]), (104, [math.nan] * 6), (105, [math.inf] * 6)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (106, [1e300] + [0.0] * 5), (107, [200.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, size int")
    got = whitening.whiten(docs).collect()
    usable = [r for r in rows if r[0] is None or r[0] < 100 or r[0] == 107]
    n, want, _ = plain_whitening(usable, 6)
    assert n == 61 and Counter(r.vec_id for r in got) == Counter(i for i, _ in usable for _ in range(4))
    assert all(int(r.deviation) == want[r.vec_id][0] and abs(abs(r.whitened) - want[r.vec_id][1][r.component - 1]) < 1e-8 for r in got)
    white = np.array([[r.whitened for r in sorted(got, key=lambda r: r.component) if r.vec_id == i] for i in (*range(60), 107) if i != 1])
    assert whitening.whiten(docs.where("false")).count() == 0
    assert white.shape[1] == 4


def test_whitening_without_variance_and_with_equal_eigenvalues(spark):
    schema = "vec_id long, embedding array<float>"
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema)).collect()
    found = sorted((r.component, r.vec_id) for r in one)
    assert found == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert {(r.n, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one} == {(1, None, None, None, 0)}
    cross = [(i, [1.0 * (i == 0) - (i == 1), 1.0 * (i == 2) - (i == 3), 1.0 * (i == 4) - (i == 5), 0.0]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(cross, schema)).collect()
    assert all(r.identity_error < 1e-12 and (r.whitened is None) == (r.component == 4) for r in got)
    assert sorted({round(r.explained, 12) for r in got}) == [0.0, round(1 / 3, 12)]
    wide = [(i, [float(2**40 * i), 1.0]) for i in range(5)]
    far = whitening.whiten(spark.createDataFrame(wide, "vec_id long, embedding array<double>"), 2).collect()
    assert {r.vec_id: int(r.deviation) for r in far}[0] == (10 * 2**48) ** 2
