"""Whitening, periodic runs and exact duplicates against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import brute
from odd_rows import ODD, rows
from quarry.llm import exactdedup, periodicruns, queries, whitening

SF = "/root/testdata/sf0.001"


# --- whitening ----------------------------------------------------------------

def _usable(vectors):
    """[(id, x)] of the vectors that count, x by the rule of the query."""
    good = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = defaultdict(int)
    for _, v in good:
        sizes[len(v)] += 1
    best = max(sizes, key=lambda s: (sizes[s], s))
    return [(i, [math.floor(64 * c) + 1000000 for c in v]) for i, v in good if len(v) == best]


def _check_whitening(got, vectors, count=32):
    used = _usable(vectors)
    n, size = len(used), len(used[0][1])
    total = [sum(v[k] for _, v in used) for k in range(size)]
    x = np.array([v for _, v in used], float)
    away = x - np.array(total) / n
    cov = away.T @ away / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, min(count, size) + 1)) and all(len(v) == n for v in by.values())
    deviation = {tuple([i, sum((n * c - s) ** 2 for c, s in zip(v, total))]) for i, v in used}
    for k, of in by.items():
        assert {(r.vec_id, r.deviation) for r in of} == deviation and {r.n for r in of} == {n}
        assert all(abs(r.explained - values[k - 1] / np.trace(cov)) <= 1e-9 for r in of)
    return used, away, values, basis, by


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in table.collect()]
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    used, away, values, basis, by = _check_whitening(got, vectors)
    place = {i: k for k, (i, _) in enumerate(used)}
    z = np.zeros((len(used), 32))
    for k, of in by.items():
        for r in of:
            z[place[r.vec_id], k - 1] = r.whitened
    want = away @ basis[:, :32] / np.sqrt(values[:32])
    sign = np.sign((z * want).sum(axis=0))
    assert np.abs(z * sign - want).max() < 1e-8
    assert np.abs(z.T @ z / len(z) - np.eye(32)).max() < 1e-10 and {r.identity_error < 1e-10 for r in got} == {True}


def test_whitening_of_odd_rows(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.gauss(0, 1) * (k + 1) for k in range(5)]) for i in range(40)]
    vectors += [(3, vectors[3][1]), (None, [1.0] * 5), (50, None), (51, []), (52, [1.0, None, 2.0, 3.0, 4.0]),
                (53, [float("nan")] * 5), (54, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (55, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "l", 1, 2.0, "p") for i, v in vectors],
                               "vec_id long, embedding array<double>, label string, component int, whitened double, part string").repartition(4)
    got = whitening.whitened(df).collect()
    used, *_ = _check_whitening(got, vectors)
    assert sorted({r.vec_id for r in got}, key=str) == sorted({i for i, _ in used}, key=str)
    assert max(r.identity_error for r in got) < 1e-9
    # no rows, no variance, a single row, entries that no long holds
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(df.where("embedding is null")).count() == 0
    for same in ([(1, [1.0, 2.0])] * 3, [(1, [1.0, 2.0])]):
        flat = whitening.whitened(spark.createDataFrame(same, "vec_id long, embedding array<float>")).collect()
        assert {(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in flat} == {(1, 0, None, 0.0, 0.0), (2, 0, None, 0.0, 0.0)}
    huge = whitening.whitened(spark.createDataFrame([(i, [1e300 if i else -1e300]) for i in range(3)], "vec_id string, embedding array<double>"))
    assert huge.count() == 3 and huge.where("whitened is null").count() == 0


def test_deviation_that_no_long_holds():
    x = np.array([[2 ** 30], [-2 ** 30]])
    assert whitening.deviations(x, 2 ** 20, np.array([0])).tolist() == [None, None]
    assert whitening.deviations(x, 2, np.array([0])).tolist() == [2 ** 62, 2 ** 62]


def test_clustered_eigenvalues():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for spread in (0, 1e-12, 1e-8):
        values = np.array([10.0] * 3 + [5 + spread * i for i in range(5)] + [1] * 10 + list(np.linspace(0.1, 0.9, 22)))
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        found, basis = whitening.eigenpairs(a)
        assert np.abs(basis.T @ basis - np.eye(40)).max() < 1e-14
        assert np.abs(a @ basis - basis * found).max() < 1e-13 and np.abs(found - np.sort(values)[::-1]).max() < 1e-13
    # a pair 1e-8 apart is told apart, which float32 can't
    _, basis = whitening.eigenpairs(q[:, :2] @ np.diag([1, 1 + 1e-8]) @ q[:, :2].T)
    assert min(np.abs(np.abs(basis[:, 0] @ q[:, 1]) - 1), 1) < 1e-9


# --- periodic runs ----------------------------------------------------------------

def _plain_runs(w):
    """(start, length, period) by period and position, without any index."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i > s and i + p - s >= max(12, 2 * p):
                found.setdefault((s, i + p - s), p)
            i += i == s
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def _plain_row(doc_id, text, rewrite=True):
    w = brute.words(text)
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if rewrite and h % 10 == 0 and n:
        a, k = h // 10 % n, 3 + h // 10 % 8
        w = [w[i] if i < a else w[a + (i - a) % (1 + (n - a) // k)] for i in range(n)]
    found = _plain_runs(w)
    gone = {i for s, m, p in found for i in range(s + p, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    s, m, p = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (doc_id, len(found), s, m, p, 1000 * m // p if found else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 12000]
    got = rows(periodicruns.periodic_runs(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)))
    want = sorted((_plain_row(*d) for d in docs), key=repr)
    assert got == want and sum(r[1] for r in want) > 10
    whole = queries.QUERIES["op12_periodic_runs"](spark, SF)
    assert [r for r in rows(whole) if any(r[0] == d for d, _ in docs)] == want


@pytest.mark.parametrize("kinds", [1, 2, 3, 40])
def test_runs_of_made_up_texts(spark, kinds, monkeypatch):
    rng = random.Random(kinds)
    docs = []
    for d in range(120):
        n = rng.choice([0, 1, 11, 12, 13, 60, 200])
        w = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        if n and d % 3 == 0:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        docs.append((rng.randrange(10 ** 6), rng.choice([" ", "\n", "\t "]).join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(periodicruns.periodic_runs(df)) == sorted((_plain_row(*d) for d in docs), key=repr)
    assert rows(periodicruns.periodic_runs(df, rewrite=None)) == sorted((_plain_row(*d, rewrite=False) for d in docs), key=repr)


def test_runs_in_small_steps(monkeypatch):
    monkeypatch.setattr(periodicruns, "AT_ONCE", 7)
    monkeypatch.setattr(periodicruns, "TOP", 1)
    rng = random.Random(9)
    texts = [[rng.randrange(2) for _ in range(rng.randrange(80))] for _ in range(40)]
    size = np.array([len(w) for w in texts])
    got = list(zip(*(x.tolist() for x in periodicruns.runs(np.array(sum(texts, [])), size, 2))))
    assert got == [(d, *r) for d, w in enumerate(texts) for r in _plain_runs(w)]


def test_runs_of_odd_rows(spark, odd, none):
    small = [(d, t) for d, t in ODD if len(t or "") < 10 ** 5]
    got = rows(periodicruns.periodic_runs(odd))
    assert len(got) == len(ODD)
    assert [r for r in got if r[0] != 8] == sorted((_plain_row(*d) for d in small), key=repr)
    assert next(r for r in got if r[0] == 8)[1:6] == (1, 0, 20000, 997, 20060)
    assert periodicruns.periodic_runs(none).count() == 0


# --- exact duplicates ----------------------------------------------------------------

def _plain_duplicates(docs):
    groups = defaultdict(list)
    fold = [(d, (t or "").translate(brute.FOLD)) for d, t in docs]
    for d, t in fold:
        groups[t].append(d)
    keep = {t: max((d for d in g if d is not None), default=None) for t, g in groups.items()}
    return sorted(((d, keep[t], len(groups[t]), d == keep[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in fold), key=repr)


@pytest.mark.parametrize("bits,hot", [(128, 4096), (8, 2)])
def test_exact_duplicates(spark, odd, none, bits, hot):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(10 ** 5)}É" for _ in range(20000))
    texts = [long, long.upper(), long[:-1], long + "x", "x" + long, "ab" * 30000, "ab" * 29999, "É", "é"] + [f"t {k % 7}" for k in range(60)]
    docs = list(enumerate(texts, 100)) + ODD
    got = rows(exactdedup.exact_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), bits, hot))
    assert got == _plain_duplicates(docs)
    assert rows(exactdedup.exact_duplicates(odd, bits, hot)) == _plain_duplicates(ODD)
    assert exactdedup.exact_duplicates(none, bits, hot).count() == 0


def test_a_digest_of_two_chunks_is_refused(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    assert exactdedup.ambiguous(exactdedup.chunk_table(docs, 0, 8)).count() > 0      # 400 texts, 256 digests
    recipes = exactdedup.verified_recipes(docs, 8)
    assert recipes.select("recipe").distinct().count() == 400


def test_cuts_follow_the_content():
    rng = np.random.default_rng(4)
    body = rng.integers(97, 123, 60000).astype(np.uint8)
    moved = np.concatenate([rng.integers(97, 123, 777).astype(np.uint8), body])
    a, = exactdedup.cuts(body, np.array([0, len(body)]))
    b, = exactdedup.cuts(moved, np.array([0, len(moved)]))
    size = np.diff(np.append(0, a))
    assert size[:-1].min() >= exactdedup.MIN_CHUNK and size.max() <= exactdedup.MAX_CHUNK and len(a) > 10
    assert len(set(a.tolist()) & set((b - 777).tolist())) > 0.8 * len(a)      # an insertion moves few cuts
