"""Periodic runs and whitening against plain versions, and their odd rows."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from caremill.llm import periodic_runs, whitening


def smallest_period(words):
    fail, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k - 1]
        k += words[i] == words[k]
        fail[i] = k
    return len(words) - fail[-1]


def plain_runs(words):
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if end > at and length >= max(24, 3 * q) and smallest_period(words[at : end + q]) == q:
                out.append((at, length, q))
            at = end + 1
    return sorted(out)


def periodic_texts():
    rng = random.Random(5)
    for _ in range(150):
        words = []
        while len(words) < rng.choice((10, 60, 200, 500)):
            root = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghijklmnop") for _ in range(rng.choice((1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 40, 64, 65)))]
            words += (root * 9)[: rng.randint(1, 9) * len(root) // 2 + rng.randint(0, 5)]
            words += rng.choices("xyz", k=rng.randint(0, 3))
        yield words
    p, q = ["p"] + list("abcdefghijklmnopqrst"), ["q"] + list("abcdefghijklmnopqrst")
    yield (p + p + q + q) * 4  # every gram occurs twice in a period
    yield ["a"] * 3000
    yield ["a"] * 23
    yield ["a"] * 24
    yield list("ab") * 12 + list("abc") * 30 + ["b"]


def test_runs_against_every_period():
    texts = [[w.encode() for w in t] for t in periodic_texts()]
    got = periodic_runs.find_runs(texts)
    assert got == [plain_runs(t) for t in texts] and sum(map(len, got)) > 100


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *best, best[1] and math.floor(Fraction(1000 * best[1], best[2])), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query_values_and_odd_rows(spark):
    rng = random.Random(1)
    texts = [" ".join(t) for t in list(periodic_texts())[:60]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, " \n\x0b"), (103, "w " * 40), (103, "w " * 40), (None, "v " * 30), (None, None)]
    rows += [(200 + i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(300))) for i in range(40)]  # the contract makes some of these periodic
    rows += [(300, "long " * 200_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, start int")
    got = sorted(map(tuple, periodic_runs.periodic_runs(frame, rewrite=True).collect()), key=str)
    small = sorted(((i, *expected(i, t)) for i, t in rows if i != 300), key=str)
    assert [r for r in got if r[0] != 300] == small
    long = [r for r in got if r[0] == 300][0]
    assert long[1:6] == (1, 0, 200_000, 1, 200_000_000) and long[7] == hashlib.sha256(b"long").hexdigest()
    assert periodic_runs.periodic_runs(frame.limit(0)).collect() == []
    full = periodic_runs.periodic_runs(frame.filter("doc_id = 103"), text_out=True).collect()
    assert [[tuple(x) for x in r.runs] for r in full] == [[(0, 40, 1)]] * 2 and full[0].collapsed_text == "w"


def test_runs_find_what_the_contract_plants(spark):
    rng = random.Random(2)
    frame = spark.createDataFrame([(i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(400))) for i in range(200)], "doc_id long, text string")
    for r in periodic_runs.periodic_runs(frame, rewrite=True).collect():
        h = zlib.crc32(str(r.doc_id).encode())
        a, g = (h // 10) % 400, h // 10
        p = 1 + (400 - a) // (3 + g % 8)
        planted = h % 10 == 0 and 400 - a >= max(24, 3 * p)
        assert (r.n_runs, r.start, r.length, r.period) == ((1, a, 400 - a, p) if planted else (0, None, None, None))


def plain_whitening(vectors):
    x = np.array(sorted({tuple(math.floor(256 * float(np.float64(c))) for c in v) for v in vectors}), float)
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return x, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("dims", [1, 3, 5, 20])
def test_whitening_against_a_full_decomposition(spark, dims):
    rng = np.random.default_rng(dims)
    data = (rng.normal(size=(300, dims)) * np.linspace(3, 0.2, dims) @ rng.normal(size=(dims, dims)) + 50).astype(np.float32)
    vectors = [[float(c) for c in v] for v in data] + [[float(c) for c in data[0]]] * 200
    frame = spark.createDataFrame([(i, v, "x", 3) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, x string, component int").repartition(5)
    x, values, axes = plain_whitening(vectors)
    n, sums = len(x), x.sum(axis=0)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame).collect()}
    assert len(got) == len(vectors) * min(4, dims)
    for c in range(min(4, dims)):
        sign = None
        for i, v in enumerate(vectors):
            r, mine = got[i, c + 1], np.floor(256 * np.array(v))
            want = (mine - sums / n) @ axes[:, c] / math.sqrt(values[c])
            sign = sign or (1 if (want > 0) == (r.whitened > 0) else -1)
            assert math.isclose(r.whitened, sign * want, rel_tol=1e-6, abs_tol=1e-8)
            assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(mine, sums, strict=True))
            assert math.isclose(r.explained, values[c] / values.sum(), rel_tol=1e-9) and r.identity_error < 1e-9


def test_factor_and_rotations():
    rng = np.random.default_rng(3)
    for dims, rank in ((1, 1), (7, 7), (8, 3), (64, 64), (5, 0)):
        half = rng.normal(size=(dims, rank)) * 10.0 ** rng.integers(-6, 6, size=(dims, 1))
        matrix = half @ half.T
        order, low = whitening.pivoted_cholesky(matrix)
        assert np.allclose(low @ low.T, matrix[np.ix_(order, order)], rtol=1e-8, atol=1e-10 * max(matrix.max(initial=0), 1e-300)) and np.allclose(low, np.tril(low))
        values, axes = whitening.eigen(matrix)
        assert len(values) <= rank and np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-8)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][: len(values)], atol=1e-8 * max(matrix.max(initial=0), 1))


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, n string, deviation string"
    good = [[1.0, 0.0], [0.0, 1.0], [-1.0, 0.5], [-0.0, 1.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(1, good[1]), (None, good[0]), (8, None), (9, []), (10, [1.0, None]), (11, [math.nan, 1.0]), (12, [math.inf, 1.0]), (13, [1.0]), (14, [1.0, 2.0, 3.0]), (15, [1e300, 0.0]), (16, [1e17, 0.0])]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], schema)
    got = whitening.whiten(frame).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), c) for i in (0, 1, 1, 2, 3, None) for c in (1, 2)) and {r.n for r in got} == {3}
    assert len({r.whitened for r in got if r.vec_id in (1, 3)}) == 2  # -0.0 is 0.0
    assert whitening.whiten(frame.filter("vec_id >= 8")).filter("vec_id < 13").collect() == []
    assert whitening.whiten(frame.limit(0)).collect() == [] and whitening.whiten(frame.filter("vec_id = 1")).collect() == []
    far = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 3.0])]
    assert all(r.deviation is None for r in whitening.whiten(spark.createDataFrame([(*r, "a", "b") for r in far], schema)).collect() if r.vec_id != 3)
