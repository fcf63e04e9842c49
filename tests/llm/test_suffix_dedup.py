"""Suffix-array dedup against every string of 200 bytes, and its odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from caremill.llm import suffix_dedup


def plain(texts):
    """Bytes removed from each text, by counting every string of 200 bytes."""
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def mixed_texts():
    """Near copies with edits at many distances, shared passages of about 200 bytes, runs of one letter, characters of two bytes."""
    rng = random.Random(4)
    fresh = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     \né", k=n))
    base, passages = fresh(3000), [fresh(n) for n in (150, 180, 199, 200, 201, 230, 400)]
    texts = [base, fresh(199), fresh(200), passages[3], "a" * 900, "b" * 199, "ab" * 400, "é" * 300, "\0" * 450, "x" * 50 + "\0" * 230]
    for _ in range(40):
        near = list(base)
        for _ in range(rng.choice((1, 3, 10, 20, 40))):
            near[rng.randrange(len(near))] = rng.choice("ABC")
        a = rng.randrange(2000)
        texts.append("".join(near[a : a + rng.randint(150, 1000)]))
    for _ in range(40):
        texts.append("".join(rng.choice((fresh(rng.randint(0, 300)), rng.choice(passages), rng.choice(passages))) for _ in range(4)))
    texts += ["ab" * 90 + fresh(60), fresh(30) + "c" * 205 + fresh(10), "c" * 201]
    return texts


@pytest.mark.parametrize("most", [1024, 3])
def test_against_every_string(spark, most):
    texts = mixed_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(frame, most=most).collect()}
    want = plain([t.encode() for t in texts])
    assert [got[i] for i in range(len(texts))] == want and sum(w[1] > 0 for w in want) > 40


def test_parse_order_is_the_order_of_bytes():
    rng = random.Random(6)
    for size in (1, 2, 300):
        rows = [bytes(rng.choices(b"ab\0" if i % 2 else bytes(range(97, 123)), k=rng.randint(1, 200))) for i in range(size)]
        rows += [r[:150] + b"zz" for r in rows]
        follows = suffix_dedup._as_rows(rows, 200)
        order = suffix_dedup.parse_order(follows, np.array([len(r) for r in rows]))
        inorder = [follows[i].tobytes() for i in order.tolist()]
        assert inorder == sorted(inorder)


def test_rolling_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(bytes(random.Random(0).choices(range(256), k=5000)) * 2, np.uint8)
    h = suffix_dedup.Rolling(data)
    start = np.arange(0, 4700)
    for which in (0, 1):
        one, other = h.of(start, start + 300, which), h.of(start + 5000, start + 5300, which)
        assert (one == other).all() and len(set(one.tolist())) == len(one)


def test_odd_rows(spark):
    same = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"v{i}" for i in range(100_000))
    rows = [(1, None), (2, ""), (3, same), (4, same), (4, same), (None, "no id here"), (None, None), (5, "x" * 200), (6, long), (7, "y" * 300_000), (8, "z" * 199), (9, "z" * 199)]
    frame = spark.createDataFrame([(*r, 1, "g", 2) for r in rows], "doc_id long, text string, _row int, g string, at int")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(frame).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    gone = {3, 4, 7}
    assert got == sorted((str(i), len(t or ""), len(t) if i in gone else 0, int(i in gone), sha("" if i in gone else t or "")) for i, t in rows)
    assert suffix_dedup.suffix_dedup(frame.limit(0)).collect() == []
    assert len(suffix_dedup.suffix_dedup(frame.filter("text is null")).collect()) == 2
    assert {bytes(r.kept) for r in suffix_dedup.suffix_dedup(frame.filter("doc_id in (3, 4, 5)"), bytes_out=True).collect()} == {b"", b"x" * 200}
