"""Frequent keys meet their rows by a broadcast, the others by a shuffle: the same rows either way."""

import random
from collections import Counter

import pytest
from caremill.llm import common


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_repeated_and_looked_up(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    rng = random.Random(7)
    rows = [(i, 1 if rng.random() < 0.4 else rng.randrange(200), 0) for i in range(400)]
    df = common.settled(spark.createDataFrame(rows, "i long, k long, z long"))
    n = Counter(k for _, k, _ in rows)
    assert sorted(r.i for r in common.repeated(df, ["k", "z"]).collect()) == [i for i, k, _ in rows if n[k] > 1]
    few = common.settled(df.filter("i % 3 = 0"))
    assert sorted(r.i for r in common.repeated(few, ["k"], df).collect()) == [i for i, k, _ in rows if i % 3 == 0 and n[k] > 1]
    names = common.settled(spark.createDataFrame([(k, x, f"n{k}") for k, x in n.items() if k != 5], "k long, n long, name string"))
    got = {r.i: (r.k, r.name) for r in common.looked_up(df, names, ["k"]).collect()}
    assert got == {i: (k, f"n{k}") for i, k, _ in rows if k != 5}
