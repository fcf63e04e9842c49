"""Rounds of near-dedup: links are followed once, and pairs without a chance aren't made."""

import itertools
import random

from caremill.llm import near_dedup
from caremill.llm.common import settled


def roots_of(nodes, links):
    top = {i: i for i in nodes}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        top[y] = x
    return {i: root(i) for i in nodes}


def test_components_and_links_that_come_later(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(i, 300) for i in range(200, 240)]
    zigzag = [(400 + i // 2, 450 + (i + 1) // 2) for i in range(60)]
    first = [*path, *star, *zigzag, *((rng.randrange(60), rng.randrange(60)) for _ in range(40))]
    first = [(a, b) for a, b in first if a != b]
    later = [(130, 220), (7, 900), (901, 900), (410, 903), (910, 911)]
    frame = lambda links: settled(spark.createDataFrame(links, "a long, b long"))
    labels = near_dedup.components(frame(first))
    assert {r.v: r.c for r in labels.collect()} == roots_of({x for l in first for x in l}, first)
    both = first + later
    got = near_dedup.linked(labels, frame(later)).collect()
    assert {r.v: r.c for r in got} == roots_of({x for l in both for x in l}, both) and len(got) == len({r.v for r in got})
    assert near_dedup.components(frame(first).filter("a < 0")).isEmpty()


def test_rows_made_for_a_family_of_texts(spark, monkeypatch):
    """Texts about as alike as the threshold share buckets in many rounds: the classes of all pairs, few rows on the way."""
    rng, made, ends = random.Random(6), [], []
    base = [f"w{i}" for i in range(300)]
    texts = {}
    for i in range(160):
        w = list(base)
        for at in rng.sample(range(300), rng.choice([3, 4, 5])):
            w[at] = f"e{i}x{at}"
        texts[i] = " ".join(w)
    verified, looked_up = near_dedup._verified, near_dedup.looked_up

    def counted(texts, pairs, *more):
        pairs = settled(pairs)
        found = verified(texts, pairs, *more)
        made.append((pairs.count(), found.count()))
        return found

    def looked(rows, table, keys, *more):
        if keys[0] in ("u", "a", "b"):
            ends.append(rows.count())
        return looked_up(rows, table, keys, *more)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    monkeypatch.setattr(near_dedup, "looked_up", looked)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_dedup(frame).collect()}
    idf, shingles = near_dedup.document_frequencies(frame), near_dedup.Shingles()
    found = {i: (lambda s, n: (s, n * idf[near_dedup.feature(s)]))(*shingles.of(t.encode())) for i, t in texts.items()}
    near = [(a, b) for a, b in itertools.combinations(found, 2) if near_dedup.weighted_jaccard(found[a], found[b]) >= 0.8]
    assert got == roots_of(texts, near) and len(set(got.values())) > 1
    links = sum(n for _, n in made)
    assert len(made) >= 3 and sum(n for n, _ in made[1:]) <= 20 * links and sum(ends) <= 5 * links, (made, ends)
