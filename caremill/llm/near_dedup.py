"""Near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A document's shingles of five words weigh term frequency times inverse document frequency. Document frequencies
are counted over all documents in 2**18 hashed features, so the table that is broadcast has a fixed size. SAMPLES
consistent weighted samples, in BANDS bands, name the buckets of a document.

Scale: documents with the same weighted shingles stand for one another, so groups of copies cost one row each.
In a bucket, members are compared with a leader first; links are merged into classes, and only members of
different classes meet more leaders, GROWTH times as many each round, until a bucket is one class or all its pairs
of different classes were settled. So no link between classes in a bucket is lost, and a large bucket of near
copies costs one comparison for each member.

A family of texts that are only half alike shares buckets without being one class. What a text has alone among
all that are still to be compared bounds its similarity to any of them, so most such pairs are settled without
being made. The rest of its shingles are dealt to PARTS parts by their hash: two texts have no more in common than the
sum of the lesser weights of each part. A pair is made, once, in the first bucket it shares, if both bounds leave it a
chance. Links found are followed from the classes of their ends, each once: those of earlier rounds aren't read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import HOT_KEYS, WordHashes, dropped, if_small, keyed, looked_up, map_arrow, mix, packed, release, settled, table, texts_of, unpacked, words_of

#: Words of a shingle; weighted Jaccard similarity from which two documents are near copies.
SHINGLE, SIMILARITY = 5, 0.8
#: Hashed features of document frequencies, and how many of them travel together.
FEATURES, SLICE = 1 << 18, 1 << 12
#: How far inverse document frequency tells shingles apart: weights go from 1 to 1 + DAMPED times the term frequency, so that
#: copies in a group that holds much of the corpus stay as alike as copies of a rare text.
DAMPED = 0.25
#: Samples of a document, and bands of SAMPLES / BANDS samples: at similarity 0.8, 0.9998 of the pairs meet.
SAMPLES, BANDS = 64, 16
#: Shingles that are sampled at once; draws in the tables of random numbers.
BLOCK, DRAWS = 512, 1 << 16
#: Growth of the leaders in each round.
GROWTH = 4
#: Members of a bucket that meet its leaders in one task.
BUCKET_ROWS = 1000
#: Slack of bounds on similarity, for rounding.
SLACK = 1e-6
#: Parts that shingles are dealt to by their hash; two texts have no more in common than the lesser weight of each part.
PARTS = 32


class Shingles:
    """Distinct shingle hashes of a text, with their counts."""

    def __init__(self):
        self.cache = WordHashes()

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = self.cache.of(words_of(text))
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        size = min(n, SHINGLE)
        h = np.full(n - size + 1, np.uint64(size))
        for i in range(size):
            h = mix(h, words[i : n - size + 1 + i])
        return np.unique(h, return_counts=True)


def feature(shingles: np.ndarray) -> np.ndarray:
    """Leading bits: features of sorted shingles are sorted."""
    return (shingles >> np.uint64(65 - FEATURES.bit_length())).astype(np.int64)


class Sampler:
    """Improved consistent weighted sampling with draws from fixed tables."""

    def __init__(self, seed: int = 11):
        u = np.random.default_rng(seed)
        gamma = lambda: -np.log(1 - u.random(DRAWS)) - np.log(1 - u.random(DRAWS))
        self.r, self.ln_c = gamma().astype(np.float32), np.log(gamma()).astype(np.float32)
        self.seeds = u.integers(0, 2**63, SAMPLES, dtype=np.uint64)

    def sample(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A hash for each of SAMPLES samples: the chosen shingle and its quantised weight."""
        best = np.full(SAMPLES, np.inf, np.float32)
        chosen, level, every = np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int64), np.arange(SAMPLES)
        ln_w = np.log(weights).astype(np.float32)
        for at in range(0, len(shingles), BLOCK):
            s = shingles[at : at + BLOCK]
            x = mix(s[:, None], self.seeds[None, :])
            part = x.view(np.uint16).reshape(len(s), SAMPLES, 4)
            r, ln_a = self.r.take(part[:, :, 0]), self.ln_c.take(part[:, :, 1])
            t = (x >> np.uint64(32)).astype(np.float32)
            t *= np.float32(2.0**-32)  # beta
            level_at = ln_w[at : at + BLOCK, None] / r
            level_at += t
            np.floor(level_at, out=level_at)
            np.subtract(level_at, t, out=t)
            t += np.float32(1)
            t *= r
            ln_a -= t
            first = ln_a.argmin(axis=0)
            least = ln_a[first, every]
            better = least < best
            best[better], chosen[better] = least[better], s[first[better]]
            level[better] = level_at[first, every][better].astype(np.int64)
        return mix(chosen, level.view(np.uint64))

    @staticmethod
    def bands(samples: np.ndarray) -> np.ndarray:
        rows = samples.reshape(BANDS, -1)
        h = np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(rows.shape[1]):
            h = mix(h, rows[:, i])
        return h.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two documents' (sorted shingles, weights)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum())
    total = float(a[1].sum() + b[1].sum()) - low
    return low / total if total > 0 else 0.0


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """Damped inverse document frequency of each hashed feature, over all documents. The driver gets FEATURES numbers."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, docs, shingles = np.zeros(FEATURES, np.int64), 0, Shingles()
        for batch in parts:
            for text in texts_of(batch):
                s, _ = shingles.of(text)
                f = feature(s)
                found[f[np.diff(f, prepend=-1) > 0]] += 1
                docs += bool(len(s))
        if docs:
            slices = found.reshape(-1, SLICE)
            used = np.flatnonzero(slices.any(axis=1))
            counts = [np.array([docs]), *slices[used]]
            yield pa.RecordBatch.from_arrays([pa.array([-1, *used.tolist()], pa.int32()), pa.array([c.astype(np.int32).tobytes() for c in counts], pa.binary())], ["slice", "counts"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in parts:
            for i, data in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(data, np.int32).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "counts"])

    schema = "slice int, counts binary"
    whole = map_arrow(map_arrow(rows.select("text"), count, schema).repartition("slice"), add, schema).collect()
    df = np.zeros(FEATURES + SLICE, np.int64)
    for i, data in ((r[0], bytes(r[1])) for r in whole):
        at = i * SLICE if i >= 0 else FEATURES
        df[at : at + len(data) // 8] += np.frombuffer(data, np.int64)
    return (1 + DAMPED * np.log((df[FEATURES] + 1) / (df[:FEATURES] + 1)) / np.log(df[FEATURES] + 2)).astype(np.float32)


def _signatures(rows: DataFrame, idf) -> DataFrame:
    """Settled _row, doc_id, g1, g2 (the weighted shingles' identity; null without words), weight (of all shingles), bands."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sampler = Shingles(), Sampler()
        for batch in parts:
            names, totals, bands = [], [], []
            for text in texts_of(batch):
                s, n = shingles.of(text)
                if not len(s):
                    names.append((None, None))
                    totals.append(0.0)
                    bands.append([])
                    continue
                both = [int(np.bitwise_xor.reduce(mix(mix(s, n.astype(np.uint64)), np.full(len(s), np.uint64(seed)))).view(np.int64)) for seed in (3, 5)]
                names.append(both)
                weights = n * idf.value[feature(s)]
                totals.append(float(weights.sum()))
                bands.append(Sampler.bands(sampler.sample(s, weights)))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), pa.array([x[0] for x in names], pa.int64()), pa.array([x[1] for x in names], pa.int64()), pa.array(totals, pa.float64()), pa.array(bands, pa.list_(pa.int64()))], ["_row", "doc_id", "g1", "g2", "weight", "bands"])

    return settled(map_arrow(rows.select("_row", "doc_id", "text"), run, f"_row long, doc_id {id_type}, g1 long, g2 long, weight double, bands array<long>"))


def _with_packed(rows: DataFrame, texts: DataFrame, end: str, other: str, pairs: DataFrame) -> DataFrame:
    """The rows with the text of one end of their pairs. A text that very many pairs name goes to several tasks; which ones do is
    told by a broadcast of at most HOT_KEYS ids."""
    counts = settled(pairs.groupBy(end).agg(F.count("*").alias("_n")).filter(F.col("_n") > BUCKET_ROWS))
    hot = F.broadcast(counts.orderBy(F.desc("_n")).limit(HOT_KEYS).select(end, F.ceil(F.col("_n") / BUCKET_ROWS).cast("int").alias("_parts")))
    own = texts.select(F.col("_row").alias(end), F.col("packed").alias(f"packed_{end}"))
    if counts.isEmpty():
        return rows.join(own, end)
    spread = rows.join(hot, end, "left").withColumn("_part", F.pmod(F.xxhash64(other), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    copies = own.join(hot, end, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return spread.join(copies, [end, "_part"]).drop("_part")


def _verified(texts: DataFrame, pairs: DataFrame, idf, similarity: float) -> DataFrame:
    """Settled pairs (a, b) of that similarity. ``texts``: _row, packed of all that pairs name."""
    pairs = settled(pairs)
    near = _with_packed(_with_packed(pairs, texts, "a", "b", pairs), texts, "b", "a", pairs)
    both = near.select("a", "b", "packed_a", "packed_b")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()

        @lru_cache(16)
        def weighted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
            s, n = shingles.of(text)
            return s, n * idf.value[feature(s)]

        for batch in parts:
            ok = [weighted_jaccard(weighted(x), weighted(y)) >= similarity for x, y in zip(unpacked(batch, "packed_a"), unpacked(batch, "packed_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return settled(map_arrow(both, run, "a long, b long"))


def part_weights(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of the shingles of each part."""
    return np.bincount((shingles & np.uint64(PARTS - 1)).astype(np.int64), weights=weights, minlength=PARTS)


def _weights(texts: DataFrame, idf, schema: str, columns) -> DataFrame:
    """Rows of ``schema`` made by ``columns`` of each text's _row, shingles and weights. ``texts``: _row, packed."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in parts:
            for row, text in zip(batch.column("_row").to_pylist(), unpacked(batch), strict=True):
                s, n = shingles.of(text)
                made = columns(row, s, (n * idf.value[feature(s)]).astype(np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made.values()], list(made))

    return map_arrow(texts, run, schema)


def _own_weight(texts: DataFrame, idf) -> DataFrame:
    """rep, own, own_parts: the weight of the shingles that no other of these texts has, where there are any, and the same by part."""
    every = _weights(texts, idf, "rep long, shingle long, weight double", lambda row, s, w: {"rep": np.full(len(s), row, np.int64), "shingle": s.view(np.int64), "weight": w})
    once = every.groupBy("shingle").agg(F.count("*").alias("n"), F.min("rep").alias("rep"), F.min("weight").alias("weight")).filter("n = 1")
    part = F.pmod("shingle", F.lit(PARTS))
    return once.groupBy("rep").agg(F.sum("weight").alias("own"), F.array(*[F.sum(F.when(part == i, F.col("weight")).otherwise(0.0)) for i in range(PARTS)]).alias("own_parts"))


def _part_weights(texts: DataFrame, idf) -> DataFrame:
    """rep, parts: the weight of each part of a text's shingles."""
    return _weights(texts, idf, "rep long, parts array<double>", lambda row, s, w: {"rep": [row], "parts": [part_weights(s, w)]})


def _renamed(rows: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """The settled rows with the name c of each value v of a column in its place; settled. Every value has a name. Values that
    very many rows have meet them by a bounded broadcast: see looked_up()."""
    counts = rows.groupBy(column).agg(F.count("*").alias("_n"))
    table = settled(names.select(F.col("v").alias(column), F.col("c").alias("_name")).join(counts, column))
    return settled(looked_up(rows, table, [column], "_n").drop(column, "_n").withColumnRenamed("_name", column))


def components(links: DataFrame) -> DataFrame:
    """Settled (v, c): the smallest node of each linked node's component.

    Every node hangs on its smallest neighbour, if that is smaller, and ways up are halved until each ends at a root. Links are
    then between roots; those inside a tree are done with, the others start anew.
    """
    edges = settled(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while True:
        up = edges.select(F.col("b").alias("v"), F.col("a").alias("c")).unionByName(edges.select(F.col("a").alias("v"), F.col("a").alias("c")))
        roots = settled(up.groupBy("v").agg(F.min("c").alias("c")))
        while True:
            higher = _renamed(roots.withColumn("old", F.col("c")), "c", roots)
            roots = higher.select("v", "c")
            if higher.filter("c <> old").isEmpty():
                break
        labels = roots if labels is None else _relabelled(labels, roots)
        edges = _renamed(_renamed(edges, "a", roots), "b", roots).filter("a <> b")
        edges = settled(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if edges.isEmpty():
            return labels


def _relabelled(labels: DataFrame, tops: DataFrame) -> DataFrame:
    """Settled labels (v, c) whose classes have the names that tops gives to some of them; the others keep theirs."""
    classes = labels.select(F.col("c").alias("v")).distinct()
    others = classes.join(tops, "v", "left_anti").select("v", F.col("v").alias("c"))
    return _renamed(labels, "c", settled(tops.select("v", "c").unionByName(others)))


def linked(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Settled (v, c) of the links that gave the settled labels and of more settled ones, which alone are followed here."""
    ends = links.select(F.col("a").alias("v")).unionByName(links.select(F.col("b").alias("v"))).distinct()
    new = ends.join(labels, "v", "left_anti").select("v", F.col("v").alias("c"))
    labels = settled(labels.unionByName(new))
    between = _renamed(_renamed(links, "a", labels), "b", labels)
    return _relabelled(labels, components(between))


def _contested(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Settled members of the buckets that hold more than one class, with their class c."""
    named = settled(members.join(labels.withColumnsRenamed({"v": "rep", "c": "_c"}), "rep", "left").select(*members.columns, F.coalesce("_c", "rep").alias("c")))
    mixed = settled(named.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).filter("low < high").select("key", "n"))
    found = settled(looked_up(named, mixed, ["key"]).drop("n"))
    dropped(named)
    return found


def _facts(members: DataFrame, same: DataFrame, texts: DataFrame, idf, least: float) -> DataFrame:
    """Settled rep, own, shared (weight of the shingles that no other, or another, of the members has too), parts (shared, by
    part), bands. A member with so much of its own that no other can be similar is left out."""
    reps = settled(members.select("rep").distinct())
    texts = texts.join(reps.withColumnRenamed("rep", "_row"), "_row", "left_semi")
    found = same.join(reps, "rep", "left_semi").join(_own_weight(texts, idf), "rep", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
    found = settled(found.withColumn("shared", F.col("weight") - F.col("own")).filter(F.col("shared") >= least * F.col("weight")).select("rep", "own", "own_parts", "shared", "bands"))
    parts = _part_weights(texts.join(found.select(F.col("rep").alias("_row")), "_row", "left_semi"), idf)
    shared = F.when(F.col("own_parts").isNull(), F.col("parts")).otherwise(F.zip_with("parts", "own_parts", lambda x, y: x - y))
    return settled(found.join(parts, "rep").select("rep", "own", "shared", shared.alias("parts"), "bands"))


def near_classes(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """_row, doc_id, class: documents of a class are linked by pairs of that similarity. ``rows``: see keyed()."""
    idf = rows.sparkSession.sparkContext.broadcast(document_frequencies(rows))
    marks = _signatures(rows, idf)
    same = settled(marks.filter("g1 is not null").groupBy("g1", "g2").agg(F.min("_row").alias("rep"), F.min("weight").alias("weight"), F.min("bands").alias("bands"), F.count("*").alias("copies")))
    buckets = same.select("rep", "weight", F.explode("bands").alias("key"))
    met = settled(buckets.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("rep", "weight")).alias("first")).filter("size > 1").select("key", "size", F.col("first.rep").alias("lead"), F.col("first.weight").alias("lead_weight")))
    members = settled(looked_up(settled(buckets), met, ["key"], "size"))
    involved = settled(members.select(F.col("rep").alias("_row")).distinct())
    texts = settled(packed(rows.select("_row", "text")).join(if_small(involved), "_row", "left_semi"))
    release(rows.sparkSession)
    least = similarity * (1 - SLACK)
    chance = F.least("weight", "lead_weight") >= least * F.greatest("weight", "lead_weight")
    labels = components(_verified(texts, members.filter("rep <> lead").filter(chance).select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct(), idf, similarity))
    members = _contested(members.filter("size > 2").select("key", "rep", "size", "lead"), labels).drop("c")
    if not members.isEmpty():
        members = settled(members.join(_facts(members, same, texts, idf, least), "rep"))
    reach = 0
    while not (members := _contested(members, labels)).isEmpty():
        after = max(1, reach) * GROWTH
        members = members.withColumn("place", F.pmod(F.xxhash64(F.lit(7), "rep"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("size")).filter(F.col("place") >= reach)
        leaders = members.filter((F.col("place") < after) & (F.col("rep") != F.col("lead"))).select("key", "size", F.col("rep").alias("x"), F.col("c").alias("cx"), F.col("own").alias("own_x"), F.col("shared").alias("shared_x"), F.col("parts").alias("parts_x"), F.col("bands").alias("bands_x"))
        other = (F.col("c") != F.col("cx")) & (F.col("rep") != F.col("lead")) & ((F.col("x") < F.col("rep")) | (F.col("place") >= after))
        chance = F.least("shared", "shared_x") >= least * (F.col("own") + F.col("own_x") + F.greatest("shared", "shared_x"))
        first = F.array_intersect("bands_x", "bands")[0] == F.col("key")
        common = F.aggregate(F.zip_with("parts_x", "parts", lambda x, y: F.least(x, y)), F.lit(0.0), lambda x, y: x + y)  # at most
        closer = common * (1 + least) >= least * (F.col("own") + F.col("own_x") + F.col("shared") + F.col("shared_x"))
        parts = F.ceil(F.col("size") / BUCKET_ROWS).cast("int")  # a large bucket's members meet its leaders in several tasks
        salted = members.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "rep"), parts).cast("int"))
        more = leaders.select("*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")).drop("size").join(salted, ["key", "part"]).filter(other & chance & first & closer)
        found = _verified(texts, more.select(F.least("x", "rep").alias("a"), F.greatest("x", "rep").alias("b")), idf, similarity)
        if not found.isEmpty():
            labels = linked(labels, found)
        reach = after
        members = members.filter((F.col("size") > reach) & (F.col("place") >= reach)).drop("c", "place")
    to_class = settled(same.select("g1", "g2", "rep", "copies").join(labels.withColumnsRenamed({"v": "rep", "c": "_c"}), "rep", "left").select("g1", "g2", "copies", F.coalesce("_c", "rep").alias("_class")))
    alone = marks.filter("g1 is null").select("_row", "doc_id", F.col("_row").alias("_class"))
    return looked_up(marks.filter("g1 is not null"), to_class, ["g1", "g2"], "copies").select("_row", "doc_id", "_class").unionByName(alone)


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept.

    Of a class the row with the smallest doc_id stays (null is largest; of repeated rows any one), and its doc_id
    is the class id. Texts of fewer than five words have one shingle; texts without words (null, empty) are alone.
    Extra columns are ignored; an empty table gives no rows.
    """
    return _judged(near_classes(keyed(docs.select("doc_id", "text")), similarity)).drop("_row")


def _judged(classes: DataFrame) -> DataFrame:
    classes = settled(classes)
    best = settled(classes.groupBy("_class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")).alias("_best"), F.count("*").alias("class_size")))
    return looked_up(classes, best, ["_class"], "class_size").select("_row", "doc_id", F.col("_best.doc_id").alias("class_id"), "class_size", (F.col("_best._row") == F.col("_row")).alias("kept"))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that stay, with all columns."""
    rows = keyed(docs.select(F.struct("*").alias("_doc"), "doc_id", "text"))
    gone = settled(_judged(near_classes(rows.select("_row", "doc_id", "text"), similarity)).filter("not kept").select("_row"))
    return rows.join(if_small(gone), "_row", "left_anti").select("_doc.*")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))
