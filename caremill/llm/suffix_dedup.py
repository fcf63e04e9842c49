"""Suffix-array dedup by prefix-free parsing: bytes go that a repeated string of LENGTH (200) bytes covers.

A rolling hash of 8 bytes triggers the end of a phrase, wherever these bytes stand. A string of 200 bytes is anchored at the
trigger of least hash in it, which the string alone decides: equal strings have equal anchors at equal distances. What stands
before the anchor is a suffix of the dictionary's side, what follows it one of the parse. Contexts (the text that the windows of
one anchor see) are put in order by each of the two: by the bytes before the anchor, read backwards, and by the ranks of the phrases that
follow, in the sorted dictionary of distinct phrases. Neighbours' common lengths cut both orders into classes, and two windows are
equal if their anchors stand at one distance d, and they are in one class of d bytes before and of 200 - d bytes after it.

Before texts are compared, hashes rule out what can't repeat: a block of 104 bytes that all windows of an anchor share must occur twice.
Whole contexts that occur twice (128 bits) need no order. Each distinct one of the others is compared once, however many
copies it has, with those that share its block; the bytes decide. The few windows without a trigger are compared by hashes.

Scale: about a row for 65 bytes is shuffled at first, later only contexts of repeated blocks. Counts are combined in the tasks,
frequent keys meet their rows by a broadcast of a bounded number. A block with more than MOST distinct contexts, say in a very large group
of near copies, isn't gathered in a task: its windows are counted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import dropped, groups_of, keyed, looked_up, map_arrow, mix, packed, release, repeated, settled, sha256, table, texts_of, unpacked
from caremill.llm.substring_dedup import _split

#: Fixed by the contract: bytes of a repeated string.
LENGTH = 200
#: Bytes of a trigger, one in how many hashes triggers, and the starts that share a block.
GRAM, ONE_IN, WIDTH = 8, 16, 97
#: Starts of grams in a window; distinct contexts of a block that one task compares.
STARTS, MOST = LENGTH - GRAM + 1, 1024
#: Bytes of text that are hashed together; contexts that are sorted together.
CHUNK_BYTES, CONTEXTS = 1 << 20, 8192
#: What a row is: a context, a window without a trigger, a stretch that is known to repeat.
CONTEXT, WINDOW, KNOWN = 0, 1, 2

_ODD = 0x9E3779B97F4A7C15
_TABLES = np.random.default_rng(13).integers(0, 2**63, (2, 256)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_NONE = np.uint64(2**64 - 1)


class _Powers:
    """Powers of an odd number modulo 2^64, and of its inverse, as far as they were needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = (np.multiply.accumulate(np.array([1] + [x] * (n - 1), np.uint64)) for x in (_ODD, pow(_ODD, -1, 2**64)))
        return cls.up, cls.down


class Rolling:
    """Polynomial hashes of any stretch of some bytes, by sums over prefixes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _Powers.of(len(data) + 1)
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(t[data] * up[: len(data)], dtype=np.uint64)]) for t in _TABLES]

    def of(self, start: np.ndarray, stop: np.ndarray, which: int, salt: np.ndarray | int = 0) -> np.ndarray:
        return mix((self.sums[which][stop] - self.sums[which][start]) * self.down[start], np.asarray(salt).astype(np.uint64))

    def grams(self) -> np.ndarray:
        """Hash of the gram at each place; those that don't trigger are _NONE."""
        s, n = self.sums[0], max(len(self.sums[0]) - GRAM, 0)
        h = mix((s[GRAM:] - s[:n]) * self.down[:n], np.zeros(1, np.uint64))
        return np.where(h % np.uint64(ONE_IN) == 0, h, _NONE)


def _anchors(grams: np.ndarray, total: int) -> np.ndarray:
    """For each start the place of the least trigger in its window, _NONE without one."""
    places = np.arange(total, dtype=np.uint64)
    low = np.full(total, _NONE)
    low[: len(grams)] = np.where(grams == _NONE, _NONE, (grams >> np.uint64(28) << np.uint64(28)) | places[: len(grams)])
    for step in (1, 2, 4, 8, 16, 32, 64, STARTS - 128):
        low[:-step] = np.minimum(low[:-step], low[step:])
    return np.where(low == _NONE, _NONE, low & np.uint64(2**28 - 1))


def _merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping stretches as one."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    head = np.concatenate([[True], start[1:] >= stop[:-1]])[: len(start)]
    return start[head], stop[np.concatenate([head[1:], [True]])[: len(start)]]


def _chunk(texts: list[bytes]) -> dict[str, np.ndarray]:
    """doc, at, before, after, kind, g, c: the anchors of some texts, and the least and largest distance of starts before it."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(data))
    starts = np.flatnonzero(left >= LENGTH)
    hashes = Rolling(data)
    anchor = _anchors(hashes.grams(), len(data))[starts]
    alone = starts[anchor == _NONE]
    starts, anchor = starts[anchor != _NONE], anchor[anchor != _NONE].astype(np.int64)
    block = (anchor - starts) // WIDTH
    head = np.ones(len(starts), bool)
    head[1:] = (starts[1:] != starts[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])
    last = np.concatenate([head[1:], [True]])[: len(head)]
    at, b = anchor[head], block[head]
    before, after = at - starts[head], at - starts[last]
    g = hashes.of(at - b * WIDTH, at - b * WIDTH - WIDTH + 1 + LENGTH, 0, b + 1)
    c = hashes.of(at - before, at - after + LENGTH, 1, before * LENGTH + after)
    zeros = np.zeros(len(alone), np.int64)
    kind = np.concatenate([np.full(len(at), CONTEXT, np.int8), np.full(len(alone), WINDOW, np.int8)])
    at, before, after = np.concatenate([at, alone]), np.concatenate([before, zeros]), np.concatenate([after, zeros])
    g = np.concatenate([g, hashes.of(alone, alone + LENGTH, 0)])
    c = np.concatenate([c, hashes.of(alone, alone + LENGTH, 1)])
    order = np.lexsort((at, c, g))  # of many equal ones the first and the last are enough for the others to meet
    same = (g[order][1:] == g[order][:-1]) & (c[order][1:] == c[order][:-1])
    middle = np.zeros(len(at), bool)
    middle[order[1:-1]] = same[1:] & same[:-1]
    start, stop = _merged((at - before)[middle], (at - after)[middle] + LENGTH)
    n = len(start)
    out = {"at": (at[~middle], start), "before": (before[~middle], np.zeros(n)), "after": (after[~middle], LENGTH - (stop - start)), "kind": (kind[~middle], np.full(n, KNOWN)), "g": (g[~middle].view(np.int64), np.zeros(n)), "c": (c[~middle].view(np.int64), np.zeros(n))}
    found = {k: np.concatenate([a.astype(np.int64), b.astype(np.int64)]) for k, (a, b) in out.items()}
    # a known stretch from at to stop is written like the others: at - before to at - after + LENGTH
    found["doc"] = np.searchsorted(ends, found["at"] - found["before"], side="right")
    found["at"] -= (ends - sizes)[found["doc"]]
    return found


PLACE = "_row long, at int, before int, after int, kind byte, g long, c long"


def _places(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("_row", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("after", pa.int32()), ("kind", pa.int8()), ("g", pa.int64()), ("c", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            pairs = [(t, r) for t, r in zip(texts_of(batch), batch.column("_row").to_pylist(), strict=True) if len(t) >= LENGTH]
            texts, rows = [t for t, _ in pairs], np.array([r for _, r in pairs], np.int64)
            for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
                found = _chunk(texts[a:b])
                found["_row"] = rows[a:b][found["doc"]]
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name]).cast(f.type) for f in schema], schema=schema)

    return map_arrow(docs.select("_row", "text"), run, PLACE)


SEEN = "g long, n long, _row long, at int, before int, after int, seen binary"


def _with_text(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """The contexts with the bytes that their windows see."""
    lists = contexts.groupBy("_row").agg(F.collect_list(F.struct("g", "n", "at", "before", "after")).alias("cs"))
    schema = pa.schema([("g", pa.int64()), ("n", pa.int64()), ("_row", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("after", pa.int32()), ("seen", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for text, row, cs in zip(unpacked(batch), batch.column("_row").to_pylist(), batch.column("cs").to_pylist(), strict=True):
                found = [(x["g"], x["n"], row, x["at"], x["before"], x["after"], text[x["at"] - x["before"] : x["at"] - x["after"] + LENGTH]) for x in cs]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    return map_arrow(packed(texts).join(lists, "_row"), run, SEEN)


def _as_rows(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)


def _common(order: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row in order with the one before; -1 for the first."""
    differ = rows[order[1:]] != rows[order[:-1]]
    return np.concatenate([[-1], np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])])


def parse_order(follows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order of what follows the anchors, by the ranks of its phrases in the sorted dictionary of all distinct ones.

    A phrase ends with a trigger, with which the next one begins: no phrase is the beginning of another, but for the last of
    a row, which ends early and comes first. So the order of ranks is that of the bytes.
    """
    n, width = follows.shape
    grams = Rolling(follows.reshape(-1)).grams()
    grams = np.concatenate([grams, np.full(n * width - len(grams), _NONE)]).reshape(n, width)
    cut = (grams != _NONE) & (np.arange(width) + GRAM <= sizes[:, None])
    cut[:, 0] = True
    row, start = np.nonzero(cut)
    same = np.concatenate([row[1:] == row[:-1], [False]])
    stop = np.where(same, np.concatenate([start[1:], [0]]) + GRAM, sizes[row])
    flat, base = follows.tobytes(), row * width
    dictionary, rank = np.unique(np.array([flat[a:b] for a, b in zip((base + start).tolist(), (base + stop).tolist(), strict=True)], dtype=bytes), return_inverse=True)
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    parse = np.zeros((n, int(nth.max()) + 1), np.int64)
    parse[row, nth] = rank + 1
    return np.lexsort(parse.T[::-1])


def equal_windows(group: np.ndarray, n: np.ndarray, before: np.ndarray, after: np.ndarray, seen: list[bytes]) -> np.ndarray:
    """For each context and distance whether its window occurs elsewhere in the contexts of its group."""
    k = len(seen)
    backwards = _as_rows([s[:b][::-1] for s, b in zip(seen, before.tolist(), strict=True)], STARTS)
    follows = _as_rows([s[b:] for s, b in zip(seen, before.tolist(), strict=True)], LENGTH)
    orders = []
    for order, rows in ((np.argsort(np.ascontiguousarray(backwards).view(f"S{STARTS}").ravel(), kind="stable"), backwards), (parse_order(follows, LENGTH - after), follows)):
        orders.append((order, _common(order, rows)))
    again = np.zeros((k, STARTS), bool)
    classes = np.zeros((2, k), np.int64)
    for d in range(int(after.min()), int(before.max()) + 1):
        valid = np.flatnonzero((after <= d) & (d <= before))
        for i, (order, common) in enumerate(orders):
            classes[i, order] = np.cumsum(common < (d, LENGTH - d)[i])
        key = (group[valid] * (k + 1) + classes[0, valid]) * (k + 1) + classes[1, valid]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        again[valid, d] = count[back] > 1
        # a context with n > 1 meets itself, but its places are known already
    return again


def _spans(batch: dict[str, np.ndarray], again: np.ndarray) -> pa.RecordBatch:
    """_row, start, stop of what repeated windows of single contexts cover."""
    again = again & (batch["n"] == 1)[:, None]
    edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, least = np.nonzero(edge == 1)
    most = np.nonzero(edge == -1)[1] - 1
    return pa.RecordBatch.from_arrays([pa.array(batch["_row"][row]), pa.array(batch["at"][row] - most).cast(pa.int32()), pa.array(batch["at"][row] - least + LENGTH).cast(pa.int32())], ["_row", "start", "stop"])


def _columns(batch: pa.RecordBatch) -> dict:
    return {c: batch.column(c).to_pylist() if c == "seen" else np.array(batch.column(c), np.int64) for c in batch.schema.names}


def _ordered(contexts: DataFrame) -> DataFrame:
    """_row, start, stop: what the order of the contexts of each block shows to repeat."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compare(rows: pa.Table) -> pa.RecordBatch:
            x = _columns(rows.combine_chunks().to_batches()[0])
            group = np.unique(x["g"], return_inverse=True)[1].astype(np.int64)
            return _spans(x, equal_windows(group, x["n"], x["before"], x["after"], x["seen"]))

        for batch in parts:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CONTEXTS:
                rows = pa.Table.from_batches(held)
                g = rows.column("g").to_numpy()
                whole = int(np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))[-1])
                if whole:
                    yield compare(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield compare(pa.Table.from_batches(held))

    return map_arrow(contexts.repartition("g").sortWithinPartitions("g"), run, "_row long, start int, stop int")


def _counted(contexts: DataFrame) -> DataFrame:
    """_row, start, stop of the windows of contexts, each compared by hashes with all others."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            x = _columns(batch)
            for a, b in groups_of([len(s) for s in x["seen"]], CHUNK_BYTES):
                sizes = np.array([len(s) for s in x["seen"][a:b]])
                hashes = Rolling(np.frombuffer(b"".join(x["seen"][a:b]), np.uint8))
                many = sizes - LENGTH + 1
                row = np.repeat(np.arange(a, b), many)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                at = np.repeat(np.cumsum(sizes) - sizes, many) + nth
                for twice in (False, True):  # a context that has copies gives each window twice
                    keep = (x["n"][row] > 1) | (not twice)
                    yield pa.RecordBatch.from_arrays([pa.array(v[keep]) for v in (x["_row"][row], (x["at"] - x["before"])[row] + nth, x["n"][row], hashes.of(at, at + LENGTH, 0).view(np.int64), hashes.of(at, at + LENGTH, 1).view(np.int64))], ["_row", "start", "n", "x", "y"])

    rows = settled(map_arrow(contexts, run, "_row long, start long, n long, x long, y long"))
    return repeated(rows, ["x", "y"]).filter("n = 1").select("_row", F.col("start").cast("int").alias("start"), (F.col("start") + LENGTH).cast("int").alias("stop"))


def repeated_spans(docs: DataFrame, most: int = MOST) -> DataFrame:
    """Settled _row, spans: array of (start, stop) bytes that repeated strings cover."""
    place = [F.col("_row"), (F.col("at") - F.col("before")).alias("start"), (F.col("at") - F.col("after") + LENGTH).alias("stop")]
    rows = settled(_places(docs))
    likely = settled(repeated(rows.filter(F.col("kind") != KNOWN), ["g"]))
    parts = [settled(rows.filter(F.col("kind") == KNOWN).select(*place))]
    dropped(rows)
    release(docs.sparkSession)
    contexts = settled(likely.groupBy("g", "c").agg(F.count("*").alias("n"), F.min(F.struct("_row", "at", "before", "after", "kind")).alias("one")).select("g", "c", "n", "one.*"))
    parts.append(looked_up(likely, contexts.filter("n > 1").select("g", "c", "n"), ["g", "c"]).select(*place))
    single = contexts.filter(F.col("kind") == CONTEXT)
    per_block = settled(single.groupBy("g").agg(F.count("*").alias("k"), F.min("n").alias("least")).filter("k > 1 and least = 1"))
    compared = settled(looked_up(single, per_block.select("g", "k"), ["g"], "k"))
    texts = docs.select("_row", "text")
    few, many = compared.filter(F.col("k") <= most), compared.filter(F.col("k") > most)
    involved = lambda rows: _split(texts, settled(rows.select("_row").distinct()))[1]
    parts.append(settled(_ordered(_with_text(involved(few), few))))
    if not many.isEmpty():
        parts.append(settled(_counted(_with_text(involved(many), many))))
    release(docs.sparkSession)
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    found = settled(spans.groupBy("_row").agg(F.collect_list(F.struct("start", "stop")).alias("spans")))
    for part in (likely, contexts, per_block, compared):
        dropped(part)
    return found


def _cut(text: bytes, spans: list[dict] | None) -> tuple[int, bytes]:
    """Number of stretches that go, and the bytes that stay."""
    if not spans:
        return 0, text
    line = np.zeros(len(text) + 1, np.int32)
    np.add.at(line, [s["start"] for s in spans], 1)
    np.add.at(line, [s["stop"] for s in spans], -1)
    gone = np.cumsum(line[:-1]) > 0
    return int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), np.frombuffer(text, np.uint8)[~gone].tobytes()


def suffix_dedup(docs: DataFrame, bytes_out: bool = False, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for: they may be no
    UTF-8, as characters can be cut.

    Null and empty texts have no bytes; texts of under 200 bytes lose none. Copies of a document of 200 bytes or more,
    repeated rows included, go as a whole. Extra columns are ignored. ``most``: distinct contexts of a block that are ordered in one task.
    """
    rows = keyed(docs.select("doc_id", "text"))
    spans = repeated_spans(rows, most)
    release(docs.sparkSession)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * bytes_out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            cut = "spans" in batch.schema.names
            texts = unpacked(batch) if cut else texts_of(batch)
            found = [_cut(t, s) for t, s in zip(texts, batch.column("spans").to_pylist() if cut else [None] * len(texts), strict=True)]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array([n - len(k) for n, (_, k) in zip(sizes, found, strict=True)], pa.int64()), pa.array([n for n, _ in found], pa.int64()), pa.array([sha256(k) for _, k in found], pa.string()), *[pa.array([k for _, k in found], pa.binary())] * bytes_out],
                names,
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * bytes_out
    alone, others = _split(rows, spans.select("_row"))
    found = map_arrow(packed(others).join(spans, "_row", "left").select("doc_id", "packed", "spans"), run, schema)
    return found if alone is None else map_arrow(alone.select("doc_id", "text"), run, schema).unionByName(found)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


#: Strings are compared by hashes of pairs of hashes, from one byte to 128, and of the two of 128 that 200 bytes hold.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS b FROM documents),
p0 AS (SELECT r, i, hash(b[i + 1]) AS h FROM d, unnest(range(len(b))) AS t(i)),
p1 AS (SELECT r, i, hash(h, lead(h, 1) OVER (PARTITION BY r ORDER BY i)) AS h FROM p0),
p2 AS (SELECT r, i, hash(h, lead(h, 2) OVER (PARTITION BY r ORDER BY i)) AS h FROM p1),
p3 AS (SELECT r, i, hash(h, lead(h, 4) OVER (PARTITION BY r ORDER BY i)) AS h FROM p2),
p4 AS (SELECT r, i, hash(h, lead(h, 8) OVER (PARTITION BY r ORDER BY i)) AS h FROM p3),
p5 AS (SELECT r, i, hash(h, lead(h, 16) OVER (PARTITION BY r ORDER BY i)) AS h FROM p4),
p6 AS (SELECT r, i, hash(h, lead(h, 32) OVER (PARTITION BY r ORDER BY i)) AS h FROM p5),
p7 AS (SELECT r, i, hash(h, lead(h, 64) OVER (PARTITION BY r ORDER BY i)) AS h FROM p6),
p AS (SELECT r, i, h FROM (SELECT r, i, hash(h, lead(h, 72) OVER (PARTITION BY r ORDER BY i)) AS h, count(*) OVER (PARTITION BY r) AS n FROM p7) WHERE i <= n - 200),
again AS (SELECT r, i FROM p SEMI JOIN (SELECT h FROM p GROUP BY h HAVING count(*) > 1) AS twice USING (h)),
marked AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS span FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM again)),
spans AS (SELECT r, min(i) AS s, max(i) + 200 AS e FROM marked GROUP BY r, span),
cuts AS (SELECT r, count(*) AS n_spans, sum(e - s) AS gone, list(s ORDER BY s) AS starts, list(e ORDER BY s) AS ends FROM spans GROUP BY r)
SELECT doc_id, len(b) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN starts IS NULL THEN array_to_string(b, '') ELSE array_to_string(list_transform(range(len(starts) + 1), lambda i: array_to_string(b[CASE WHEN i = 0 THEN 1 ELSE ends[i] + 1 END:CASE WHEN i = len(starts) THEN len(b) ELSE starts[i + 1] END], '')), '') END)) AS kept_sha256 FROM d LEFT JOIN cuts USING (r)
"""
