"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of 13 consecutive words of each benchmark item, or the whole item when it has fewer.
A table of shifts by block (the last two words in view) tells how far the search may jump; a block that ends
some window leads to a bucket of windows by their last and first two words, and direct comparison of the words confirms.
Documents are searched in stretches that advance side by side.

Scale: documents are read once and never shuffled. The benchmark is the stated query set: it is compiled in parts of
about PART_BYTES, each in a task of its own, to sorted arrays in the shared folder, of about seven bytes for each byte of
text, which the workers memory-map. A benchmark of more parts means more passes.
"""

from __future__ import annotations

import io
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import WordHashes, fetched, groups_of, map_arrow, mapped_array, mix, numbered, put_file, settled, sha256, shared_dir, table, texts_of, words_of

#: Words of a window; words of a block.
WINDOW, BLOCK = 13, 2
#: Bytes of benchmark text that are compiled together, bytes of documents that are searched together, window ends of a stretch.
PART_BYTES, CHUNK_BYTES, STRETCH = 16 << 20, 4 << 20, 256

HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_starts array<int>, hit_ends array<int>, item_ids array<string>"
#: Arrays of the windows of one length: blocks and shifts; buckets, and of their windows the first word and the owners.
ARRAYS = ("blocks", "shifts", "buckets", "first", "owners_at", "owners")


def _block(h: np.ndarray, last: np.ndarray, block: int) -> np.ndarray:
    """Hash of the block that ends with each given word."""
    return mix(h[last - 1], h[last]) if block == BLOCK else h[last]


def compiled(rows: Iterator[tuple[object, bytes]], folder: str, window: int = WINDOW) -> None:
    """Write the arrays of some items (id, text). Rows of one id are one item; texts without words have no windows."""
    hashes, items, texts = WordHashes(), {}, []
    word_hashes, owner, size_of = [], [], []
    for item, text in rows:
        words = words_of(text)
        if words:
            owner.append(items.setdefault(item, len(items)))
            size_of.append(len(words))
            word_hashes.append(hashes.of(words))
            texts.append(b" ".join(words) + b" ")
    data = b"".join(texts)
    h = np.concatenate(word_hashes) if word_hashes else np.zeros(0, np.uint64)
    letters = np.frombuffer(data, np.uint8)
    word_at = np.concatenate([[0], np.flatnonzero(letters == 32) + 1]).astype(np.int64)  # and the end of the last
    size_of, owner = np.array(size_of, np.int64), np.array(owner, np.int32)
    row_at = np.cumsum(size_of) - size_of
    _save(folder, words=h, word_at=word_at)
    put_file(f"{folder}/text", data)
    sizes = sorted(set(np.minimum(size_of, window).tolist()))
    put_file(f"{folder}/items", pickle.dumps((sizes, [str(x) for x in items])))
    for size in sizes:
        block = min(BLOCK, size)
        mine = np.flatnonzero(np.minimum(size_of, window) == size)
        every, of = _places(row_at[mine], size_of[mine] - size + 1)
        who = owner[mine][of]
        ends, of = _places(row_at[mine] + block - 1, size_of[mine] - block + 1)
        shift = np.maximum(0, size - 1 - (ends - row_at[mine][of])).astype(np.uint8)
        key = _block(h, ends, block)
        order = np.lexsort((shift, key))
        key, shift = key[order], shift[order]
        once = np.concatenate([[True], key[1:] != key[:-1]])
        whole = np.full(len(every), np.uint64(size))
        for i in range(size):
            whole = mix(whole, h[every + i])
        bucket = mix(_block(h, every + size - 1, block), _block(h, every + block - 1, block))
        order = np.lexsort((who, whole, bucket))
        bucket, whole, every, who = bucket[order], whole[order], every[order], who[order]
        new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (whole[1:] != whole[:-1])])
        other = new | np.concatenate([[True], who[1:] != who[:-1]])
        owners_at = np.append(np.flatnonzero(new[other]), other.sum())
        _save(folder, **{f"{size}-{n}": x for n, x in zip(ARRAYS, (key[once], shift[once], bucket[new], every[new], owners_at, who[other]), strict=True)})


def _places(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """starts[i], starts[i] + 1 ... for counts[i] places each, and the i of each."""
    of = np.repeat(np.arange(len(starts)), counts)
    return starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts), of


def _save(folder: str, **arrays: np.ndarray) -> None:
    for name, x in arrays.items():
        out = io.BytesIO()
        np.save(out, x)
        put_file(f"{folder}/{name}.npy", out.getbuffer())


class Patterns:
    """Compiled windows of a part, memory-mapped."""

    def __init__(self, folder: str):
        with open(fetched(f"{folder}/items"), "rb") as f:
            sizes, self.items = pickle.load(f)
        self.words, self.word_at = (mapped_array(f"{folder}/{n}.npy") for n in ("words", "word_at"))
        self.text = np.memmap(fetched(f"{folder}/text"), np.uint8, "r") if sizes else np.zeros(0, np.uint8)
        self.groups = [(size, [mapped_array(f"{folder}/{size}-{n}.npy") for n in ARRAYS]) for size in sizes]
        self.hashes = WordHashes()

    @staticmethod
    def _ends(h: np.ndarray, size: int, last: np.ndarray, stop: np.ndarray, blocks: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        """Last words of the places whose block ends some window. Each stretch jumps from ``last`` on, as far as its block says."""
        block, found = min(BLOCK, size), []
        while len(last):
            key = _block(h, last, block)
            at = np.minimum(np.searchsorted(blocks, key), len(blocks) - 1)
            jump = np.where(blocks[at] == key, shifts[at], size - block + 1)
            found.append(last[jump == 0])
            last = last + np.maximum(jump, 1)
            going = last < stop
            last, stop = last[going], stop[going]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[int]]]:
        """Spans of words and numbers of items of each text's occurrences. ``texts``: their words."""
        out: list[tuple[list, set]] = [([], set()) for _ in texts]
        sizes = np.array([len(w) for w in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        h = np.concatenate([self.hashes.of(w) for w in texts]) if sizes.sum() else np.zeros(0, np.uint64)
        for size, (blocks, shifts, buckets, first, owners_at, owners) in self.groups:
            ends = np.maximum(sizes - size + 1, 0)
            nth, of = _places(np.zeros(len(texts), np.int64), -(-ends // STRETCH))
            from_ = nth * STRETCH
            last = starts[of] + size - 1 + from_
            places = np.sort(self._ends(h, size, last, last + np.minimum(STRETCH, ends[of] - from_), blocks, shifts))
            block = min(BLOCK, size)
            key = mix(_block(h, places, block), _block(h, places - size + block, block))
            low, high = np.searchsorted(buckets, key), np.searchsorted(buckets, key, side="right")
            window, of = _places(low, high - low)
            begin = places[of] - size + 1
            same = np.ones(len(window), bool)
            for i in range(size):
                same &= h[begin + i] == self.words[first[window] + i]
            window, begin = window[same], begin[same]
            doc = np.searchsorted(starts, begin, side="right") - 1
            for w, d, at in zip(window.tolist(), doc.tolist(), (begin - starts[doc]).tolist(), strict=True):
                a, b = self.word_at[first[w]], self.word_at[first[w] + size] - 1
                if self.text[a:b].tobytes() == b" ".join(texts[d][at : at + size]):
                    out[d][0].append((at, at + size))
                    out[d][1].update(owners[owners_at[w] : owners_at[w + 1]].tolist())
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same words."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _verdict(n_words: int, spans: list, items: set) -> dict:
    hit = sum(b - a for a, b in spans)
    ids = sorted(map(str, items))
    return {"n_words": n_words, "n_hit": hit, "n_items": len(ids), "items_sha256": sha256(",".join(ids).encode()), "contaminated": hit > 0 and 20 * hit >= n_words, "hit_starts": [a for a, _ in spans], "hit_ends": [b for _, b in spans], "item_ids": ids}


def _judged(patterns: Patterns, texts: list[bytes]) -> Iterator[dict]:
    for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
        words = [words_of(t) for t in texts[a:b]]
        for w, (spans, items) in zip(words, patterns.search(words), strict=True):
            yield _verdict(len(w), merged(spans), {patterns.items[i] for i in items})


def _parts(bench: DataFrame, part_bytes: int) -> list[DataFrame]:
    """The items in parts of about part_bytes; items without id or text are left out."""
    items = bench.select("item_id", "text").dropna()
    n = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes + 1
    return [items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) if n > 1 else items for i in range(n)]


def _compiled(part: DataFrame, window: int) -> str:
    """Compile one part in one task; its size is bounded. Return its folder."""
    folder = shared_dir(part.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled(((item, text) for batch in batches for item, text in zip(batch.column("item_id").to_pylist(), texts_of(batch), strict=True)), folder, window)
        yield pa.RecordBatch.from_arrays([pa.array([True])], ["done"])

    if not map_arrow(part.repartition(1), run, "done boolean").collect():  # no task had a row
        compiled(iter(()), folder, window)
    return folder


def _scan(docs: DataFrame, folder: str, ids: list[str]) -> DataFrame:
    kept = docs.select(*ids, "text")
    out = kept.drop("text").schema.simpleString()[7:-1].replace(":", " ")
    rest = HITS.split(", ", 1)[1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(folder)
        for batch in parts:
            rows = list(_judged(patterns, texts_of(batch)))
            columns = [batch.column(i) for i in ids] + [pa.array([r[k] for r in rows], kind) for k, kind in KINDS.items()]
            yield pa.RecordBatch.from_arrays(columns, [*ids, *KINDS])

    return map_arrow(kept, run, f"{out}, {rest}")


KINDS = {"n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "items_sha256": pa.string(), "contaminated": pa.bool_(), "hit_starts": pa.list_(pa.int32()), "hit_ends": pa.list_(pa.int32()), "item_ids": pa.list_(pa.string())}


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the ids, n_words, n_hit, n_items, items_sha256, contaminated, spans and item ids.

    Null and empty texts have no words and are clean. Items without id, text or words are ignored; rows of one
    item_id count as one item. Repeated documents are judged one by one. Empty tables give no rows, or clean ones.
    """
    parts = [_compiled(part, window) for part in _parts(bench, part_bytes)]
    if len(parts) == 1:
        return _scan(docs, parts[0], list(ids))
    rows = settled(numbered(docs.select(*ids, "text")))
    scans = [_scan(rows, part, ["_row", *ids]) for part in parts]
    every = scans[0]
    for scan in scans[1:]:
        every = every.unionByName(scan)
    joined = every.groupBy("_row").agg(
        *(F.first(c).alias(c) for c in (*ids, "n_words")),
        F.flatten(F.collect_list("hit_starts")).alias("_a"), F.flatten(F.collect_list("hit_ends")).alias("_b"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    spans = F.array_sort(F.arrays_zip("_a", "_b"))
    step = lambda out, x: F.when((F.size(out) > 0) & (x["_a"] <= F.element_at(out, -1)["_b"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["_a"].alias("_a"), F.greatest(F.element_at(out, -1)["_b"], x["_b"]).alias("_b"))))).otherwise(F.concat(out, F.array(x)))
    whole = joined.withColumn("_s", F.aggregate(spans, F.expr("cast(array() as array<struct<_a:int,_b:int>>)"), step))
    hit = F.aggregate("_s", F.lit(0).cast("long"), lambda n, x: n + x["_b"] - x["_a"])
    whole = whole.withColumn("n_hit", hit).withColumn("n_items", F.size("item_ids").cast("long"))
    return whole.select(*ids, "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), F.col("_s._a").alias("hit_starts"), F.col("_s._b").alias("hit_ends"), "item_ids")


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents that aren't contaminated, all columns as they are."""
    parts = _parts(bench, part_bytes)
    if len(parts) > 1:
        rows = settled(numbered(docs.select(F.struct("*").alias("_doc"), "text"), "_nth"))
        bad = contamination(rows, bench, window, part_bytes, ("_nth",)).filter("contaminated").select("_nth")
        return rows.join(bad, "_nth", "left_anti").select("_doc.*")
    folder = _compiled(parts[0], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(folder)
        for batch in batches:
            yield batch.filter(pa.array([not x["contaminated"] for x in _judged(patterns, texts_of(batch))], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hit_starts", "hit_ends", "item_ids")


#: Words of both tables, 13-word windows of the items, equal windows of the documents.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
        FROM b, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS t(i)),
occ AS (SELECT p.doc_id, p.i, p.k, v.item_id FROM pos p JOIN win v ON p.k = v.k AND p.s = v.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, i, k FROM occ), unnest(range(i, i + k)) AS t(j) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s, list(x ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
