"""Substring dedup by level-wise doubling.

A passage goes if a window of WINDOW (35) consecutive words occurs more than once. Windows of 16 words are compared
first. Only those that repeat are extended to 32 words, and of these only those that repeat to 64. A repeated window of 64
words settles all that is inside of it. Where a window of 16 words repeats and no window of 64 words does, the windows of
35 words around it are compared.

The first level doesn't look at every word: of each 20 consecutive starts, the one whose four words hash lowest is an
anchor. A 35-word window holds the anchor of its first 20 starts together with the anchor's 16 words, so equal
windows have equal anchors and no repeat is lost. Windows are compared by hashes of both of their halves, of 128 bits.

Scale: the first level shuffles a row for about a tenth of the words; later levels only what is left. Hashes are counted
with map-side combining; the frequent ones, of a bounded number, meet their rows by a broadcast, so that a passage
that a third of all documents share is neither gathered in one task nor paired with itself. Of a 64-word window's
copies only one hands its inner windows to the last level. Texts are shuffled, compressed, only where an anchor repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import BROADCAST_BYTES, WordHashes, dropped, groups_of, keyed, map_arrow, mix, packed, release, repeated, settled, sha256, size_bytes, table, texts_of, unpacked

#: Fixed by the contract: words of a window.
WINDOW = 35
#: Words that choose an anchor, starts among which one is chosen, words of the levels.
GRAM, STARTS, FIRST, SECOND, WIDEST = 4, 20, 16, 32, 64
#: What an anchor is: repeated at the first level, repeated at the widest, and the one of those that stands for its copies.
CANDIDATE, SURE, STANDS = 0, 1, 2
#: Bytes of text that are hashed together.
CHUNK_BYTES = 4 << 20


class Hashes:
    """Window hashes of some documents at once. Each is followed by WIDEST empty words, so that windows may end early."""

    def __init__(self, texts: list[bytes], cache: WordHashes):
        words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + WIDEST)])[:-1]
        total = int((self.sizes + WIDEST).sum())
        self.word = np.zeros(total, np.uint64)
        self.left = np.zeros(total, np.int64)
        for w, at in zip(words, self.starts.tolist(), strict=True):
            if w:
                self.word[at : at + len(w)] = cache.of(w)
                self.left[at : at + len(w)] = np.arange(len(w), 0, -1)

    @staticmethod
    def _wider(h: np.ndarray, step: int) -> np.ndarray:
        return mix(h, np.concatenate([h[step:], np.zeros(step, np.uint64)]))

    def levels(self, most: int) -> dict[int, np.ndarray]:
        """Hash of the window at each word, for lengths 1, 2, 4 ... most."""
        out, n = {1: self.word}, 1
        while n < most:
            out[2 * n] = self._wider(out[n], n)
            n *= 2
        return out

    def anchors(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows, and the anchor of each."""
        low = (grams >> np.uint64(28) << np.uint64(28)) | np.arange(len(grams), dtype=np.uint64)
        for step in (1, 2, 4, 8, 4):  # the least of 2, 4, 8, 16 and 20 starts
            low = np.minimum(low, np.concatenate([low[step:], np.full(step, np.uint64(2**64 - 1))]))
        starts = np.flatnonzero(self.left >= WINDOW)
        return starts, (low[starts] & np.uint64(2**28 - 1)).astype(np.int64)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """_row, pos, h16, h32, h64: each anchor's window of each level; those at the end of a text are shorter."""
    schema = pa.schema([("_row", pa.int64()), ("pos", pa.int32()), ("h16", pa.int64()), ("h32", pa.int64()), ("h64", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in parts:
            texts, rows = texts_of(batch), np.array(batch.column("_row"), np.int64)
            for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
                h = Hashes(texts[a:b], cache)
                levels = h.levels(WIDEST)
                chosen = np.unique(np.concatenate([h.anchors(levels[GRAM])[1], h.starts[h.sizes >= WINDOW]]))
                doc = h.doc_of(chosen)
                yield pa.RecordBatch.from_arrays([pa.array(rows[a:b][doc]), pa.array((chosen - h.starts[doc]).astype(np.int32)), *(pa.array(levels[n][chosen].view(np.int64)) for n in (FIRST, SECOND, WIDEST))], schema=schema)

    return map_arrow(docs.select("_row", "text"), run, "_row long, pos int, h16 long, h32 long, h64 long")


def _repeated_anchors(docs: DataFrame) -> DataFrame:
    """Settled _row, anchors: array of (pos, kind). A level looks at what repeats at the one before, and at nothing else."""
    rows = settled(_anchor_rows(docs))
    first = settled(repeated(rows, ["h16"]))
    dropped(rows)
    second = settled(repeated(first, ["h16", "h32"]))
    widest = settled(repeated(second, ["h32", "h64"]))
    stands = widest.groupBy("h32", "h64").agg(F.min(F.struct("_row", "pos")).alias("one")).select("one.*")
    kinds = [part.select("_row", F.struct("pos", F.lit(kind).alias("kind")).alias("a")) for part, kind in ((first, CANDIDATE), (widest, SURE), (stands, STANDS))]
    found = settled(kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).groupBy("_row").agg(F.collect_list("a").alias("anchors")))
    for part in (first, second, widest):
        dropped(part)
    return found


def _unsure_windows(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """_row, pos, h32, h35 of the windows at repeated anchors that no sure window holds, and of those in one that stands for its
    copies. ``texts``: _row, packed."""
    schema = pa.schema([("_row", pa.int64()), ("pos", pa.int32()), ("h32", pa.int64()), ("h35", pa.int64()), ("held", pa.bool_())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in parts:
            texts, rows, found = unpacked(batch), np.array(batch.column("_row"), np.int64), batch.column("anchors").to_pylist()
            for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
                h = Hashes(texts[a:b], cache)
                levels = h.levels(32)
                again = np.zeros(len(h.word), bool)
                held, first = np.zeros(len(h.word) + 1, np.int32), np.zeros(len(h.word) + 1, np.int32)
                for start, size, one in zip(h.starts.tolist(), h.sizes.tolist(), found[a:b], strict=True):
                    for x in one:
                        at, stop = start + x["pos"], start + min(x["pos"] + WIDEST, size) - WINDOW + 1
                        if x["kind"] == CANDIDATE:
                            again[at] = True
                        elif stop > at:
                            line = held if x["kind"] == SURE else first
                            line[at] += 1
                            line[stop] -= 1
                held_at, first_at = np.cumsum(held) > 0, np.cumsum(first) > 0
                starts, anchor = h.anchors(levels[GRAM])
                keep = starts[again[anchor] & (~held_at[starts] | first_at[starts])]
                doc = h.doc_of(keep)
                h35 = mix(levels[32][keep], levels[32][keep + WINDOW - 32])
                yield pa.RecordBatch.from_arrays([pa.array(rows[a:b][doc]), pa.array((keep - h.starts[doc]).astype(np.int32)), pa.array(levels[32][keep].view(np.int64)), pa.array(h35.view(np.int64)), pa.array(held_at[keep])], schema=schema)

    return map_arrow(texts.join(anchors, "_row"), run, "_row long, pos int, h32 long, h35 long, held boolean")


def _split(docs: DataFrame, involved: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Documents that no row of ``involved`` names, and the others. The ids are broadcast if they are small enough; beyond that
    size all documents count as the others."""
    if size_bytes(involved) * 4 > BROADCAST_BYTES:
        return None, docs
    return docs.join(F.broadcast(involved), "_row", "left_anti"), docs.join(F.broadcast(involved), "_row", "left_semi")


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Settled _row, spans: array of (start, end) words that windows occurring more than once cover; and settled _row of the
    documents that have repeated anchors."""
    anchors = _repeated_anchors(docs)
    involved = settled(anchors.select("_row"))
    release(docs.sparkSession)
    windows = settled(_unsure_windows(packed(_split(docs, involved)[1].select("_row", "text")), anchors))
    release(docs.sparkSession)
    last = repeated(windows.filter("not held"), ["h32", "h35"], windows).select("_row", F.struct("pos", (F.col("pos") + WINDOW).alias("end")).alias("s"))
    sure = anchors.select("_row", F.explode(F.filter("anchors", lambda x: x["kind"] == SURE)).alias("x")).select("_row", F.struct(F.col("x.pos").alias("pos"), (F.col("x.pos") + WIDEST).alias("end")).alias("s"))
    found = settled(sure.unionByName(last).groupBy("_row").agg(F.collect_list("s").alias("spans")))
    dropped(windows)
    dropped(anchors)
    return found, involved


def _cut(text: bytes, spans: list[dict] | None) -> tuple[int, list[bytes]]:
    words = text.split()
    if not spans:
        return len(words), words
    line = np.zeros(len(words) + WIDEST + 1, np.int32)
    for s in spans:  # a window that ends early is shorter than 35 words only where it settles nothing
        end = min(s["end"], len(words))
        if end - s["pos"] >= WINDOW:
            line[s["pos"]] += 1
            line[end] -= 1
    keep = np.cumsum(line)[: len(words)] == 0
    return len(words), [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def substring_dedup(docs: DataFrame, text_out: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and the kept words if asked for.

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return. Null and
    empty texts have none; texts of under 35 words lose none. Copies of a document, repeated rows included, lose
    all that 35-word windows cover. Extra columns are ignored.
    """
    rows = keyed(docs.select("doc_id", "text"))
    spans, involved = repeated_spans(rows)
    release(docs.sparkSession)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * text_out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            n, gone, sha, kept = [], [], [], []
            cut = "spans" in batch.schema.names
            for text, one in zip(unpacked(batch) if cut else texts_of(batch), batch.column("spans").to_pylist() if cut else [None] * batch.num_rows, strict=True):
                total, words = _cut(text, one)
                joined = b" ".join(words)
                n.append(total)
                gone.append(total - len(words))
                sha.append(sha256(joined))
                if text_out:
                    kept.append(joined.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), *[pa.array(kept, pa.string())] * text_out], names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * text_out
    alone, others = _split(rows, involved)
    found = map_arrow(packed(others).join(spans, "_row", "left").select("doc_id", "packed", "spans"), run, schema)
    return found if alone is None else map_arrow(alone.select("doc_id", "text"), run, schema).unionByName(found)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
twice AS (SELECT h FROM p GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + k AS j FROM p SEMI JOIN twice USING (h), range(35) AS t(k)),
lists AS (SELECT r, list(j) AS js FROM gone GROUP BY r),
words AS (SELECT d.doc_id, d.r, len(d.w) AS n, list_filter(d.w, lambda x, i: NOT coalesce(list_contains(js, i), false)) AS kept FROM d LEFT JOIN lists USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM words
"""
