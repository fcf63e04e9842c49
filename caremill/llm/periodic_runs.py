"""Periodic run detection: seeds on diagonals, extended once.

A run is a stretch of words with smallest period q that is at least 3 * q and at least 24 words long. Words q apart then
agree over at least max(24 - q, 2 * q) words, so a run of period 16 or less holds the same 16-gram twice, q apart, and a run
of a period above k / 2 up to k (k = 32, 64 ...) the same k-gram: these are the least overlaps that are guaranteed. As k
isn't below q, the copies of such a k-gram inside a run stand exactly q apart: nearer ones would give the run a smaller
period. So only occurrences next to each other are paired, and no k-gram's pairs grow with the square of its number.

k-grams are named without hashes: a pair of names of half the length gets a new name if it occurs twice in its document;
places whose half occurs once are left out. Each pair is a seed on the diagonal of its lag. Seeds are extended both ways;
a table of how far each lag is covered drops seeds that lie in a run already found.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from caremill.llm.common import groups_of, map_arrow, sha256, table, texts_of

#: Fixed by the contract: the least length of a run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The shortest k-gram that seeds; it serves all periods up to its own length.
SEED = 16
#: Bytes of text that are searched together.
CHUNK_BYTES = 4 << 20

Run = tuple[int, int, int]


def rewritten(words: list[bytes], doc_id) -> list[bytes]:
    """The contract's words of a document: every tenth one repeats a stretch of itself from some word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    first = g % n
    stretch = words[first : first + 1 + (n - first) // (3 + g % 8)]
    return words[:first] + (stretch * ((n - first) // len(stretch) + 1))[: n - first]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, list[int]]:
    """Word numbers of all documents, no number in two of them, with a zero before, between and after; and where each starts."""
    parts, starts, at, total = [np.zeros(1, np.int64)], [], 1, 1
    for words in texts:
        known: dict[bytes, int] = {}
        line = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + at
        starts.append(total)
        parts += [line, np.zeros(1, np.int64)]
        at += len(known)
        total += len(words) + 1
    return np.concatenate(parts), starts


def _seeds(word: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length k: k, and the places and lags of neighbouring occurrences of a k-gram that k serves."""
    name, k = word, 1
    places = np.flatnonzero((np.bincount(word)[word] > 1) & (word > 0))
    while len(places) and k * LEAST_PERIODS // 2 <= longest:
        places = places[places + k < len(word)]
        second = name[places + k]
        places, second = places[second > 0], second[second > 0]
        key = name[places] * (int(name.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        key, at = key[order], places[order]
        same = key[1:] == key[:-1]
        again = np.concatenate([same, [False]])[: len(at)] | np.concatenate([[False], same])[: len(at)]
        k *= 2
        if k >= SEED:
            lag = np.diff(at)
            served = same & (lag <= k) & ((lag > k // 2) | (k == SEED))
            yield k, at[:-1][served], lag[served]
        group = np.cumsum(np.concatenate([[True], ~same])) if len(at) else np.zeros(0, np.int64)
        name = np.zeros(len(word), np.int64)
        name[at[again]] = group[again]
        places = np.sort(at[again])


def _agree(word: np.ndarray, a: int, b: int, way: int) -> int:
    """Words that agree from a and b on, forwards (1) or backwards (-1, not counting a and b themselves)."""
    total, step = 0, 64
    while True:
        if way > 0:
            x, y = word[a + total : a + total + step], word[b + total : b + total + step]
            x = x[: len(y)]
        else:
            x, y = word[max(0, a - total - step) : a - total][::-1], word[max(0, b - total - step) : b - total][::-1]
            y = y[: len(x)]
        differ = x != y
        if differ.any():
            return total + int(differ.argmax())
        if len(x) < step:
            return total + len(x)
        total, step = total + step, step * 4


def _runs(word: np.ndarray, longest: int) -> Iterator[Run]:
    """start, length and period of each run, as places of ``word``."""
    for k, places, lags in _seeds(word, longest):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        head = np.ones(len(places), bool)  # a seed right after another of its lag is covered by it
        head[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
        covered: dict[int, int] = {}
        for at, lag in zip(places[head].tolist(), lags[head].tolist(), strict=True):
            if at < covered.get(lag, -1):
                continue
            start = at - _agree(word, at, at + lag, -1)
            stop = at + k + _agree(word, at + k, at + k + lag, 1)
            covered[lag] = stop
            length = stop + lag - start
            if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                yield start, length, lag


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document, by start and period."""
    word, starts = _numbered(texts)
    found: list[list[Run]] = [[] for _ in texts]
    for start, length, period in sorted(_runs(word, max(map(len, texts), default=0))):
        i = int(np.searchsorted(starts, start, side="right")) - 1
        found[i].append((start - starts[i], length, period))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without what follows the first period of a run."""
    if not runs:
        return words
    line = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        line[start + period] += 1
        line[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(line).tolist()) if not covered]


def _strongest(runs: list[Run]) -> Run | None:
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def periodic_runs(docs: DataFrame, rewrite: bool = False, text_out: bool = False) -> DataFrame:
    """One row per document: doc_id, n_runs, start, length, period and exponent_milli of the run with the greatest
    length / period, runs_sha256, collapsed_sha256; with ``text_out`` also runs (array of structs) and collapsed_text.
    ``rewrite``: the documents are changed first as the contract says.

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return. Null and empty texts
    have no words, no runs and the digests of nothing; a null doc_id is never rewritten; equal rows and ids are results of
    their own; extra columns are ignored. A document is searched as a whole in one task, in time n log(n) of its words.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    schema += ", runs array<struct<start: long, length: long, period: long>>, collapsed_text string" * text_out
    names = [x.split()[0] for x in schema.split(", ")[:8]] + ["runs", "collapsed_text"] * text_out
    struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts, ids = texts_of(batch), batch.column("doc_id").to_pylist()
            for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
                words = [rewritten(t.split(), i) if rewrite else t.split() for t, i in zip(texts[a:b], ids[a:b], strict=True)]
                found = find_runs(words)
                best = [_strongest(x) or (None, None, None) for x in found]
                kept = [b" ".join(collapsed(w, x)) for w, x in zip(words, found, strict=True)]
                columns = [
                    batch.column("doc_id").slice(a, b - a), pa.array(map(len, found), pa.int64()), *(pa.array([x[i] for x in best], pa.int64()) for i in range(3)),
                    pa.array([x[1] * 1000 // x[2] if x[2] else None for x in best], pa.int64()),
                    pa.array([sha256("".join(f"{s},{n},{q}\n" for s, n, q in x).encode()) for x in found], pa.string()), pa.array(map(sha256, kept), pa.string()),
                ]
                if text_out:
                    columns += [pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in found], struct), pa.array([x.decode() for x in kept], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), rewrite=True)


ORACLE_SQL = r"""
WITH ids AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, CAST(doc_id AS VARCHAR) AS s FROM documents),
hashed AS (SELECT doc_id, r, w, len(w) AS n, CASE WHEN s IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, len(s) + 1), lambda i: list_concat([CAST(256 + ord(s[i]) AS BIGINT)], CAST([-1, -1, -1, -1, -1, -1, -1, -1] AS BIGINT[]))))), lambda c, e: CASE WHEN e >= 256 THEN xor(c, e - 256) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295) END AS h FROM ids),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, (h // 10) % 8 AS k FROM hashed),
d AS (SELECT doc_id, r, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + k)) + 1] END) END AS w FROM placed),
grams AS (SELECT r, i, md5(array_to_string(w[i + 1:i + 16], ' ')) AS h FROM d, unnest(range(n - 15)) AS t(i)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.h = y.h AND x.i < y.i),
stretches AS (SELECT r, q, min(i) AS s, max(i) + 16 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs) GROUP BY r, q, island),
runs AS (SELECT r, s, e - s AS n, q FROM stretches x WHERE e - s >= greatest(24, 3 * q) AND NOT EXISTS (SELECT 1 FROM stretches y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.e >= x.e)),
best AS (SELECT r, count(*) AS n_runs, arg_min(struct_pack(s := s, n := n, q := q), struct_pack(a := -(n::DECIMAL(38, 20) / q), b := s, c := q)) AS x, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS said FROM runs GROUP BY r),
gone AS (SELECT r, list(DISTINCT i) AS js FROM runs, unnest(range(s + q, s + n)) AS t(i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, x.s AS start, x.n AS length, x.q AS period, 1000 * x.n // x.q AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256,
    sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_filter(w, lambda y, i: NOT list_contains(js, i - 1)) END, ' ')) AS collapsed_sha256 FROM d LEFT JOIN best USING (r) LEFT JOIN gone USING (r)
"""
