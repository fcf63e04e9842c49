"""LM scoring by an interpolated modified Kneser-Ney bigram model.

Spark counts all bigrams of the training texts: tasks combine what they read, shards by hash add it up. Each shard
is stored as sorted hash arrays in the shared folder, and so are the words with their own, continuation and
context counts. Workers memory-map the arrays to score texts.

Scale: what a task sends is packed to about nine bytes for each distinct bigram. The number of shards grows with the
corpus so that a shard's size stays the same. Contexts that a bounded sample shows to be frequent are spread over
all shards; that only lays rows out and changes no count. The driver gets sums over shards.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import LOWER_BYTES, WordHashes, groups_of, map_arrow, mapped_array, mix, put_file, settled, shared_dir, table, texts_of

#: Training tokens for each shard, tokens that a task counts together, bytes of text that are scored together.
SHARD_TOKENS, TASK_TOKENS, CHUNK_BYTES = 6_000_000, 3_000_000, 6 << 20
#: Documents whose words show which contexts are frequent.
LAYOUT_DOCS = 500
#: Fixed by the contract: what the base model adds to each count.
ADDED = 0.1
#: Hashes of the end of a text and of the start before it; words have larger ones, of 48 bits.
END, START, BITS = 0, 1, 48


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER_BYTES).split()


class Texts:
    """Token hashes of some texts in a row, each text closed by END, and the hash before each token."""

    def __init__(self, texts: list[bytes], cache: WordHashes):
        words = [tokens_of(t) for t in texts]
        self.sizes = np.array([len(w) + 1 for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.token = np.full(int(self.sizes.sum()), np.uint64(END))
        for w, at in zip(words, self.starts.tolist(), strict=True):
            if w:
                self.token[at : at + len(w)] = np.maximum(cache.of(w) >> np.uint64(64 - BITS), np.uint64(START + 1))
        self.before = np.concatenate([[np.uint64(START)], self.token[:-1]]) if len(texts) else self.token
        self.before[self.starts] = START


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of 48-bit hashes."""
    return ((hashes >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def bigram_shard(before: np.ndarray, key: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By the word before; by the whole bigram where that word is frequent."""
    return np.where(np.isin(before, hot), shard_of(key >> np.uint64(64 - BITS), shards), shard_of(before, shards))


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _eight(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _in_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value as repeats of numbers up to 255 that add up to it: (index of the value, number)."""
    times = np.maximum(-(-values // 255), 1)
    at = np.repeat(np.arange(len(values)), times)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    return at, np.minimum(255, values[at] - nth * 255).astype(np.uint8)


def pack(u: np.ndarray, v: np.ndarray, n: np.ndarray) -> bytes:
    """Bigrams in the order of u: each u once for up to 255 bigrams."""
    at, n8 = _in_bytes(n)
    u, v = u[at], v[at]
    first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
    which, run = _in_bytes(np.diff(np.append(first, len(u))))
    return np.array([len(run), len(v)], np.int32).tobytes() + _six(u[first][which]) + run.tobytes() + _six(v) + n8.tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nu, nv = np.frombuffer(data[:8], np.int32).tolist()
    a = 8 + 6 * nu
    u = np.repeat(_eight(data[8:a]), np.frombuffer(data[a : a + nu], np.uint8))
    b = a + nu
    return u, _eight(data[b : b + 6 * nv]), np.frombuffer(data[b + 6 * nv :], np.uint8).astype(np.int64)


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return (key[first], *(np.add.reduceat(x[order], first) if len(key) else x for x in values))


def _put(folder: str, **arrays: np.ndarray) -> None:
    """Arrays as files."""
    for name, x in arrays.items():
        out = io.BytesIO()
        np.save(out, x)
        put_file(f"{folder}/{name}.npy", out.getbuffer())


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32 if not len(x) or x.max() < 2**32 else np.uint64)


def _counted(texts: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """(shard, data): packed bigrams of what each task has read."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held, size = WordHashes(), [], 0

        def flush() -> pa.RecordBatch:
            u, v = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            key, first, n = np.unique(mix(u, v), return_index=True, return_counts=True)
            u, v = u[first], v[first]
            shard = bigram_shard(u, key, hot, shards)
            order = np.lexsort((v, u, shard))
            u, v, n, shard = u[order], v[order], n[order], shard[order]
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])).tolist()
            data = [pack(u[a:b], v[a:b], n[a:b]) for a, b in zip(cuts, [*cuts[1:], len(u)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(shard[cuts].astype(np.int32)), pa.array(data, pa.binary())], ["shard", "data"])

        for batch in parts:
            docs = texts_of(batch)
            for a, b in groups_of([len(t) for t in docs], CHUNK_BYTES):
                t = Texts(docs[a:b], cache)
                held.append((t.before, t.token))
                size += len(t.token)
                if size >= TASK_TOKENS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return map_arrow(texts, run, "shard int, data binary")


def _bigram_shards(counted: DataFrame, folder: str, shards: int) -> DataFrame:
    """Write the bigrams of each shard; return (shard, kind, data, sums): what the shards of words need."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        u, v, n = (np.concatenate(x) for x in zip(*(unpack(d) for d in rows.column("data").to_pylist()), strict=True))
        hashes = mix(u, v)
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
        total = np.add.reduceat(n[order], first)
        at = order[first]
        u, v, hashes = u[at], v[at], hashes[at]
        low = np.minimum(total, 255).astype(np.uint8)
        _put(f"{folder}/bigrams-{key[0].as_py()}", keys=hashes, low=low, big=hashes[total >= 255], count=_narrow(total[total >= 255]))
        times = np.bincount(np.minimum(total, 5), minlength=6)[1:5].tolist()
        out: dict[str, list] = {"shard": [], "kind": [], "data": []}
        one = np.ones(len(u), np.int64)
        for kind, word, values in (("context", u, (total, *((total == i).astype(np.int64) for i in (1, 2)), (total > 2).astype(np.int64))), ("token", v, (total, one))):
            word, *sums = _summed(word, *values)
            where = shard_of(word, shards)
            cuts = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(word)], strict=True):
                out["shard"].append(int(where[a]))
                out["kind"].append(kind)
                out["data"].append(_words_packed(word[a:b], [s[a:b] for s in sums]))
        return pa.table({"shard": pa.array(out["shard"], pa.int32()), "kind": out["kind"], "data": pa.array(out["data"], pa.binary()), "sums": pa.array([[*times, int(total.sum()), len(u)]] + [None] * (len(out["kind"]) - 1), pa.list_(pa.int64()))})

    return settled(counted.groupBy("shard").applyInArrow(run, "shard int, kind string, data binary, sums array<long>"))


def _words_packed(word: np.ndarray, sums: list[np.ndarray]) -> bytes:
    """Words and small numbers: a word is repeated where a number exceeds 255."""
    times = np.max([np.maximum(-(-s // 255), 1) for s in sums], axis=0)
    at = np.repeat(np.arange(len(word)), times)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    return np.array([len(at)], np.int32).tobytes() + _six(word[at]) + b"".join(np.clip(s[at] - nth * 255, 0, 255).astype(np.uint8).tobytes() for s in sums)


def _words_unpacked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data[:4], np.int32)[0])
    return [_eight(data[4 : 4 + 6 * n]), *np.frombuffer(data[4 + 6 * n :], np.uint8).reshape(-1, n).astype(np.int64)]


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and from 3 on, from the numbers of counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.0
    return [min(float(i), max(0.0, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]


def _word_shards(partial: DataFrame, folder: str, cut: list[float]) -> DataFrame:
    """Write the words of each shard; return (sums): words, and how many have 1, 2, 3 and 4 continuations."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        kinds = rows.column("kind").to_pylist()
        parts = [_words_unpacked(d) for d in rows.column("data").to_pylist()]
        wide = [(p[0], *p[1:], *[np.zeros(len(p[0]), np.int64)] * 2) if k == "context" else (p[0], *[np.zeros(len(p[0]), np.int64)] * 4, *p[1:]) for k, p in zip(kinds, parts, strict=True)]
        word, context, n1, n2, n3, count, follows = _summed(*(np.concatenate(x) for x in zip(*wide, strict=True)))
        left = ((cut[0] * n1 + cut[1] * n2 + cut[2] * n3) / np.maximum(context, 1)).astype(np.float32)
        _put(f"{folder}/words-{key[0].as_py()}", word=word, context=_narrow(context), left=left, count=_narrow(count), follows=_narrow(follows))
        n = np.bincount(np.minimum(follows, 5), minlength=6).tolist()
        return pa.table({"sums": pa.array([[int((count > 0).sum()), *n[1:5], int((follows > 2).sum())]], pa.list_(pa.int64()))})

    return partial.select("shard", "kind", "data").groupBy("shard").applyInArrow(run, "sums array<long>")


def held_out(column: str = "doc_id"):
    """Documents that the model doesn't learn from. Without an id a document is neither held out nor learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 10 == 0


class Model:
    """Where the arrays are, and the sums that the probabilities need."""

    def __init__(self, folder: str, shards: int, hot: np.ndarray, tokens: int, bigrams: int, words: int, cut: list[float], lowest: list[float], spare: float):
        self.folder, self.shards, self.hot, self.tokens, self.bigrams, self.words, self.cut, self.lowest, self.spare = folder, shards, hot, tokens, bigrams, words, cut, lowest, spare

    @lru_cache(4096)  # noqa: B019
    def arrays(self, kind: str, shard: int) -> dict[str, np.ndarray] | None:
        names = ("keys", "low", "big", "count") if kind == "bigrams" else ("word", "context", "left", "count", "follows")
        found = {n: mapped_array(f"{self.folder}/{kind}-{shard}/{n}.npy") for n in names}
        return found if found[names[0]] is not None else None

    def words_at(self, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """Counts of distinct sorted words."""
        out = {k: np.zeros(len(hashes)) for k in ("context", "left", "count", "follows")}
        shard = shard_of(hashes, self.shards)
        for s in np.unique(shard).tolist():
            a, b = np.searchsorted(shard, [s, s + 1])
            if held := self.arrays("words", s):
                at = np.minimum(np.searchsorted(held["word"], hashes[a:b]), len(held["word"]) - 1)
                ok = held["word"][at] == hashes[a:b]
                for k, x in out.items():
                    x[a:b] = np.where(ok, held[k][at], 0)
        return out

    def bigrams_at(self, before: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Counts of distinct bigrams in the order of their keys."""
        out = np.zeros(len(key))
        shard = bigram_shard(before, key, self.hot, self.shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1)).tolist()
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b and (held := self.arrays("bigrams", s)):
                take = order[a:b]
                at = np.minimum(np.searchsorted(held["keys"], key[take]), len(held["keys"]) - 1)
                n = np.where(held["keys"][at] == key[take], held["low"][at], 0).astype(np.float64)
                if (large := n == 255).any():
                    n[large] = held["count"][np.searchsorted(held["big"], key[take][large])]
                out[take] = n
        return out

    @staticmethod
    def _less(n: np.ndarray, cut: list[float]) -> np.ndarray:
        return np.maximum(n - np.array([0.0, *cut])[np.minimum(n, 3).astype(np.int64)], 0)

    def score(self, t: Texts) -> dict[str, np.ndarray]:
        """n_known, base_score and score of each text."""
        words, place = np.unique(np.concatenate([t.token, t.before]), return_inverse=True)
        of, n = self.words_at(words), len(t.token)
        token, before = place[:n], place[n:]
        key, first, back = np.unique(mix(t.before, t.token), return_index=True, return_inverse=True)
        pair = self.bigrams_at(t.before[first], key)[back]
        low = (self._less(of["follows"], self.lowest) / max(self.bigrams, 1) + self.spare / (self.words + 1))[token]
        context = of["context"][before]
        p = np.where(context > 0, self._less(pair, self.cut) / np.maximum(context, 1) + of["left"][before] * low, low)
        base = np.log10((of["count"] + ADDED) / (self.tokens + ADDED * (self.words + 1)))[token]
        add = lambda x: np.add.reduceat(x, t.starts)
        return {"n_known": add((of["count"] > 0)[token].astype(np.int64)), "base_score": add(base), "score": add(np.log10(p))}


def learn(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Count the texts that aren't held out and store the model in the shared folder. Null texts are empty."""
    texts = docs.filter(~held_out()).select("text")
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shards = max(1, round(size / 6 / shard_tokens))  # six bytes a token
    few = Counter(w for r in texts.limit(LAYOUT_DOCS).collect() for w in tokens_of((r[0] or "").encode())) if shards > 1 else Counter()
    cache = WordHashes()
    hot = np.array(sorted({START, *(max(cache[w] >> (64 - BITS), START + 1) for w, n in few.items() if 4 * n * shards > few.total())}), np.uint64)
    folder = shared_dir(docs.sparkSession)
    partial = _bigram_shards(_counted(texts, hot, shards), folder, shards)
    sums = partial.filter(F.col("sums").isNotNull()).agg(*(F.sum(F.col("sums")[i]) for i in range(6))).first()
    *times, tokens, bigrams = (x or 0 for x in sums)
    cut = discounts(times)
    found = settled(_word_shards(partial, folder, cut)).agg(*(F.sum(F.col("sums")[i]) for i in range(6))).first()
    words, n1, n2, n3, n4, more = (x or 0 for x in found)
    lowest = discounts([n1, n2, n3, n4])
    spare = (lowest[0] * n1 + lowest[1] * n2 + lowest[2] * more) / bigrams if bigrams else 1.0
    return Model(folder, shards, hot, tokens, bigrams, words, cut, lowest, spare)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts have one token, their end. Unseen words share what the lowest order leaves. Without
    training texts every token is as likely as any. Repeated rows are scored one by one; extra columns are ignored.
    """
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in parts:
            texts = texts_of(batch)
            for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
                t = Texts(texts[a:b], cache)
                of = model.score(t)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(t.sizes), pa.array(of["n_known"]), pa.array(np.full(b - a, model.tokens, np.int64)), pa.array(of["base_score"]), pa.array(of["score"])], names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), run, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity of the held-out and of the learned texts: held_out, n_tokens, perplexity."""
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs))
