"""BPE encoding and decoding with the vocabulary file of a public tokenizer.

Frequent words are compiled into a minimal acyclic transducer: a shared-suffix automaton whose arcs carry numbers
that add up to a word's place in a table of ids. It is stored as flat arrays in the shared folder and
memory-mapped by the workers. Words that it lacks are merged exactly, pair by pair.

Scale: words are counted over all documents (combined in the tasks, then by a shuffle on the word). A histogram of
the counts, of at most 1024 bars, says from which count on at most WORDS words are left; these go to one task,
which compiles them. The driver gets the histogram. Encoding reads documents once and shuffles nothing.
"""

from __future__ import annotations

import heapq
import io
import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import dropped, groups_of, map_arrow, mapped_array, put_file, settled, sha256, shared_dir, table

#: Most words in the lexicon: the most frequent ones. Bars of the histogram of counts for each doubling of the count.
WORDS, BARS = 250_000, 16
#: Longest word, in bytes, that the lexicon takes.
WORD_BYTES = 64
#: Stretches without white space that a worker remembers between batches.
REMEMBERED = 300_000
#: Characters of text whose words are looked up together.
CHUNK_CHARS = 4 << 20
#: Distinct stretches that are counted together before their words are handed on.
COUNTED = 300_000

#: Fixed value: the word pattern of the vocabulary file, with white space as Unicode defines it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merges:
    """Vocabulary and merge ranks of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + WORD_END] for c in letters]
        pairs = [self._pair(x) for x in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]

    @staticmethod
    def _pair(merge) -> tuple[str, str]:
        return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank, leftmost first, is merged until none is left."""
        ids = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        return self._short(ids) if len(ids) <= 48 else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        rank, none = self.ranks.get, len(self.made)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at : at + 2] = [self.made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs and a linked list of places."""
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (found := self.ranks.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (found, i, ids[i], ids[j], self.made[found]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = new, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [x for x, keep in zip(ids, alive, strict=True) if keep]


class Words:
    """Cuts a text into special tokens and stretches without white space, and those into words: no word holds white space."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.find = regex.compile(PATTERN).findall
        self.space = regex.compile(r"\p{White_Space}+")
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None

    def plain(self, text: str) -> list[str]:
        """Stretches. str.split() also cuts at U+001C to U+001F, which are no white space here."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [x for x in self.space.split(text) if x]
        return text.split()

    def words(self, stretch: str) -> list[str]:
        """Words of a stretch; one of ASCII letters is a word."""
        return [stretch] if stretch.isascii() and stretch.isalpha() else self.find(stretch)

    def parts(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """(special id, no stretches) or (None, stretches), in order."""
        if self.cut and any(s in text for s in self.special):
            for part in self.cut.split(text):
                yield (self.special[part], []) if part in self.special else (None, self.plain(part))
        else:
            yield None, self.plain(text)


class Lexicon:
    """Minimal acyclic transducer: states and arcs in flat arrays, ids of the i-th word in a table."""

    ARRAYS = ("keys", "target", "add", "final", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name in self.ARRAYS:
            setattr(self, name, arrays[name])

    @classmethod
    def compiled(cls, words: list[bytes], ids: list[list[int]]) -> Lexicon:
        """``words``: sorted, distinct, not empty. States with equal futures are shared as soon as a word leaves them."""
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []

        def settle(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        path: list[list] = [[False, []]]  # open states of the last word: final, arcs
        letters: list[int] = []
        for word in words:
            same = 0
            while same < min(len(letters), len(word)) and letters[same] == word[same]:
                same += 1
            while len(letters) > same:
                node = path.pop()
                path[-1][1].append((letters.pop(), settle(node)))
            for letter in word[same:]:
                letters.append(letter)
                path.append([False, []])
            path[-1][0] = True
        while letters:
            node = path.pop()
            path[-1][1].append((letters.pop(), settle(node)))
        root = settle(path[0])
        below = [0] * len(states)
        for i, (final, arcs) in enumerate(states):  # targets come before their sources
            below[i] = final + sum(below[t] for _, t in arcs)
        keys, target, add = [], [], []
        for i, (final, arcs) in enumerate(states):
            passed = int(final)
            for letter, t in arcs:
                keys.append((i << 8) | letter)
                target.append(t)
                add.append(passed)
                passed += below[t]
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        flat = [x for one in ids for x in one]
        return cls({"keys": np.array(keys, np.int64)[order], "target": np.array(target, np.int32)[order], "add": np.array(add, np.int32)[order], "final": np.array([*(f for f, _ in states), root], np.int32), "offsets": np.cumsum([0, *map(len, ids)]).astype(np.int64), "ids": np.array(flat, np.int32)})

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word in the table, -1 for those that the lexicon lacks. All words walk abreast."""
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        data, starts = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum(sizes)])[:-1]
        state, place = np.full(n, self.final[-1], np.int64), np.zeros(n, np.int64)
        alive = np.flatnonzero(sizes <= WORD_BYTES)
        place[sizes > WORD_BYTES] = -1
        for step in range(WORD_BYTES):
            alive = alive[sizes[alive] > step]
            if not len(alive) or not len(self.keys):
                break
            wanted = (state[alive] << 8) | data[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            ok = self.keys[at] == wanted
            place[alive[~ok]] = -1
            alive, at = alive[ok], at[ok]
            state[alive] = self.target[at]
            place[alive] += self.add[at]
        done = (place >= 0) & (self.final[state] == 1) & (sizes > 0) & bool(len(self.keys))
        return np.where(done, place, -1)

    def save(self, folder: str) -> None:
        for name in self.ARRAYS:
            out = io.BytesIO()
            np.save(out, getattr(self, name))
            put_file(f"{folder}/{name}.npy", out.getvalue())

    @classmethod
    def mapped(cls, folder: str) -> Lexicon:
        return cls({name: mapped_array(f"{folder}/{name}.npy") for name in cls.ARRAYS})


class Codec:
    """Encodes and decodes texts in a worker.

    What it remembers of a stretch is made once for each distinct one: its ids, or with ``digests`` their number, the ids in
    decimal and their decoding, which joined by spaces are those of a text.
    """

    def __init__(self, path: str, folder: str, digests: bool = False):
        self.merges, self.lexicon = Merges(path), Lexicon.mapped(folder)
        self.words = Words(self.merges.special)
        self.seen: dict[str, list[int] | tuple[int, bytes, bytes]] = {}
        self.kept, self.joined = (self.written, joined) if digests else (list, lambda parts: list(chain.from_iterable(parts)))
        self.digits = {i: b"%d" % i for i in self.merges.tokens}
        self.bytes = {i: t.encode() for i, t in self.merges.tokens.items()}

    def written(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        return len(ids), b" ".join([self.digits[i] for i in ids]), b" ".join([self.bytes[i] for i in ids])

    def learn(self, stretches: set[str]) -> None:
        """Ids of stretches: of their words from the transducer, else by merging."""
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        new = list(stretches.difference(self.seen))  # all of them, if it has just been emptied
        cut = list(map(self.words.words, new))
        words = list(set().union(*cut))
        raw = [w.encode() for w in words]
        places = self.lexicon.places(raw) if words else np.zeros(0, np.int64)
        first, end = self.lexicon.offsets[places].tolist(), self.lexicon.offsets[places + (places >= 0)].tolist()
        ids, kept, merge, found = self.lexicon.ids, self.kept, self.merges.merge, {}
        for word, data, i, a, b in zip(words, raw, places.tolist(), first, end, strict=True):
            found[word] = kept(ids[a:b].tolist() if i >= 0 else merge(data))
        for x, one in zip(new, cut, strict=True):
            self.seen[x] = found[one[0]] if len(one) == 1 else self.joined([found[w] for w in one])

    def pieces(self, texts: list[str | None]) -> Iterator[list]:
        """What is kept of the special tokens and stretches of each text that have ids, in order; the words of all texts are looked
        up together."""
        special = {i: self.kept([i]) for i in self.words.special.values()}
        for a, b in groups_of([len(t or "") for t in texts], CHUNK_CHARS):
            cut = [list(self.words.parts(t or "")) for t in texts[a:b]]
            self.learn(set().union(*[stretches for parts in cut for _, stretches in parts]))
            of = self.seen.__getitem__
            for parts in cut:
                out: list = []
                for token, stretches in parts:
                    if token is not None:
                        out.append(special[token])
                    out += map(of, stretches)
                yield out

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text, by a codec that keeps ids."""
        for out in self.pieces(texts):
            yield list(chain.from_iterable(out))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens are joined by spaces; ids that it lacks say nothing."""
        tokens = self.merges.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])


def count_words(docs: DataFrame, special: dict[str, int]) -> DataFrame:
    """(word, n) over all documents."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, held = Words(special), Counter()

        def pack() -> pa.RecordBatch:
            words: dict[str, int] = {}
            for x, n in held.items():
                for w in cut.words(x):
                    words[w] = words.get(w, 0) + n
            return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])

        for batch in parts:
            for text in batch.column("text").to_pylist():
                for _, stretches in cut.parts(text or ""):
                    held.update(stretches)
                if len(held) >= COUNTED:
                    yield pack()
                    held.clear()
        if held:
            yield pack()

    return map_arrow(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words that are as frequent as a bar of the histogram of counts says: as many bars, from the top, as hold at most ``most`` words."""
    bars = counts.withColumn("_bar", F.floor(F.log2("n") * BARS).cast("int"))
    least, total = 64 * BARS, 0
    for bar, words in sorted(bars.groupBy("_bar").count().collect(), reverse=True):
        total += words
        if total > most:
            break
        least = bar
    return bars.filter(F.col("_bar") >= least).select("word")


def build_lexicon(docs: DataFrame, path: str, most: int = WORDS) -> str:
    """Compile the most frequent words, at most that many; return the folder of the transducer.

    Counts of one bar stand or fall together. Without words the transducer is empty.
    """
    counts = settled(count_words(docs, Merges(path).special).filter(F.octet_length("word") <= WORD_BYTES))
    folder = shared_dir(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, words = Merges(path), [w.encode() for batch in parts for w in batch.column("word").to_pylist()]
        lexicon = Lexicon.compiled(words, [merges.merge(w) for w in words])
        lexicon.save(folder)
        yield pa.RecordBatch.from_arrays([pa.array([len(words)], pa.int64())], ["words"])

    one = frequent(counts, most).repartition(1).sortWithinPartitions("word")
    if not map_arrow(one, run, "words long").collect():  # no task had a row
        Lexicon.compiled([], []).save(folder)
    dropped(counts)
    return folder


def id_type(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """doc_id, ids. Null and empty texts have no ids; strings of special tokens in a text are these tokens."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, folder)
        for batch in parts:
            ids = list(codec.encode_all(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type(docs)}, ids array<int>")


def decode(rows: DataFrame, path: str, folder: str) -> DataFrame:
    """doc_id, text of rows with ids; null ids give an empty text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, folder)
        for batch in parts:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([codec.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return map_arrow(rows.select("doc_id", "ids"), run, f"doc_id {id_type(rows)}, text string")


def joined(parts: list[tuple[int, bytes, bytes]]) -> tuple[int, bytes, bytes]:
    """Of stretches or a text: number of ids, ids, decoding. Parts without ids say nothing."""
    counts, ids, texts = zip(*filter(itemgetter(0), parts), strict=True) if parts else ((), (), ())
    return sum(counts), b" ".join(ids), b" ".join(texts)


def coded(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of their decoding, made in one pass.

    Repeated rows are coded one by one, extra columns are ignored, an empty table gives no rows.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, folder, digests=True)
        for batch in parts:
            n, of_ids, of_text = [], [], []
            for pieces in codec.pieces(batch.column("text").to_pylist()):
                count, ids, decoded = joined(pieces)
                n.append(count)
                of_ids.append(sha256(ids))
                of_text.append(sha256(decoded))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), tokenizer_path()
    return coded(docs, path, build_lexicon(docs, path))
