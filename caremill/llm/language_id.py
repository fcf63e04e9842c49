"""Language ID by a bidirectional gated recurrent network over bytes, trained in numpy.

Texts are cut into spans of SPAN bytes that are run side by side. In each direction the network begins CONTEXT bytes
before a span, so that every byte has been led up to from both sides. It labels every byte; a document's probabilities
are the means over all of its bytes. Training is backpropagation through time over pieces of PIECE bytes, with Adam.

Scale: prediction is one pass over the documents without a shuffle. Training takes PIECES pieces of at most DOCS
documents for each language, chosen by hash, whatever the size of the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import groups_of, map_arrow, table, texts_of

#: Bytes that are labelled in a row, bytes that lead up to them, bytes of a training piece; units in each direction.
SPAN, CONTEXT, PIECE, UNITS = 128, 16, 64, 12
#: Bounds of the training sample: documents for each language, pieces of each.
DOCS, PIECES = 600, 4
#: Training: rounds over the sample, pieces in a step, step size.
EPOCHS, STEP_PIECES, RATE = 12, 128, 0.02
#: Spans that are labelled together, bytes of text that are cut together.
TOGETHER, CHUNK_BYTES = 2048, 4 << 20
#: The label of texts without letters; the pipeline rejects it, and scores below REJECT.
UNKNOWN, REJECT = "und", 0.3


class Network:
    """Two gated recurrent layers, one for each direction, and a softmax on both. Arrays go by unit and piece."""

    def __init__(self, labels: list[str], seed: int = 5):
        u, n = np.random.default_rng(seed), len(labels)
        draw = lambda *shape: (u.standard_normal(shape) * 0.3).astype(np.float32)
        self.labels = labels
        self.p = {f"{k}{d}": v for d in "fb" for k, v in (("x", draw(256, 3 * UNITS)), ("u", draw(UNITS, 3 * UNITS)), ("c", np.zeros(UNITS, np.float32)), ("o", draw(UNITS, n)))} | {"bias": np.zeros(n, np.float32)}

    def _run(self, d: str, x: np.ndarray, there: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States after each byte of one direction, in the order of the bytes. ``x``, ``there``: bytes and which are texts', by
        place and piece; where none is, the state is that of the start."""
        half = np.repeat([0.5, 1.0], [2 * UNITS, UNITS]).astype(self.p["x" + d].dtype)  # a sigmoid is half a tangent
        wx, u, c = np.ascontiguousarray((self.p["x" + d] * half).T), np.ascontiguousarray((self.p["u" + d] * half).T), self.p["c" + d][:, None]
        n = x.shape[1]
        h, a, b = (np.zeros((k, n), wx.dtype) for k in (UNITS, 3 * UNITS, 3 * UNITS))
        states, trace, whole = np.empty((len(x), UNITS, n), wx.dtype), [], there.all(axis=1)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            np.take(wx, x[t], axis=1, out=a, mode="clip")
            np.dot(u, h, out=b)
            gates, new = b[: 2 * UNITS], b[2 * UNITS :]
            gates += a[: 2 * UNITS]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            new += c
            if keep:
                before, s = h.copy(), new.copy()
            new *= gates[UNITS:]
            new += a[2 * UNITS :]
            np.tanh(new, out=new)
            if keep:
                trace.append((t, before, gates[:UNITS].copy(), gates[UNITS:].copy(), s, new.copy()))
            h -= new
            h *= gates[:UNITS]
            h += new
            if not whole[t]:
                h *= there[t]
            states[t] = h
        return states, trace

    def _probabilities(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        """By place, label and piece."""
        x = np.matmul(self.p["of"].T, f)
        x += np.matmul(self.p["ob"].T, b)
        x += self.p["bias"][:, None]
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x /= x.sum(axis=1, keepdims=True)
        return x

    def label(self, windows: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Sums of the bytes' probabilities in the span of each window; see windows_of()."""
        x, there = np.ascontiguousarray(windows.T), np.ascontiguousarray(there.T)
        f = self._run("f", x[:-CONTEXT], there[:-CONTEXT], False)[0][CONTEXT:]
        b = self._run("b", x[CONTEXT:], there[CONTEXT:], False)[0][:-CONTEXT]
        probs = self._probabilities(f, b)
        probs *= there[CONTEXT:-CONTEXT, None, :]
        return probs.sum(axis=0).T

    def gradients(self, pieces: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of all bytes and its gradients, by backpropagation through time."""
        x = np.ascontiguousarray(pieces.T)
        there = np.arange(x.shape[0])[:, None] < sizes[None, :]
        runs = {d: self._run(d, x, there, True) for d in "fb"}
        probs = self._probabilities(runs["f"][0], runs["b"][0])
        total, every = max(float(there.sum()), 1.0), np.arange(x.shape[1])
        loss = -float((np.log(probs[:, wanted, every] + 1e-9) * there).sum()) / total
        out = probs * (there[:, None, :] / probs.dtype.type(total))
        out[:, wanted, every] -= there / total
        grads = {"bias": out.sum(axis=(0, 2))}
        flat = x.ravel()
        for d, (states, trace) in runs.items():
            u, back = self.p["u" + d], np.empty((len(x), 3 * UNITS, x.shape[1]), probs.dtype)
            grads["o" + d] = np.tensordot(states, out, axes=((0, 2), (0, 2)))
            from_out = np.matmul(self.p["o" + d], out)
            gu, gc, gh = np.zeros_like(u), np.zeros_like(self.p["c" + d]), np.zeros((UNITS, x.shape[1]), probs.dtype)
            for t, before, z, r, s, n in reversed(trace):
                g = (gh + from_out[t]) * there[t]
                gn = g * (1 - z) * (1 - n * n)
                gz, gr, gs = g * (before - n) * z * (1 - z), gn * s * r * (1 - r), gn * r
                back[t, :UNITS], back[t, UNITS : 2 * UNITS], back[t, 2 * UNITS :] = gz, gr, gn
                gb = np.concatenate([gz, gr, gs])
                gu += before @ gb.T
                gc += gs.sum(axis=1)
                gh = g * z + u @ gb
            gx = np.stack([np.bincount(flat, back[:, k].ravel(), 256) for k in range(3 * UNITS)], axis=1)
            grads |= {"x" + d: gx.astype(u.dtype), "u" + d: gu, "c" + d: gc}
        return loss, grads

    def train(self, pieces: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, epochs: int = EPOCHS, seed: int = 6) -> list[float]:
        """Adam over shuffled pieces; the losses of the rounds."""
        u, losses, step = np.random.default_rng(seed), [], 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            order, seen = u.permutation(len(pieces)), []
            for i in range(0, len(order), STEP_PIECES):
                take = order[i : i + STEP_PIECES]
                loss, grads = self.gradients(pieces[take], sizes[take], wanted[take])
                seen.append(loss)
                step += 1
                rate = RATE * (1 - epoch / epochs) ** 0.5
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        return losses


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces (padded with 0), the bytes in each, and the text of each."""
    counts = np.array([-(-len(t) // PIECE) for t in texts], np.int64)
    data = b"".join(t.ljust(int(c) * PIECE, b"\0") for t, c in zip(texts, counts, strict=True))
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.frombuffer(data, np.uint8).reshape(-1, PIECE), np.minimum(PIECE, np.array([len(t) for t in texts], np.int64)[owner] - nth * PIECE), owner


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of CONTEXT, SPAN and again CONTEXT bytes, which of their bytes are the text's, and the text of each. The spans
    in the middle cover each byte once."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // SPAN)
    width, ahead = SPAN + 2 * CONTEXT, b"\0" * CONTEXT
    data = b"".join(part for t, c in zip(texts, counts.tolist(), strict=True) for part in (ahead, t.ljust(c * SPAN, b"\0"), ahead))
    owner = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (np.cumsum(counts * SPAN + 2 * CONTEXT) - counts * SPAN - 2 * CONTEXT)[owner] + nth * SPAN
    place = np.arange(width)[None, :] - CONTEXT + (nth * SPAN)[:, None]  # of each byte in its text
    there = (place >= 0) & (place < sizes[owner][:, None])
    buffer = np.frombuffer(data, np.uint8)
    found = np.lib.stride_tricks.sliding_window_view(buffer, width)[starts] if len(owner) else np.zeros((0, width), np.uint8)
    return found, there, owner


def has_letter(text: bytes) -> bool:
    return bool(re.search(rb"[A-Za-z]", text)) or any(map(str.isalpha, text.decode("utf-8", "ignore")))


def held_out(column: str = "doc_id"):
    """Documents that take no part in training. Without an id a document is not held out, and not learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, most: int = DOCS, pieces: int = PIECES, epochs: int = EPOCHS) -> Network | None:
    """A network trained on a bounded sample of each language's labelled documents that aren't held out; None without any."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out()).select("lang", F.col("text").cast("binary").alias("b"), F.xxhash64("doc_id", "text").alias("h"))
    counts = known.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return None
    share = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for r in counts for x in (r[0], min(1.0, 1.5 * most / r[1])))), F.col("lang")), F.lit(0.0))
    place = lambda i: F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(F.octet_length("b") - PIECE + 1, F.lit(1))).cast("int") + 1
    chosen = known.filter(F.col("lang").isin([r[0] for r in counts])).filter(F.pmod(F.col("h"), F.lit(1 << 20)) < share * (1 << 20))
    rows = chosen.select("lang", "h", *(F.substring("b", place(i), F.lit(PIECE)).alias(f"p{i}") for i in range(pieces))).orderBy("h", "lang").limit(2 * most * len(counts)).collect()
    rows.sort(key=lambda r: (r[0], r[1], bytes(r[2])))
    labels = sorted({r[0] for r in rows})
    found = [(bytes(p), labels.index(r[0])) for r in rows for p in r[2:] if p]
    if not found:
        return None
    data, sizes, owner = cut([p for p, _ in found])
    net = Network(labels)
    net.train(data, sizes, np.array([y for _, y in found])[owner], epochs)
    return net


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Each text's mean of its bytes' probabilities."""
    out = np.zeros((len(texts), len(net.labels)))
    for a, b in groups_of([len(t) for t in texts], CHUNK_BYTES):
        windows, there, owner = windows_of(texts[a:b])
        for i in range(0, len(windows), TOGETHER):
            np.add.at(out, a + owner[i : i + TOGETHER], net.label(windows[i : i + TOGETHER], there[i : i + TOGETHER]))
    return out / np.maximum([[len(t)] for t in texts], 1) if texts else out


def verdicts(net: Network | None, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Label and score of each text; UNKNOWN with score 0 where it has no letter."""
    probs = probabilities(net, texts) if net else None
    labels, scores = [], []
    for i, text in enumerate(texts):
        known = net is not None and has_letter(text)
        labels.append(net.labels[int(probs[i].argmax())] if known else UNKNOWN)
        scores.append(min(1.0, float(probs[i].max())) if known else 0.0)
    return labels, scores


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Only the text is looked at. Null texts and texts without a letter are UNKNOWN with score 0, and so is
    everything if there was nothing to learn from. Repeated rows are labelled one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            labels, scores = verdicts(shared.value, texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, net: Network | None, least: float = REJECT) -> DataFrame:
    """The documents whose language is known with at least that score, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            labels, scores = verdicts(shared.value, texts_of(batch))
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(labels, scores, strict=True)], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
