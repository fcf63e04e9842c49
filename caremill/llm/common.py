"""What the operators share: reading tables, the shared folder, words."""

from __future__ import annotations

import gc
import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python task gets at once, so that long texts fit in memory.
ROWS_PER_BATCH = 1024
#: Largest table, in bytes, that is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20

#: Bytes of ASCII that are no word characters become a space, A-Z become a-z; the rest stays.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The folder that stands in for the shared one in local sessions without a setting.
LOCAL_DIRS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder's path below the one that the cluster names in spark.checkpoint.dir. Only a local session may leave it
    unset; elsewhere that is an error, since executors would write to their own disks."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if not LOCAL_DIRS:
            LOCAL_DIRS.append(f"file://{tempfile.mkdtemp(prefix='spark-checkpoint-')}")
        top = LOCAL_DIRS[0]
    return f"{top.rstrip('/')}/caremill-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read again: cuts the lineage and outlives executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete what settled() wrote, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of stages that nothing needs any more: it does so when the driver forgets them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def packed(rows: DataFrame) -> DataFrame:
    """Rows with their text compressed, for a shuffle; null is empty. See unpacked()."""
    keep = [c for c in rows.columns if c != "text"]
    schema = rows.select(*keep).schema.add("packed", "binary")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in parts:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(map(pack, texts_of(batch)), pa.binary())], [*keep, "packed"])

    return map_arrow(rows, run, schema)


def unpacked(batch: pa.RecordBatch, column: str = "packed") -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in batch.column(column).to_pylist()]


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.translate(WORD_BYTES).split()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def to_batch(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow with batches of bounded size. ``fn``: iterator of batches to iterator of batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Each row with a number of its own: repeated rows stay apart. Settle it before two plans use the numbers."""
    return df.withColumn(name, F.monotonically_increasing_id())


def size_bytes(df: DataFrame) -> int:
    """Bytes of a settled table's files."""
    jvm, conf, total = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration(), 0
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def if_small(df: DataFrame) -> DataFrame:
    """A settled table, marked for broadcast only when its files are small enough."""
    return F.broadcast(df) if size_bytes(df) * 4 <= BROADCAST_BYTES else df


#: Keys that are so frequent that one task would get much of a table, at most; rows that a key has at least to be one of them.
HOT_KEYS, HOT_ROWS = 2048, 1000


def repeated(rows: DataFrame, keys: list[str], among: DataFrame | None = None) -> DataFrame:
    """Those settled rows whose keys occur more than once (``among`` other settled rows, where given). Keys aren't null.

    Counts are combined in the tasks. Keys with more than total / HOT_KEYS rows, never more than HOT_KEYS of them, meet their
    rows by a broadcast; only rows of the others are shuffled.
    """
    among = rows if among is None else among
    counts = settled(among.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1"))
    least = max(HOT_ROWS, among.count() // HOT_KEYS + 1)
    hot, rest = F.broadcast(counts.filter(F.col("n") >= least).select(*keys)), counts.filter(F.col("n") < least).select(*keys)
    if hot.isEmpty():
        return rows.join(rest, keys, "left_semi")
    return rows.join(hot, keys, "left_semi").unionByName(rows.join(hot, keys, "left_anti").join(rest, keys, "left_semi"))


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Inner join of settled rows with a settled table that has each key once, and in ``n`` the rows that have it. Frequent keys
    meet their rows by a broadcast, see repeated()."""
    least = max(HOT_ROWS, rows.count() // HOT_KEYS + 1)
    hot, rest = F.broadcast(table.filter(F.col(n) >= least)), table.filter(F.col(n) < least)
    if hot.isEmpty():
        return rows.join(table, keys)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))


def batches(parts: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Join Arrow batches up to a size."""
    held, size = [], 0
    for b in parts:
        held.append(b)
        size += b.nbytes
        if size >= most_bytes:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def mounted(path: str) -> str | None:
    """The local path of a shared folder's file; None where the folder is in a store that isn't mounted."""
    scheme, found, rest = path.partition(":")
    return "/" + (rest if found else path).lstrip("/") if not found or scheme == "file" else None


def put_file(path: str, data: bytes) -> None:
    """Write a file below the shared folder, whole or not at all; repeated tries write the same."""
    if name := mounted(path):
        os.makedirs(os.path.dirname(name), exist_ok=True)
        part = f"{name}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, name)
        return
    store, name = pafs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, name)


def fetched(path: str) -> str | None:
    """A local path of a shared file, None if there is none. A file of a store that isn't mounted is fetched once for each
    executor, into the folder that Spark gives it."""
    if name := mounted(path):
        return name if os.path.exists(name) else None
    mine = f"{SparkFiles.getRootDirectory()}/fetched-{hashlib.sha256(path.encode()).hexdigest()}"
    if not os.path.exists(mine):
        store, name = pafs.FileSystem.from_uri(path)
        if store.get_file_info(name).type == pafs.FileType.NotFound:
            return None
        part = f"{mine}.{uuid.uuid4().hex}"
        with store.open_input_stream(name) as f, open(part, "wb") as out:
            shutil.copyfileobj(f, out, 1 << 20)
        os.replace(part, mine)
    return mine


def mapped_array(path: str) -> np.ndarray | None:
    """An array of the shared folder, memory-mapped."""
    name = fetched(path)
    return np.load(name, mmap_mode="r").view(np.ndarray) if name else None


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with a _row that tells them apart in every plan: doc_id where it is an integer, never null and
    never repeated (checked over all rows), else a number that is written down with the row."""
    if docs.schema["doc_id"].dataType.simpleString() in ("bigint", "int"):
        per_id = docs.groupBy("doc_id").count().filter("doc_id is null or count > 1")
        if per_id.isEmpty():
            return docs.withColumn("_row", F.col("doc_id").cast("long"))
    return settled(numbered(docs))


class WordHashes(dict):
    """64-bit hash of each word met; forgets when it holds too many."""

    MOST = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of pairs of hashes, in order."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items with at most that size together, or of one item."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
