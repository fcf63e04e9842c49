"""Exact dedup by deterministic block naming, with DataFrame operations alone.

Each text is cut into blocks of BLOCK_BYTES bytes. The distinct blocks are sorted and numbered: equal blocks
share an integer, different ones never do. Then adjacent integers are paired, the distinct pairs are sorted and
numbered, and so on until each document has one integer. With the number of rounds it took, that is the
identity of the whole text.

Scale: texts are shuffled once (the distinct blocks, combined on the map side); all else moves integers. Blocks
are matched to their integers by a 128-bit hash that is proven free of collisions on the blocks at hand, and
replaced by the hash of another seed if it isn't. Blocks, pairs and groups that very many rows share, of a bounded number,
are looked up by a broadcast, so that no task gets all rows of one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import if_small, looked_up, numbered, settled, table

#: Bytes of a block.
BLOCK_BYTES = 2048
#: Blocks that are cut together from a very long text.
BLOCKS_PER_CHUNK = 64


def _pieces(binary: str, step: int):
    """Column: the binary column in pieces of ``step`` bytes; one empty piece if it is empty."""
    last = F.greatest(F.ceil(F.octet_length(binary) / step) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col(binary), i * step + 1, F.lit(step)))


def _blocks(rows: DataFrame, keep: list[str], size: int) -> DataFrame:
    """A row for each block: the kept columns, pos, block."""
    chunks = rows.select(*keep, F.posexplode(_pieces("_bytes", size * BLOCKS_PER_CHUNK)).alias("_chunk", "_part"))
    cut = chunks.select(*keep, "_chunk", F.posexplode(_pieces("_part", size)).alias("_at", "block"))
    return cut.select(*keep, (F.col("_chunk") * BLOCKS_PER_CHUNK + F.col("_at")).cast("long").alias("pos"), "block")


def _hashes(seed: int) -> list:
    return [F.xxhash64(F.lit(seed + i), F.col("block")).alias(h) for i, h in enumerate(("h1", "h2"))]


def _sorted_names(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Integer names in sorted order within each partition; no two rows share one."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _level_zero(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Settled frames: (row, pos, blocks, doc_id, sha, hashes) and (hashes, name)."""
    seed = 0
    while True:
        firsts = {c: F.when(F.col("pos") == 0, F.col(c)).alias(c) for c in ("doc_id", "_sha")}
        placed = settled(_blocks(rows, ["_row", "doc_id", "_sha", "_n"], size).select("_row", "pos", "_n", *firsts.values(), *_hashes(seed)))
        least = _blocks(rows, [], size).select(*_hashes(seed), "block").groupBy("h1", "h2").agg(F.min("block").alias("block"), F.max("block").alias("_other"), F.count("*").alias("n"))
        names = settled(_sorted_names(least, ["block"]).select("h1", "h2", "name", "n", (F.col("block") != F.col("_other")).alias("_clash")))
        if names.filter("_clash").isEmpty():
            return placed, names.select("h1", "h2", "name", "n")
        seed += 2


def name_texts(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """Return _row, doc_id, text_sha256, level, name: (level, name) is the same for equal texts only.

    Null texts count as empty. Repeated rows stay apart. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = numbered(docs.select("doc_id", text.alias("text"))).select("_row", "doc_id", F.col("text").cast("binary").alias("_bytes"), F.unhex(F.sha2("text", 256)).alias("_sha"))
    rows = rows.withColumn("_n", F.greatest(F.ceil(F.octet_length("_bytes") / size), F.lit(1)).cast("long"))
    placed, names = _level_zero(rows, size)
    heads = placed.filter("pos = 0").select("_row", "doc_id", F.lower(F.hex("_sha")).alias("text_sha256"))
    rounds = max(0, (placed.agg(F.max("_n")).first()[0] or 1) - 1).bit_length()
    now = settled(looked_up(placed, names, ["h1", "h2"]).select("_row", "pos", "_n", "name"))
    done = [now.filter("_n = 1").select("_row", F.lit(0).alias("level"), "name")]
    for level in range(1, rounds + 1):
        side = [F.max(F.when(F.col("pos") % 2 == i, F.col("name"))).alias(c) for i, c in enumerate("ab")]
        pairs = now.filter("_n > 1").groupBy("_row", F.expr("pos div 2").alias("pos"), F.expr("(_n + 1) div 2").alias("_n")).agg(*side)
        pairs = settled(pairs.withColumn("b", F.coalesce("b", F.lit(-1).cast("long"))))
        names = settled(_sorted_names(pairs.groupBy("a", "b").agg(F.count("*").alias("n")), ["a", "b"]))
        now = settled(looked_up(pairs, names, ["a", "b"]).select("_row", "pos", "_n", "name"))
        done.append(now.filter("_n = 1").select("_row", F.lit(level).alias("level"), "name"))
    return reduce(DataFrame.union, done).join(heads, "_row")


def exact_dedup(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (null is empty) the row with the largest doc_id stays. Ties, that is repeated rows or rows
    without doc_id: exactly one of them stays; a null doc_id is smaller than any other. An empty table gives no
    rows. Extra columns are ignored.
    """
    rows = settled(name_texts(docs, size))
    groups = settled(rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", "_row")).alias("_best"), F.count("*").alias("group_size")))
    joined = looked_up(rows, groups, ["level", "name"], "group_size")
    return joined.select("doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_best._row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; of rows with equal doc_id and text one, the smallest."""
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    verdict = settled(exact_dedup(docs, size))
    per_key = verdict.groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("_stays"), F.count("*").alias("_rows"))
    odd = settled(per_key.filter("not _stays or _rows > 1").withColumnsRenamed({"doc_id": "_id", "text_sha256": "_sha"}))
    same = docs["doc_id"].eqNullSafe(odd["_id"]) & (sha == odd["_sha"])
    once = docs.join(if_small(odd), same, "left_anti")
    repeated = docs.join(if_small(odd.filter("_stays")), same, "left_semi")
    first = repeated.groupBy("doc_id", "text").agg(F.min(F.struct(*docs.columns)).alias("_first")).select("_first.*")
    return once.unionByName(first)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
