"""Uniqueness of keys that lie in order in their files.

Each task reads its keys in the order of the file and reports a row for each ascending run: first and last key, and the repeats
inside it. Runs that overlap no other need nothing more. Only keys between the ends of runs that do overlap are counted exactly,
by a shuffle; a filter on the key lets the scan skip all other row groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremill.scratch import settled

#: Runs that a task reports; with more of them its keys lie in no order and are one range that overlaps whatever is in it.
RUNS = 32
#: Ranges that are counted exactly; neighbouring ones are joined beyond it, which shuffles more keys and changes no count.
RANGES = 64


def _report(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    runs, nulls, mixed, file = [], 0, False, None  # a run: first key, last key, repeats
    for batch in batches:
        nulls += batch.column(0).null_count
        batch = batch.filter(pc.is_valid(batch.column(0)))
        keys, files = batch.columns
        if not len(keys):
            continue
        after, before = keys.slice(1), keys.slice(0, len(keys) - 1)
        ends = pc.or_(pc.less(after, before), pc.not_equal(files.slice(1), files.slice(0, len(keys) - 1)))
        cuts, goes_on, file = [0, *(i + 1 for i in pc.indices_nonzero(ends).to_pylist()), len(keys)], file == files[0].as_py(), files[-1].as_py()
        if mixed or len(runs) + len(cuts) - 1 > RUNS:
            ends = pc.min_max(keys).as_py()
            runs, mixed = [[min([ends["min"], *(r[0] for r in runs)]), max([ends["max"], *(r[1] for r in runs)]), 0]], True
            continue
        same = np.concatenate([[0], np.cumsum(pc.equal(after, before).to_numpy(zero_copy_only=False))])
        for a, b in zip(cuts, cuts[1:], strict=False):
            first, last, repeats = keys[a].as_py(), keys[b - 1].as_py(), int(same[b - 1] - same[a])
            if a == 0 and goes_on and runs and runs[-1][1] <= first:
                runs[-1] = [runs[-1][0], last, runs[-1][2] + repeats + (runs[-1][1] == first)]
            else:
                runs.append([first, last, repeats])
    rows = runs or [[None, None, 0]]
    lows, highs, repeats = zip(*rows, strict=True)
    yield pa.RecordBatch.from_arrays([pa.array(lows, kind), pa.array(highs, kind), pa.array(repeats, pa.int64()), pa.array([mixed] * len(rows)), pa.array([nulls] + [0] * (len(rows) - 1), pa.int64())], ["lo", "hi", "repeats", "mixed", "nulls"])


def key_runs(df: DataFrame, key: str) -> DataFrame:
    """(lo, hi, repeats, mixed, nulls): the ascending runs of a key, RUNS of each task at most; nulls stand in none of them.
    Keys are whole numbers, dates or strings."""
    kind = df.schema[key].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint", "date", "string"):
        raise ValueError(f"{key} is of type {kind}, which has no ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            yield from _report((b for part in ([first], batches) for b in part), first.schema.field(0).type)

    # one task may read several files, between whose keys those of others lie; equal hashes of their names would only make runs longer
    return df.select(key, F.xxhash64(F.input_file_name()).alias("_file")).mapInArrow(run, f"lo {kind}, hi {kind}, repeats long, mixed boolean, nulls long")


def shared_ranges(runs: DataFrame) -> list[tuple]:
    """(lo, hi) of keys that may stand in two runs, in order and apart from each other, RANGES at most. The windows are over a
    row for each run."""
    order = Window.orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.filter("lo is not null").select("lo", "hi", (F.col("mixed") | F.coalesce(F.col("lo") <= before, F.lit(False)) | F.coalesce(F.lead("lo").over(order) <= F.col("hi"), F.lit(False))).alias("_shared"))
    fresh = F.coalesce(F.col("lo") > before, F.lit(True)).cast("long")
    islands = marked.filter("_shared").withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = islands.withColumn("_part", F.floor((F.col("_island") - 1) * RANGES / F.greatest(F.max("_island").over(Window.partitionBy()), F.lit(RANGES))))
    return sorted(tuple(r) for r in joined.groupBy("_part").agg(F.min("lo"), F.max("hi")).drop("_part").collect())


def _inside(column: str, ranges: list[tuple]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(column).between(F.lit(lo), F.lit(hi)) for lo, hi in ranges), F.lit(False))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """One row, n: rows beyond the first of each key; null counts as a key.

    The table is read once for its runs, and what lies in shared ranges a second time. The order of the rows never changes the
    result, only how much is shuffled.
    """
    runs = settled(key_runs(df, key))
    ranges = shared_ranges(runs)
    zero, n = F.lit(0).cast("long"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    alone = runs.filter(F.col("lo").isNull() | ~_inside("lo", ranges)).select(F.col("repeats").alias("n"))  # a run is in a range or apart from all
    nulls = runs.agg(F.greatest(F.sum("nulls") - 1, zero).alias("n"))
    parts = [alone, nulls]
    if ranges:
        parts.append(df.filter(_inside(key, ranges)).groupBy(key).count().select((F.col("count") - 1).alias("n")))
    return reduce(DataFrame.unionByName, parts).agg(n)
