"""Results by person, kept up to date: only persons whose source rows changed are made again.

Every person's source rows are summed up in a digest. A run compares the digests with those of the run before, makes the rows
of persons that are new or changed, and replaces the folders of their buckets; all other folders keep their files. The digests are
written last, and persons under way are noted before anything is replaced, so that a run that broke off is made good by the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.operators.cleaning import clean_tables
from caremill.scratch import bucketed, by_one_key, settled

BUCKET, BUCKETS = "_bucket", 256


def _row_hash(name: str, columns: list[str], salt: str) -> Column:
    """64 bits of a row: its table, the names of its columns, which of them are null, and their values."""
    return F.xxhash64(F.lit(f"{salt}:{name}:{','.join(columns)}"), *(x for c in columns for x in (F.col(c).isNull(), F.col(c)))).cast("decimal(20,0)")


def digests(tables: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """One row per person: the number of its rows in all tables and two sums of 64-bit hashes of them. The order of rows and columns
    makes no difference; repeated rows do. Rows are summed in the tasks before persons meet."""
    parts = []
    for name, df in tables.items():
        columns = sorted(df.columns)
        sums = (F.sum(_row_hash(name, columns, salt)).alias(salt) for salt in ("a", "b"))
        parts.append(df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *sums))
    whole = reduce(DataFrame.unionByName, parts).groupBy(*key)
    return whole.agg(*(F.sum(c).cast("decimal(38,0)").alias(c) for c in ("n", "a", "b")))


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (left[c].eqNullSafe(right[c]) for c in columns))


def _only(df: DataFrame, persons: DataFrame, key: list[str], how: str) -> DataFrame:
    named = persons.select(*(F.col(c).alias(f"_key_{c}") for c in key))
    return df.join(named, reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key)), how)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _replace(rows: DataFrame, path: str, touched: list[int] | None) -> None:
    """Write the folders of the touched buckets, all of them where None. Rows that stem from the folders that go are written down
    already."""
    spark = rows.sparkSession
    out = rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite")
    if touched is None:
        out.option("partitionOverwriteMode", "static").parquet(path)
        return
    out.option("partitionOverwriteMode", "dynamic").parquet(path)
    left = {r[0] for r in rows.select(BUCKET).distinct().collect()}  # BUCKETS rows at most, as are the touched ones
    for bucket in touched:
        if bucket not in left:
            _delete(spark, f"{path}/{BUCKET}={bucket}")


def refresh(tables: dict[str, DataFrame], root: str, build: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], key: list[str], buckets: int = BUCKETS) -> tuple[int, int]:
    """Bring ``<root>/<table>`` of what ``build`` makes of the tables up to date; return the persons made anew (or taken out) and the
    buckets replaced.

    ``build`` makes tables that keep the key columns, and each person's rows from that person's rows alone. Null keys are one person. Without
    digests of an earlier run, or with another number of buckets, everything is made. Result tables carry BUCKET.
    """
    spark = next(iter(tables.values())).sparkSession
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    state, pending = f"{root}/digests-{buckets}", f"{root}/pending-{buckets}"
    new = settled(digests(tables, key).withColumn(BUCKET, bucket))
    first = not _exists(spark, state)
    if first:
        changed, touched = new.select(*key, BUCKET), None
        files, folder = _folder(spark, root)
        for other in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "{digests,pending}-*")) or []:  # what they tell of is replaced
            files.delete(other.getPath(), True)
    else:
        old = spark.read.schema(new.schema).parquet(state)
        both = new.alias("new").join(old.alias("old"), _same(new, old, key), "full_outer")
        other = reduce(lambda x, y: x | y, (~F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in ("n", "a", "b")))
        differ = both.filter(other).select(*(F.when(F.col("new.n").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in key)).withColumn(BUCKET, bucket)
        if _exists(spark, pending):  # a run that broke off
            differ = differ.unionByName(spark.read.schema(differ.schema).parquet(pending)).distinct()
        changed = settled(differ)
        touched = sorted(r[0] for r in changed.select(BUCKET).distinct().collect())
        if not touched:
            return 0, 0
        changed.write.mode("append").parquet(pending)
    made = build(tables if first else {n: _only(t, changed, key, "left_semi") for n, t in tables.items()})
    for name, df in made.items():
        rows, path = df.withColumn(BUCKET, bucket), f"{root}/{name}"
        if not first and _exists(spark, path):
            here = spark.read.schema(rows.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
            rows = rows.unionByName(_only(here, changed, key, "left_anti"))
        _replace(rows if first else settled(rows), path, touched)
    now = new if first else new.filter(F.col(BUCKET).isin(touched))
    _replace(now, state, touched)  # ``new`` is written down
    _delete(spark, pending)
    return changed.count(), buckets if first else len(touched)


def refresh_clean(tables: dict[str, DataFrame], root: str, buckets: int = BUCKETS) -> tuple[int, int]:
    """clean_tables() of numbered source tables, kept up to date under ``root``. ``person_id`` must stay a person's own from run to run."""

    def build(part: dict[str, DataFrame]) -> dict[str, DataFrame]:
        laid = {n: bucketed(t, "person_id") for n, t in part.items()}
        with by_one_key(next(iter(laid.values())).sparkSession):
            return {n: settled(t) for n, t in clean_tables(laid).items()}

    return refresh(tables, root, build, ["person_id"], buckets)
