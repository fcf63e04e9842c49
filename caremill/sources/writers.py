"""Writers of result tables: Parquet with zstd, one folder for each table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremill import schemas
from caremill.operators.vocabulary import build_concepts
from caremill.sources.readers import typed_vocabulary

#: Vocabulary tables that must be there.
REQUIRED_VOCABULARY = ("concept", "concept_relationship", "vocabulary")


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


def write_table(df: DataFrame, root: str, name: str, partitions: int | None = None) -> str:
    """Write a table; tables of persons are laid out in the order of person, date and primary key, so that readers skip row groups
    by person, and ids that record_ids() gave ascend in each file."""
    return write_counted(df, root, name, partitions)[0]


def write_counted(df: DataFrame, root: str, name: str, partitions: int | None = None) -> tuple[str, int]:
    """write_table(), and the rows written: they are counted by the tasks that write them."""
    path, seen = f"{root}/{name.lower()}", Observation()
    if "person_id" in df.columns:
        key = schemas.primary_key(schemas.TARGET[name]) if name in schemas.TARGET else None
        order = [F.col(c).asc_nulls_last() for c in ("person_id", schemas.MAIN_DATE.get(name), key) if c in df.columns]
        df = (df.repartitionByRange(partitions, "person_id") if partitions else df.repartitionByRange("person_id")).sortWithinPartitions(*order)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path, seen.get["rows"]


def write_excluded(excluded: dict[str, DataFrame], root: str) -> list[str]:
    """The left-out rows of each source table, also where there are none; older folders are replaced."""
    paths = []
    for name, df in excluded.items():
        paths.append(f"{root}/excluded/{name}")
        df.write.mode("overwrite").option("compression", "zstd").parquet(paths[-1])
    return paths


def write_coverage(coverage: DataFrame, root: str) -> str:
    """The coverage table, a few rows by nature, as one sorted CSV file."""
    path = f"{root}/coverage"
    coverage.coalesce(1).sortWithinPartitions(*(F.col(c).asc_nulls_last() for c in ("source_table", "code_system", "outcome"))).write.mode("overwrite").option("header", True).csv(path)
    return path


def export_vocabulary(files: dict[str, DataFrame], terminology: DataFrame, root: str) -> DataFrame:
    """Write the vocabulary tables that are there; return table, rows. A missing required one is an error."""
    if missing := [n for n in REQUIRED_VOCABULARY if n not in files]:
        raise ValueError(f"missing vocabulary tables: {', '.join(missing)}")
    spark, found = files["concept"].sparkSession, []
    for name in ("concept", *schemas.VOCABULARY):
        if name in files:
            table = build_concepts(files[name], terminology) if name == "concept" else typed_vocabulary(files[name], schemas.VOCABULARY[name])
            found.append((name, write_counted(table, root, name)[1]))
    return spark.createDataFrame(found, "table string, rows long")
