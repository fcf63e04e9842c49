"""Deterministic numbering without a sort of all rows in one task.

Rows are dealt out by ranges of their order, whose bounds Spark samples, and written down with the number of their range. A
row's number is the count of rows in the ranges before its own plus its place in its range. Only the ranges' counts
meet in one place: one row for each range. Ranges are about equal, whatever the keys look like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremill import schemas
from caremill.functions.values import parse_yyyymm
from caremill.operators.cleaning import TABLE_DATES, drop_missing_birth_year, optional_column
from caremill.scratch import settled


def number_rows(df: DataFrame, name: str, order: list[Column], ranges: list[Column] | None = None) -> DataFrame:
    """Number rows 1.. in ``order``. The ranges are written down once, since their bounds are sampled anew in each run.

    ``ranges``: what rows are dealt out by, where it is not the order itself; it must never fall along the order, and rows that
    are equal in it share a task.
    """
    dealt = settled(df.repartitionByRange(*(ranges or order)).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_range", before.alias("_offset"))
    placed = dealt.join(F.broadcast(offsets), "_range")  # a row for each range
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.withColumn(name, (nth + F.col("_offset")).cast("long")).drop("_range", "_offset")


def _ascending(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def person_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(_source_id, patient_id, person_rows, alive): rows in the dated tables of patients with a birth year, before any
    cleaning, and whether one of them passes the death rule. Each table is reduced to a row per person first."""
    key = ["_source_id", "patient_id"]
    patients = drop_missing_birth_year(tables["patient"])
    keys = patients.select(*key).dropna().distinct()
    deaths = patients.select(*key, parse_yyyymm(optional_column(patients, "month_year_death")).alias("_died")).filter("_died is not null").distinct()
    parts = None
    for name, date in TABLE_DATES.items():
        if name in tables:
            joined = tables[name].select(*key, F.col(date).alias("_date")).join(keys, key, "left_semi").join(deaths, key, "left")
            ok = F.coalesce(F.col("_died").isNull() | (F.col("_date") < F.col("_died")), F.lit(False))
            part = joined.groupBy(*key).agg(F.count("*").alias("person_rows"), F.bool_or(ok).alias("alive"))
            parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return keys.select(*key, F.lit(0).cast("long").alias("person_rows"), F.lit(False).alias("alive")).limit(0)
    return parts.groupBy(*key).agg(F.sum("person_rows").alias("person_rows"), F.bool_or("alive").alias("alive"))


def person_index(tables: dict[str, DataFrame]) -> DataFrame:
    """Survivors numbered 1..N by (_source_id, patient_id), with their source rows."""
    alive = person_rows(tables).filter("alive").drop("alive")
    numbered = number_rows(alive, "person_id", _ascending(["_source_id", "patient_id"]))
    return numbered.select("_source_id", "patient_id", "person_id", "person_rows")


def attach_person_id(df: DataFrame, persons: DataFrame) -> DataFrame:
    """Rows of numbered persons."""
    return df.join(persons.select("_source_id", "patient_id", "person_id"), ["_source_id", "patient_id"])


def visit_map(encounters: DataFrame) -> DataFrame:
    """Distinct (person_id, encounter_id) numbered 1..N in that order."""
    pairs = encounters.select("person_id", F.col("encounter_id").cast("string").alias("encounter_id")).dropna().distinct()
    return number_rows(pairs, "visit_occurrence_id", _ascending(["person_id", "encounter_id"])).select("person_id", "encounter_id", "visit_occurrence_id")


def add_visit_ids(df: DataFrame, visits: DataFrame) -> DataFrame:
    """visit_occurrence_id by person and encounter; null without an encounter id or column."""
    if "encounter_id" not in df.columns:
        return df.withColumn("visit_occurrence_id", F.lit(None).cast("long"))
    return df.withColumn("encounter_id", F.col("encounter_id").cast("string")).join(visits, ["person_id", "encounter_id"], "left")


def record_ids(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Number rows 1..N in the order of the columns, nulls last; the first of them is person_id."""
    columns = [c for c in df.columns if c != name]
    return number_rows(df.drop(name), name, _ascending(order)).select(name, *columns)


def order_columns(table: str) -> list[str]:
    """The columns by which a table is sorted: person, date, main concept for event tables, primary key for others, then the rest."""
    schema = (schemas.TARGET | schemas.ERA)[table]
    pk = schemas.primary_key(schema)
    if table in schemas.MAIN_CONCEPT:
        first = ["person_id", schemas.MAIN_DATE[table], schemas.MAIN_CONCEPT[table]]
        return first + [f.name for f in schema if f.name not in first and f.name != pk]
    return list(dict.fromkeys(["person_id", pk, *(f.name for f in schema)]))


def order_table(df: DataFrame, table: str) -> DataFrame:
    """An event table with its record ids; other tables have theirs already."""
    if table not in schemas.MAIN_CONCEPT:
        return df
    schema = schemas.TARGET[table]
    return record_ids(df, schemas.primary_key(schema), order_columns(table)).select(*(f.name for f in schema))
