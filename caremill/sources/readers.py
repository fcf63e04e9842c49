"""Readers of source exports and vocabulary files. All files are read by Spark, as strings; types come later."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremill.functions.values import dictionary_cast, dictionary_type, parse_yyyymmdd

#: A value that no file holds: with it as the null value, quoted empty strings stay apart from empty fields.
NO_VALUE = "\u0001"
#: What derived columns are called, the dictionary's header, the vocabulary's files.
DERIVED, HEADER = "derived_by_", ("table", "column", "data_type")
MAPS_TO, NO_VOCABULARY_ID = "Maps to", "None"
CONCEPT_COLUMNS = ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "standard_concept", "concept_code", "valid_start_date", "valid_end_date", "invalid_reason"]


def source_paths(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """The path of ``<root>/<source>/<table>.csv`` of each source that has the table, by source."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/{table}.csv")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return {status.getPath().getParent().getName(): status.getPath().toString() for status in found}


def read_source(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``<root>/<source>/<table>.csv`` of every source, as strings, with _source_id from the folder.

    Each source is read by its own header; columns meet by name, and one that a source lacks is null in its rows. No
    source with the table is an error.
    """
    reader = spark.read.option("header", True).option("nullValue", NO_VALUE).option("escape", '"')
    parts = [reader.csv(path).withColumn("_source_id", F.lit(source)) for source, path in sorted(source_paths(spark, root, table).items())]
    if not parts:
        raise ValueError(f"no source has a table {table}")
    whole = union_sources(parts)
    return whole.select(*(c for c in whole.columns if c != "_source_id"), "_source_id")


def drop_derived(df: DataFrame, pattern: str = DERIVED) -> DataFrame:
    return df.drop(*(c for c in df.columns if pattern in c.lower()))


def dictionary_rows(raw: DataFrame) -> DataFrame:
    """(table, column, data_type) of the dictionary's first three columns: trimmed, without blank rows and headers; empty is an error."""
    first = [F.trim(F.col(c)) for c in raw.columns[:3]]
    rows = raw.select(*(x.alias(n) for x, n in zip(first, HEADER, strict=True))).filter("coalesce(table, '') <> '' and coalesce(column, '') <> ''")
    rows = rows.filter(~((F.lower("table") == HEADER[0]) & (F.lower("column") == HEADER[1])))
    if rows.isEmpty():
        raise ValueError("the dictionary has no rows")
    return rows


def dictionary_of(rows: DataFrame, table: str) -> dict[str, str]:
    """Types of a table's columns: a few rows of metadata."""
    return {r[0]: r[1] for r in rows.filter(F.lower("table") == table.lower()).select("column", "data_type").collect()}


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns as their dictionary types; what doesn't parse is null, what isn't listed stays a string."""
    return df.select(*((dictionary_cast(F.col(c), types[c]) if c in types else F.col(c)).alias(c) for c in df.columns))


def parse_dates(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Only the date columns of the dictionary."""
    return df.select(*((parse_yyyymmdd(F.col(c)) if dictionary_type(types.get(c, "")) == "DATE" else F.col(c)).alias(c) for c in df.columns))


def dictionary_diff(a: DataFrame, b: DataFrame, most: int = 5) -> DataFrame:
    """Up to ``most`` rows that only one of two dictionaries has: side, table, column, data_type."""
    one, two = (x.select(*HEADER).distinct() for x in (a, b))
    only = lambda x, y, side: x.exceptAll(y).orderBy(*HEADER).limit(most).select(F.lit(side).alias("side"), *HEADER)
    return only(one, two, "first").unionByName(only(two, one, "second"))


def union_sources(parts: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Rows of all sources by column name; a column that a source lacks is null; only the given columns, where they exist."""
    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return whole.select(*(c for c in columns if c in whole.columns)) if columns else whole


def scan_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated file, quotes taken literally, all strings."""
    return spark.read.option("sep", "\t").option("quote", "").option("header", True).csv(path)


def scan_concepts(concepts: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Concept rows of one or two files, with src_rank so that the first file wins where ids repeat."""
    first = concepts.select(*CONCEPT_COLUMNS, F.lit(0).alias("src_rank"))
    return first if more is None else first.unionByName(more.select(*CONCEPT_COLUMNS, F.lit(1).alias("src_rank")))


def scan_maps_to(relationships: DataFrame) -> DataFrame:
    """(concept_id_1, concept_id_2) of the valid mappings to standard concepts."""
    valid = relationships.filter((F.col("relationship_id") == MAPS_TO) & (F.coalesce(F.col("invalid_reason"), F.lit("")) == ""))
    return valid.select(F.col("concept_id_1").cast("long").alias("concept_id_1"), F.col("concept_id_2").cast("long").alias("concept_id_2"))


def ancestry_edges(relationships: DataFrame, kinds: DataFrame) -> DataFrame:
    """(parent_concept_id, child_concept_id) of the valid relationships that define ancestry. ``kinds``: the RELATIONSHIP table."""
    defining = kinds.filter(F.col("defines_ancestry").cast("string") == "1").select("relationship_id").distinct()
    valid = relationships.filter(F.coalesce(F.col("invalid_reason"), F.lit("")) == "").join(defining, "relationship_id", "left_semi")
    return valid.select(F.col("concept_id_1").cast("long").alias("parent_concept_id"), F.col("concept_id_2").cast("long").alias("child_concept_id"))


def vocabulary_version(vocabularies: DataFrame) -> str:
    """Version of the whole vocabulary; an error if there is none."""
    row = vocabularies.filter(F.col("vocabulary_id") == NO_VOCABULARY_ID).select("vocabulary_version").first()
    if row is None or not row[0]:
        raise ValueError("the vocabulary table names no version")
    return row[0]


def load_terminology(parts: list[DataFrame]) -> DataFrame:
    """code_system, code, code_description of all sources; of several descriptions of a code, the first by source and text."""
    rows = union_sources(parts).filter("code is not null and code_description is not null")
    order = [F.col(c).asc_nulls_last() for c in ("_source_id", "code_description") if c in rows.columns]
    w = Window.partitionBy("code_system", "code").orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").select("code_system", "code", "code_description")


def metadata_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of a metadata column; none if the table lacks it."""
    return df.select(F.col(column).alias("value")).filter("value is not null") if column in df.columns else df.select(F.lit(None).cast("string").alias("value")).limit(0)


def typed_vocabulary(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A vocabulary table of strings in its types. A missing column is an error, and so is a value that doesn't parse."""
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    typed = lambda f: F.to_date(F.col(f.name), "yyyyMMdd") if isinstance(f.dataType, T.DateType) else F.col(f.name).cast(f.dataType)
    return df.select(*(typed(f).alias(f.name) for f in schema))


def typed_concepts(df: DataFrame) -> DataFrame:
    """Concepts with numeric ids, names that are never null, and dates."""
    day = lambda c: F.to_date(F.col(c), "yyyyMMdd").alias(c)
    own: dict[str, Column] = {"concept_id": F.col("concept_id").cast("long"), "concept_name": F.coalesce("concept_name", F.lit("")), "valid_start_date": day("valid_start_date"), "valid_end_date": day("valid_end_date")}
    return df.select(*((own[c] if c in own else F.col(c)).alias(c) for c in df.columns))


def mapping_overrides(bundled: DataFrame, own: DataFrame) -> DataFrame:
    """Configured rows (map, key, value) with the user's added or put in place; a null value means none."""
    return bundled.join(own.select("map", "key"), ["map", "key"], "left_anti").unionByName(own)
