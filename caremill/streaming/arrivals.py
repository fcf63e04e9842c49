"""Source folders that grow: new export files as a stream of rows, cleaned with the same operators as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremill.sources.readers import NO_VALUE


def follow_source(spark: SparkSession, root: str, table: str, columns: list[str], source: str = "*") -> DataFrame:
    """read_source() as a stream: each new ``<root>/<source>/<table>.csv``, a file or a folder of files, once; columns are given,
    not looked up. ``source``: a name or a pattern of names.

    A file with another header than the given columns is an error, not misread: follow sources with headers of their own by
    a stream each (``source``) and put these together by union_sources().
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {"header": True, "enforceSchema": False, "nullValue": NO_VALUE, "escape": '"'}
    # in braces a single name is a pattern too: a path without one must be a folder
    df = spark.readStream.schema(schema).options(**options).csv(f"{root}/{{{source}}}/{table}.csv")
    return df.withColumn("_source_id", F.regexp_extract("_metadata.file_path", f"([^/]+)/{table}\\.csv(?:/[^/]+)?$", 1))
