"""Eras of records that keep arriving: open eras are the stream's state, closed ones are given out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremill.operators.intervals import ERA_GAP, condition_spans

#: The first day that no record has; a row of it ends a stream.
MARK = "9999-01-01"


def streamed_intervals(spans: DataFrame, keys: list[str], gap: int, count: str, delay: str) -> DataFrame:
    """merge_intervals() of a stream of (keys, start, end): keys, start, end, ``count``.

    An era is a session of its key: each interval holds it open until its end and ``gap`` days more. The sessions are kept by
    Spark's state store and merged there, also when an interval comes late and joins two of them. An era is given out once no
    interval that touches it is awaited any more, that is when the watermark (the latest start less ``delay``) has passed it; in between it
    outlives restarts from the query's checkpoint. Intervals that start before the watermark come too late and are left out.

    A row that starts on MARK or later belongs to no era but moves the watermark: it closes all eras. An interval without a
    start is one by itself, as in the batch.
    """
    timed = spans.filter("start is not null").withColumn("_at", F.col("start").cast("timestamp")).withWatermark("_at", delay)
    held = F.concat((F.greatest(F.coalesce(F.datediff("end", "start"), F.lit(0)), F.lit(0)) + gap).cast("string"), F.lit(" days"))
    # told by the watermark's own column: other filters would be moved before the watermark sees the row
    real = timed.filter(F.col("_at") < F.to_timestamp(F.lit(MARK)))
    # a session that begins in the very moment in which another one ends is merged with it
    sessions = real.groupBy(F.session_window("_at", held), *keys).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias(count))
    alone = spans.filter("start is null").select(*keys, "start", "end", F.lit(1).cast("long").alias(count))
    return sessions.select(*keys, "start", "end", count).unionByName(alone)


def streamed_condition_eras(conditions: DataFrame, delay: str) -> DataFrame:
    """condition_eras() of a stream of condition records; see streamed_intervals()."""
    marks = F.col("condition_start_date") >= F.to_date(F.lit(MARK))
    spans = condition_spans(conditions.filter((F.col("condition_concept_id") != 0) | marks))
    eras = streamed_intervals(spans, ["person_id", "condition_concept_id"], ERA_GAP, "condition_occurrence_count", delay)
    return eras.withColumnsRenamed({"start": "condition_era_start_date", "end": "condition_era_end_date"})
