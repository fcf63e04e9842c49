"""How much of the source data reaches the target tables. Rows are counted by code before anything is joined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremill import schemas
from caremill.functions.values import SOURCE_VOCABULARIES
from caremill.operators.vocabulary import EXTENSION, NO_SOURCE, NO_VOCABULARY, UCUM, attach_vocabulary, is_invalid, unique_concepts, vocabulary_map
from caremill.scratch import settled

KEYS = ["source_table", "code_system", "code"]
#: The domain that each source table is expected to fill, and the lengths of the reports.
EXPECTED = {"diagnosis": "Condition", "procedure": "Procedure", "medication_ingredient": "Drug", "lab_result": "Measurement", "vitals_signs": "Measurement"}
TOP_MULTI, TOP_UNMAPPED, TOP_UNITS, TOP_TEXTS = 15, 20, 30, 30
#: Counters of a sketch of frequent values, and its error as a multiple of rows / counters (a property of the sketch).
TRACKED, SKETCH_ERROR = 4096, 3.5


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.bround(part.cast("double") * 100 / whole, digits)


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def _rows(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))


def _literal_map(value: Column, mapping: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv)), value)


def record_coverage(df: DataFrame, table: str, codes: DataFrame) -> DataFrame:
    """Output rows per code and outcome: the target table, or the reason why there is none."""
    counts = df.select(F.col("code_system").cast("string"), F.col("code").cast("string")).groupBy("code_system", "code").agg(F.count("*").alias("rows"))
    mine = codes.filter(F.col("source_table") == table).select("code_system", "code", "concept_id", "domain_id", "exclusion_reason")
    outcome = F.when(F.col("concept_id").isNotNull(), _literal_map(F.col("domain_id"), schemas.DOMAIN_TABLE)).otherwise(F.coalesce("exclusion_reason", F.lit(NO_SOURCE)))
    return counts.join(mine, ["code_system", "code"], "left").groupBy("code_system", "code", outcome.alias("outcome")).agg(F.sum("rows").alias("rows")).select(F.lit(table).alias("source_table"), "code_system", "code", "outcome", "rows")


def coverage(parts: DataFrame) -> DataFrame:
    """Rows and codes per table, code system and outcome, and their shares of the table. ``parts``: see record_coverage().

    A code with several outcomes counts once in its table: its first outcome stands for it. The parts are dealt out by code
    once, for that mark and for the sums.
    """
    each = parts.repartition(*KEYS).groupBy(*KEYS, "outcome").agg(F.sum("rows").alias("rows"))
    first = F.row_number().over(Window.partitionBy(*KEYS).orderBy("outcome")) == 1
    coded = F.col("code").isNotNull()
    sums = each.withColumn("_first", (first & coded).cast("long")).groupBy("source_table", "code_system", "outcome").agg(F.sum("rows").alias("rows"), F.sum(coded.cast("long")).alias("codes"), F.sum("_first").alias("_codes"))
    whole = Window.partitionBy("source_table")
    codes = F.sum("_codes").over(whole)
    return sums.select("source_table", "code_system", "outcome", "rows", percent(F.col("rows"), F.sum("rows").over(whole), 2).alias("rows_pct"), "codes", F.when(codes > 0, percent(F.col("codes"), codes, 2)).otherwise(F.lit(0.0)).alias("codes_pct"))


def coverage_by_outcome(table: DataFrame) -> DataFrame:
    return table.groupBy("source_table", "outcome").agg(F.sum("rows").alias("rows")).orderBy("source_table", F.desc("rows"), "outcome")


def excluded_by_table(table: DataFrame) -> DataFrame:
    """Rows of each source table that reach no target table."""
    return table.filter(~F.col("outcome").isin(*schemas.DOMAIN_TABLE.values())).groupBy("source_table").agg(F.sum("rows").alias("rows"))


def _counted(tables: dict[str, DataFrame], columns: list[str], names: list[str] | None = None) -> DataFrame:
    parts = [t.groupBy(F.lit(n).alias("source_table"), *(F.col(c).cast("string").alias(c) for c in columns)).agg(F.count("*").alias("rows")) for n, t in tables.items() if (names is None or n in names) and all(c in t.columns for c in columns)]
    return reduce(DataFrame.unionByName, parts).groupBy("source_table", *columns).agg(F.sum("rows").alias("rows"))


def source_code_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _counted(tables, ["code_system", "code"])


def source_unit_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _counted(tables, ["units_of_measure"])


def source_text_counts(labs: DataFrame) -> DataFrame:
    return labs.groupBy("lab_result_text_val").agg(F.count("*").alias("rows"))


def with_known(counts: DataFrame, mapping: dict = SOURCE_VOCABULARIES) -> DataFrame:
    """Counts with vocabulary_id and whether the pair of table and code system is configured."""
    pairs = vocabulary_map(counts, mapping).select("source_table", "code_system", F.lit(True).alias("_known"))
    return attach_vocabulary(counts, mapping).join(F.broadcast(pairs), ["source_table", "code_system"], "left").withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")


def code_system_pairs(counts: DataFrame, mapping: dict = SOURCE_VOCABULARIES) -> DataFrame:
    return with_known(counts, mapping).groupBy("source_table", "code_system", "vocabulary_id", "known").agg(F.sum("rows").alias("rows"), F.count("*").alias("distinct_codes"))


def vocabulary_availability(vocabularies: DataFrame, concepts: DataFrame, mapping: dict = SOURCE_VOCABULARIES) -> DataFrame:
    """Wanted vocabularies: in the vocabulary table or not, concepts, concepts without name."""
    wanted = vocabulary_map(concepts, mapping).select("vocabulary_id").dropna().unionByName(concepts.sparkSession.createDataFrame([(EXTENSION,), (UCUM,)], "vocabulary_id string")).distinct()
    counts = concepts.groupBy("vocabulary_id").agg(F.count("*").alias("_c"), _count(F.coalesce(F.col("concept_name"), F.lit("")) == "").alias("_e"))
    there = vocabularies.select("vocabulary_id", F.lit(True).alias("_there")).distinct()
    joined = wanted.join(there, "vocabulary_id", "left").join(counts, "vocabulary_id", "left")
    return joined.select("vocabulary_id", F.coalesce("_there", F.lit(False)).alias("available"), F.coalesce("_c", F.lit(0)).alias("concepts"), F.coalesce("_e", F.lit(0)).alias("empty_names"))


def expected_domain(table: str = "source_table") -> Column:
    return _literal_map(F.col(table), EXPECTED)


def code_summary(codes: DataFrame) -> DataFrame:
    """Per code: source concept, usable targets, whether a target lies outside the expected domain, the smallest reason."""
    return codes.filter(F.col("source_table").isin(*EXPECTED)).groupBy(*KEYS).agg(F.max("source_concept_id").alias("source_concept_id"), _count(F.col("exclusion_reason").isNull()).alias("n_targets"), F.coalesce(F.bool_or(F.col("domain_id") != expected_domain()), F.lit(False)).alias("off_domain"), F.min("exclusion_reason").alias("exclusion_reason"))


def source_concepts(concepts: DataFrame, source_ids: DataFrame) -> DataFrame:
    """Name and flags of the given source concepts."""
    wanted = source_ids.select(F.col("source_concept_id").alias("concept_id")).distinct()
    one = unique_concepts(concepts.withColumn("concept_id", F.col("concept_id").try_cast("bigint")).join(wanted, "concept_id", "left_semi"))
    return one.select(F.col("concept_id").alias("source_concept_id"), F.col("concept_name").alias("source_concept_name"), is_invalid().alias("source_invalid"), (F.coalesce("standard_concept", F.lit("")) == "S").alias("source_standard"))


def mapped_codes(counts: DataFrame, codes: DataFrame, concepts: DataFrame, mapping: dict = SOURCE_VOCABULARIES) -> DataFrame:
    """Counts, vocabulary, summary and source concept of each code; the base of the reports below."""
    summary = code_summary(codes)
    found = source_concepts(concepts, summary.filter("source_concept_id > 0"))
    joined = with_known(counts, mapping).join(summary, KEYS, "left").join(found, "source_concept_id", "left")
    filled = joined.withColumns({"n_targets": F.coalesce("n_targets", F.lit(0)), "source_concept_id": F.coalesce("source_concept_id", F.lit(0)), "off_domain": F.coalesce("off_domain", F.lit(False)), "source_invalid": F.coalesce("source_invalid", F.lit(False))})
    return filled.withColumn("has_source", F.col("source_concept_id") > 0)


def self_mapping(found: DataFrame, maps_to: DataFrame) -> DataFrame:
    """Standard source concepts: n_standard, n_with a valid row that maps them to themselves, n_without, and the 20 smallest without."""
    standard = found.filter("source_standard").select(F.col("source_concept_id").alias("id")).distinct()
    selves = maps_to.filter("concept_id_1 = concept_id_2").select(F.col("concept_id_1").alias("id"), F.lit(True).alias("_self")).distinct()
    marked = standard.join(selves, "id", "left")
    some = marked.filter("_self is null").orderBy("id").limit(20).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return marked.agg(F.count("*").alias("n_standard"), _count(F.col("_self").isNotNull()).alias("n_with"), _count(F.col("_self").isNull()).alias("n_without")).join(F.broadcast(some), F.lit(True))


def _summary(mapped: DataFrame) -> DataFrame:
    multi, std = F.col("n_targets") > 1, F.col("n_targets") > 0
    return mapped.groupBy("source_table", "code_system").agg(
        F.count("*").alias("codes"), _count(F.col("has_source")).alias("codes_src"), _count(F.col("source_invalid")).alias("codes_src_invalid"), _count(std).alias("codes_std"), _count(multi).alias("codes_multi"), _count(F.col("off_domain")).alias("codes_off_domain"),
        F.sum("rows").alias("rows"), _rows(F.col("has_source")).alias("rows_src"), _rows(F.col("source_invalid")).alias("rows_src_invalid"), _rows(std).alias("rows_std"), _rows(multi).alias("rows_multi"), F.sum(F.col("rows") * F.greatest(F.col("n_targets") - 1, F.lit(0))).alias("extra_rows"), _rows(F.col("off_domain")).alias("rows_off_domain"),
    )


def coverage_by_code(mapped: DataFrame) -> DataFrame:
    s = _summary(mapped)
    return s.select("source_table", "code_system", "codes", "codes_src", percent(F.col("codes_src"), F.col("codes")).alias("src_pct"), "codes_src_invalid", "codes_std", percent(F.col("codes_std"), F.col("codes")).alias("std_pct"), "codes_multi", "codes_off_domain")


def coverage_by_row(mapped: DataFrame) -> DataFrame:
    s = _summary(mapped)
    return s.select("source_table", "code_system", "rows", "rows_src", percent(F.col("rows_src"), F.col("rows")).alias("src_pct"), "rows_src_invalid", "rows_std", percent(F.col("rows_std"), F.col("rows")).alias("std_pct"), "rows_multi", "extra_rows", "rows_off_domain", percent(F.col("rows_off_domain"), F.col("rows")).alias("off_domain_pct"))


def coverage_totals(mapped: DataFrame) -> DataFrame:
    t = _summary(mapped).groupBy("source_table").agg(*(F.sum(c).alias(c) for c in ("rows", "rows_std", "rows_off_domain", "extra_rows")))
    return t.withColumn("std_pct", percent(F.col("rows_std"), F.col("rows")))


def target_domains(codes: DataFrame, counts: DataFrame) -> DataFrame:
    """Codes and source rows per table, code system, expected and actual domain; a code counts once for each target."""
    joined = codes.filter("domain_id is not null").filter(F.col("source_table").isin(*EXPECTED)).join(counts, KEYS)
    return joined.groupBy("source_table", "code_system", expected_domain().alias("expected_domain"), "domain_id").agg(F.countDistinct("code").alias("codes"), F.sum("rows").alias("rows"))


def top_multi_target(mapped: DataFrame, most: int = TOP_MULTI) -> DataFrame:
    return mapped.filter("n_targets > 1").select(*KEYS, "source_concept_name", "n_targets", "rows").orderBy(F.desc("rows"), *KEYS).limit(most)


def _unmapped(mapped: DataFrame, vocabularies: DataFrame) -> DataFrame:
    there = vocabularies.select("vocabulary_id", F.lit(True).alias("_there")).distinct()
    joined = mapped.filter("n_targets = 0").join(there, "vocabulary_id", "left")
    return joined.withColumn("reason", F.when(F.col("_there").isNull(), NO_VOCABULARY).otherwise(F.coalesce("exclusion_reason", F.lit(NO_SOURCE))))


def unmapped_by_reason(mapped: DataFrame, vocabularies: DataFrame) -> DataFrame:
    return _unmapped(mapped, vocabularies).groupBy("source_table", "reason").agg(F.count("*").alias("codes"), F.sum("rows").alias("rows"))


def top_unmapped(mapped: DataFrame, vocabularies: DataFrame, most: int = TOP_UNMAPPED) -> DataFrame:
    w = Window.partitionBy("source_table").orderBy(F.desc("rows"), F.col("code_system").asc_nulls_last(), F.col("code").asc_nulls_last())
    return _unmapped(mapped, vocabularies).withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= most).select("source_table", "nth", "code_system", "code", "rows", "reason", "source_concept_id", "source_concept_name")


def marked_units(counts: DataFrame, units: DataFrame) -> DataFrame:
    """Unit counts with ucum (mapped to a concept) and empty; null units are empty."""
    filled = counts.withColumn("units_of_measure", F.coalesce("units_of_measure", F.lit("")))
    return filled.join(units, "units_of_measure", "left").withColumns({"ucum": F.coalesce("unit_concept_id", F.lit(0)) > 0, "empty": F.col("units_of_measure") == ""})


def unit_summary(units: DataFrame) -> DataFrame:
    s = units.groupBy("source_table").agg(F.count("*").alias("distinct_units"), _count(F.col("empty")).alias("distinct_empty"), _count(F.col("ucum")).alias("distinct_ucum"), F.sum("rows").alias("rows"), _rows(F.col("empty")).alias("rows_empty"), _rows(F.col("ucum")).alias("rows_ucum"))
    return s.withColumn("ucum_pct", percent(F.col("rows_ucum"), F.col("rows")))


def top_units(units: DataFrame, unmatched: bool = False, most: int = TOP_UNITS) -> DataFrame:
    t = units.groupBy("units_of_measure", "ucum").agg(F.sum("rows").alias("rows"))
    return (t.filter("not ucum and units_of_measure <> ''") if unmatched else t).orderBy(F.desc("rows"), "units_of_measure").limit(most)


def top_text_values(texts: DataFrame, most: int = TOP_TEXTS) -> DataFrame:
    """The most frequent non-empty texts, with all rows, rows with a text and distinct texts of the whole table."""
    filled = texts.withColumn("lab_result_text_val", F.coalesce("lab_result_text_val", F.lit("")))
    some = F.col("lab_result_text_val") != ""
    totals = filled.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"), _rows(some).alias("text_rows"), F.countDistinct(F.when(some, F.col("lab_result_text_val"))).alias("distinct_texts"))
    per_text = filled.filter(some).groupBy("lab_result_text_val").agg(F.sum("rows").alias("rows"))
    return per_text.orderBy(F.desc("rows"), "lab_result_text_val").limit(most).join(F.broadcast(totals), F.lit(True))


def heavy_values(df: DataFrame, column: str, most: int = TOP_TEXTS, tracked: int = TRACKED) -> DataFrame:
    """The ``most`` most frequent non-null, non-empty values of a column, with their rows; of ties the smaller values.

    A sketch of ``tracked`` counters a task names candidates; sketches are merged, so no value is shuffled. Then the rows of
    candidates alone are counted, exactly. A value that the sketch doesn't name has at most SKETCH_ERROR / tracked of all rows;
    unless the last row of a full result has more than that, everything is counted instead, which is cheap where values are few.
    """
    text = df.select(F.col(column).cast("string").alias(column)).filter(F.col(column) != "")
    seen = settled(text.agg(F.count("*").alias("n"), F.expr(f"approx_top_k({column}, {tracked}, {tracked})").alias("found")))
    named = seen.select(F.explode("found.item").alias(column))  # at most ``tracked`` rows
    top = lambda rows: rows.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column).limit(most)
    exact = settled(top(text.join(F.broadcast(named), column, "left_semi")))
    total, last = seen.select("n").first(), exact.agg(F.count("*").alias("n"), F.min("rows").alias("least")).first()
    return exact if last.n == most and last.least * tracked > SKETCH_ERROR * total.n else top(text)
