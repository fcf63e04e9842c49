"""Checks of target tables. Each yields issue rows: check, table, error_type, column, n_bad, examples, skipped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremill import schemas
from caremill.operators.uniqueness import repeated_keys
from caremill.scratch import settled

ISSUES = "check string, table string, error_type string, column string, n_bad long, examples array<string>, skipped boolean"
EXAMPLES = 5
#: Concept columns of era tables and what they must hold.
ERA_CONCEPTS = {"condition_era": ("condition_concept_id", "domain_id", "Condition"), "drug_era": ("drug_concept_id", "concept_class_id", "Ingredient")}
SUPPORTED = {v: k for k, v in schemas.DOMAIN_TABLE.items()}


def issue_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ISSUES)


def _issues(df: DataFrame, check: str, table: str, kind: str, column: Column, n: Column, examples: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(kind).alias("error_type"), column.cast("string").alias("column"), n.cast("long").alias("n_bad"), examples.alias("examples"), F.lit(False).alias("skipped"))


def _nothing() -> Column:
    return F.lit(None).cast("array<string>")


def _some(values: Column) -> Column:
    """Up to EXAMPLES smallest values, as strings."""
    return F.transform(F.slice(F.array_sort(values), 1, EXAMPLES), lambda x: x.cast("string"))


def check_schema(df: DataFrame | None, table: str, schema: T.StructType, spark: SparkSession) -> DataFrame:
    """Missing table, missing and extra columns, other types (an all-null column may have any). Looks at metadata only."""
    return issue_rows(spark, _schema_faults(df, table, schema))


def _schema_faults(df: DataFrame | None, table: str, schema: T.StructType) -> list[tuple]:
    if df is None:
        return [("schema", table, "FILE_MISSING", None, None, None, False)]
    want, have = {f.name: f.dataType for f in schema}, {f.name: f.dataType for f in df.schema}
    found = [("MISSING_COLUMNS", c) for c in want if c not in have] + [("EXTRA_COLUMNS", c) for c in have if c not in want]
    found += [("TYPE_MISMATCH", c) for c in want if c in have and have[c] != want[c] and have[c] != T.NullType()]
    return [("schema", table, kind, c, None, None, False) for kind, c in found]


def check_primary_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows beyond the first of each key; null counts as a key."""
    n = df.groupBy(key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")).filter("n > 0")
    return _issues(n, "primary_key", table, "DUPLICATE_PRIMARY_KEY", F.lit(key), F.col("n"), _nothing())


def check_ordered_key(df: DataFrame, table: str, key: str) -> DataFrame:
    """check_primary_key() of a written table whose keys lie in order: only keys that may stand in two files are shuffled."""
    return _issues(repeated_keys(df, key).filter("n > 0"), "primary_key", table, "DUPLICATE_PRIMARY_KEY", F.lit(key), F.col("n"), _nothing())


def check_required(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Nulls in each column that must be filled; one pass."""
    counts = df.agg(*(F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c) for c in columns))
    n = counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns))).alias("x")).select("x.*").filter("n > 0")
    return _issues(n, "required", table, "NULL_REQUIRED_COLUMN", F.col("c"), F.col("n"), _nothing())


def check_tables_present(spark: SparkSession, present: list[str], expected: list[str]) -> DataFrame:
    return issue_rows(spark, _absent(present, expected))


def _absent(present: list[str], expected: list[str]) -> list[tuple]:
    return [("tables", t, "TABLES_MISSING", None, None, None, False) for t in expected if t not in present]


def check_single_row(df: DataFrame, table: str = "cdm_source") -> DataFrame:
    n = df.agg(F.count("*").alias("n")).filter("n <> 1")
    return _issues(n, "single_row", table, "ROW_COUNT", F.lit(None), F.col("n"), _nothing())


def check_person_refs(df: DataFrame, table: str, persons: DataFrame) -> DataFrame:
    """Distinct person ids that the person table lacks; a null one is one of them."""
    bad = settled(df.select("person_id").distinct().join(persons.select("person_id"), "person_id", "left_anti"))
    some = F.slice(F.array_sort(F.collect_list("person_id")), 1, EXAMPLES)
    least = bad.orderBy(F.col("person_id").asc_nulls_last()).limit(EXAMPLES).agg(some.alias("e"))
    n = bad.agg(F.count("*").alias("n")).join(F.broadcast(least), F.lit(True)).filter("n > 0")
    return _issues(n, "person_refs", table, "INVALID_PERSON_ID", F.lit("person_id"), F.col("n"), _some(F.col("e")))


def concept_ids(df: DataFrame, among: list[str] | None = None) -> DataFrame:
    """Distinct (column, concept_id) of the concept columns without 0 and null; the table is read once."""
    columns = among or [c for c in df.columns if c.endswith("_concept_id")]
    wide = df.select(*(F.col(c).cast("long").alias(c) for c in columns))
    return wide.unpivot([], columns, "column", "concept_id").filter("concept_id <> 0").distinct()


def concept_bitmaps(df: DataFrame, among: list[str] | None = None) -> DataFrame:
    """column, bucket, ids: the distinct ids of the concept columns without 0 and null, as bitmaps of 32768 ids each.

    Columns become rows without an array, in the generated code of the scan; ids are made distinct in the tasks before they
    meet, and a bucket of a column is one row of 4 KB, however many of its ids there are.
    """
    each = concept_ids(df, among)
    return each.groupBy("column", F.bitmap_bucket_number("concept_id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("concept_id")).alias("ids"))


def concept_counts(df: DataFrame, concepts: DataFrame, among: list[str] | None = None) -> DataFrame:
    """column, n_ids, n_known, n_standard: distinct ids of each concept column, how many of these there are among the concepts, and
    among the standard ones. Bitmaps meet, not ids: both of a bucket are and-ed and their bits counted."""
    used = concept_bitmaps(df, among)
    known = concepts.select(F.col("concept_id").cast("long").alias("known_concept_id"), F.when(F.col("standard_concept") == "S", F.col("concept_id").cast("long")).alias("standard_concept_id"))
    sets = concept_bitmaps(known).withColumnRenamed("column", "kind").withColumnRenamed("ids", "theirs")
    n = used.groupBy("column").agg(F.sum(F.bitmap_count("ids")).alias("n_ids"))
    both = used.join(sets, "bucket").withColumn("pair", F.explode(F.array("ids", "theirs")))
    shared = both.groupBy("column", "kind", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("pair")).alias("n")).groupBy("column")
    sums = shared.agg(*(F.sum(F.when(F.col("kind") == f"{k}_concept_id", F.col("n"))).alias(f"n_{k}") for k in ("known", "standard")))
    return n.join(sums, "column", "left").fillna(0)


def _per_column(bad: DataFrame, check: str, table: str, kind: str) -> DataFrame:
    """Counts per column with the smallest examples; only those EXAMPLES ids of a column are ever collected. Bad ids are written
    down, since both read them."""
    bad = settled(bad)
    nth = F.row_number().over(Window.partitionBy("column").orderBy("concept_id"))
    least = bad.withColumn("_n", nth).filter(F.col("_n") <= EXAMPLES).groupBy("column").agg(F.collect_list("concept_id").alias("e"))
    n = bad.groupBy("column").agg(F.count("*").alias("n")).join(F.broadcast(least), "column")
    return _issues(n, check, table, kind, F.col("column"), F.col("n"), _some(F.col("e")))


def check_concepts_exist(df: DataFrame, table: str, concepts: DataFrame) -> DataFrame:
    return _per_column(concept_ids(df).join(concepts.select("concept_id"), "concept_id", "left_anti"), "concepts_exist", table, "MISSING_CONCEPT")


def check_standard(df: DataFrame, table: str, concepts: DataFrame) -> DataFrame:
    """Ids of other than source concept columns that are known and not standard."""
    used = concept_ids(df, [c for c in df.columns if c.endswith("_concept_id") and not c.endswith("_source_concept_id")])
    known = concepts.filter(F.coalesce(F.col("standard_concept"), F.lit("")) != "S").select("concept_id")
    return _per_column(used.join(known, "concept_id"), "standard", table, "NON_STANDARD_CONCEPT")


def check_event_zero(df: DataFrame, table: str, column: str) -> DataFrame:
    n = df.agg(F.coalesce(F.sum((F.coalesce(F.col(column), F.lit(0)) == 0).cast("long")), F.lit(0)).alias("n")).filter("n > 0")
    return _issues(n, "event_zero", table, "ZERO_EVENT_CONCEPT", F.lit(column), F.col("n"), _nothing())


def check_event_domain(df: DataFrame, table: str, column: str, concepts: DataFrame, attribute: str = "domain_id", wanted: str | None = None, kind: str = "DOMAIN_MISMATCH") -> DataFrame:
    """Known main concepts whose domain (or other attribute) is not the table's."""
    wanted = wanted or SUPPORTED[table]
    known = concepts.filter(F.coalesce(F.col(attribute), F.lit("")) != wanted).select("concept_id")
    return _per_column(concept_ids(df, [column]).join(known, "concept_id"), "event_domain" if kind == "DOMAIN_MISMATCH" else "era_concepts", table, kind)


def check_era_concepts(df: DataFrame, table: str, concepts: DataFrame) -> DataFrame:
    column, attribute, wanted = ERA_CONCEPTS[table]
    return check_event_domain(df, table, column, concepts, attribute, wanted, "ERA_CONCEPT_MISMATCH")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, t in tables.items()))


def excluded_counts(excluded: DataFrame) -> DataFrame:
    return excluded.groupBy("source_table", "exclusion_reason").agg(F.count("*").alias("rows")).orderBy("source_table", F.desc("rows"), "exclusion_reason")


def check_coverage(coverage: DataFrame, excluded: DataFrame, tables: DataFrame) -> DataFrame:
    """Coverage against what was written. ``excluded``: see excluded_counts(); ``tables``: see table_counts()."""
    outcomes = coverage.groupBy("source_table", "outcome").agg(F.sum("rows").alias("said"))
    target = F.col("outcome").isin(*schemas.DOMAIN_TABLE.values())
    left = outcomes.filter(~target).join(excluded.withColumnRenamed("exclusion_reason", "outcome"), ["source_table", "outcome"], "full_outer").filter(~F.col("said").eqNullSafe(F.col("rows")))
    said = outcomes.filter(target).groupBy(F.col("outcome").alias("table")).agg(F.sum("said").alias("said"))
    right = said.join(tables, "table", "left").filter(~F.col("said").eqNullSafe(F.coalesce("rows", F.lit(0))))
    gap = F.coalesce("said", F.lit(0)) - F.coalesce("rows", F.lit(0))
    one = left.select(F.lit("coverage").alias("check"), F.col("source_table").alias("table"), F.lit("COVERAGE_EXCLUDED_MISMATCH").alias("error_type"), F.col("outcome").alias("column"), gap.alias("n_bad"), _nothing().alias("examples"), F.lit(False).alias("skipped"))
    two = right.select(F.lit("coverage").alias("check"), "table", F.lit("COVERAGE_TABLE_MISMATCH").alias("error_type"), F.lit(None).cast("string").alias("column"), gap.alias("n_bad"), _nothing().alias("examples"), F.lit(False).alias("skipped"))
    return one.unionByName(two)


def _filled(df: DataFrame, table: str, needed: list[str], main: str | None) -> DataFrame:
    """check_required and check_event_zero in one pass over the table."""
    marks = [("required", "NULL_REQUIRED_COLUMN", c, F.col(c).isNull()) for c in needed]
    if main:
        marks.append(("event_zero", "ZERO_EVENT_CONCEPT", main, F.coalesce(F.col(main), F.lit(0)) == 0))
    counts = df.agg(*(F.count_if(bad).alias(f"n{i}") for i, (*_, bad) in enumerate(marks)))
    each = F.array(*(F.struct(F.lit(check).alias("check"), F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.col(f"n{i}").alias("n")) for i, (check, kind, c, _) in enumerate(marks)))
    return counts.select(F.lit(table).alias("table"), F.explode(each).alias("x")).select("table", "x.*").filter("n > 0").withColumn("e", _nothing())


def _stacked(tables: dict[str, DataFrame], column_of: dict[str, str]) -> list[DataFrame]:
    """(table, column, value) of one column of each table: one frame for each type of value."""
    kinds: dict[str, list[DataFrame]] = {}
    for name, c in column_of.items():
        df = tables[name]
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(df.select(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(c).alias("value")))
    return [reduce(DataFrame.unionByName, parts) for parts in kinds.values()]


def _repeats(rows: DataFrame) -> DataFrame:
    """check_primary_key of many tables, by one shuffle. ``rows``: see _stacked()."""
    n = rows.groupBy("table", "column", "value").count().filter("count > 1").groupBy("table", "column").agg(F.sum(F.col("count") - 1).alias("n"))
    return n.select(F.lit("primary_key").alias("check"), F.lit("DUPLICATE_PRIMARY_KEY").alias("kind"), "*", _nothing().alias("e"))


def _repeats_in_order(df: DataFrame, table: str, key: str) -> DataFrame:
    """check_ordered_key() in the columns of _repeats()."""
    n = repeated_keys(df, key).filter("n > 0")
    return n.select(F.lit("primary_key").alias("check"), F.lit("DUPLICATE_PRIMARY_KEY").alias("kind"), F.lit(table).alias("table"), F.lit(key).alias("column"), "n", _nothing().alias("e"))


def _with_examples(bad: DataFrame) -> DataFrame:
    """check, kind, table, column, n, e of distinct bad values. They are written down, since counts and examples both read them."""
    bad, of = settled(bad), ["check", "kind", "table", "column"]
    nth = F.row_number().over(Window.partitionBy(*of).orderBy(F.col("value").asc_nulls_last()))
    least = bad.withColumn("_n", nth).filter(F.col("_n") <= EXAMPLES).groupBy(*of).agg(F.collect_list("value").alias("e"))
    return bad.groupBy(*of).agg(F.count("*").alias("n")).join(least, of).withColumn("e", _some(F.col("e")))


def _concept_faults(tables: dict[str, DataFrame], concepts: DataFrame) -> DataFrame:
    """The checks of concepts over many tables: each table is read once, and the distinct ids of all meet the concepts once."""
    ids = reduce(DataFrame.unionByName, (concept_ids(df).withColumn("table", F.lit(n)) for n, df in tables.items()))
    known = concepts.select("concept_id", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("standard_concept", "domain_id", "concept_class_id")), F.lit(True).alias("known"))
    exists, source = F.col("known").isNotNull(), F.col("column").endswith("_source_concept_id")
    tests = [("concepts_exist", "MISSING_CONCEPT", ~exists), ("standard", "NON_STANDARD_CONCEPT", exists & ~source & (F.col("standard_concept") != "S"))]
    at = lambda n, c: exists & (F.col("table") == n) & (F.col("column") == c)
    tests += [("event_domain", "DOMAIN_MISMATCH", at(n, c) & (F.col("domain_id") != SUPPORTED[n])) for n, c in schemas.MAIN_CONCEPT.items() if n in tables]
    tests += [("era_concepts", "ERA_CONCEPT_MISMATCH", at(n, c) & (F.col(attribute) != wanted)) for n, (c, attribute, wanted) in ERA_CONCEPTS.items() if n in tables]
    failed = F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(check).alias("check"), F.lit(kind).alias("kind"))) for check, kind, bad in tests)))
    each = ids.join(known, "concept_id", "left").select("table", "column", F.col("concept_id").alias("value"), F.explode(failed).alias("x"))
    return _with_examples(each.select("x.*", "table", "column", "value").distinct())


def validate(tables: dict[str, DataFrame], coverage: DataFrame | None = None, excluded: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """Every check that the tables at hand allow; one that lacks its table is a skipped row.

    ``ordered``: the tables are files that write_table() wrote. Their keys are then checked by runs (see repeated_keys()), and
    only keys of runs that overlap are shuffled; the rows are the same either way.

    Tables are checked together: keys, person ids and concept ids of all tables are each made distinct and looked up by one
    shuffle, so the plan doesn't grow by a join for every table and column. Bad ids are written to the shared folder.
    """
    spark = next(iter(tables.values())).sparkSession
    known = {n: s for n, s in (schemas.TARGET | schemas.ERA | schemas.VOCABULARY).items() if n in tables}
    seen = _absent(list(tables), list(schemas.TARGET))
    parts, keys = [], {}
    for name, schema in known.items():
        df, main = tables[name], schemas.MAIN_CONCEPT.get(name)
        seen += _schema_faults(df, name, schema)
        needed, main = [c for c in schemas.required(schema) if c in df.columns], main if main in df.columns else None
        if needed or main:
            parts.append(_filled(df, name, needed, main))
        if (key := schemas.primary_key(schema)) in df.columns:
            keys[name] = key
    if ordered:
        parts += [_repeats_in_order(tables[n], n, key) for n, key in keys.items()]
    else:
        parts += [_repeats(rows) for rows in _stacked(tables, keys)]
    if "person" in tables:
        refs = {n: "person_id" for n in known if n != "person" and "person_id" in tables[n].columns}
        persons = tables["person"].select(F.col("person_id").alias("value"))
        for rows in _stacked(tables, refs):
            gone = rows.distinct().join(persons, "value", "left_anti")
            parts.append(_with_examples(gone.select(F.lit("person_refs").alias("check"), F.lit("INVALID_PERSON_ID").alias("kind"), "table", "column", "value")))
    if "concept" in tables:
        coded = {n: tables[n] for n in known if n not in schemas.VOCABULARY and n != "concept" and any(c.endswith("_concept_id") for c in tables[n].columns)}
        if coded:
            parts.append(_concept_faults(coded, tables["concept"]))
    skipped = [("person_refs", "person")] * ("person" not in tables) + [("concepts_exist", "concept"), ("standard", "concept")] * ("concept" not in tables) + [("coverage", "coverage")] * (coverage is None or excluded is None)
    seen += [(c, t, "SKIPPED", None, None, None, True) for c, t in skipped]
    found = [issue_rows(spark, seen)]
    found += [p.select("check", "table", F.col("kind").alias("error_type"), "column", F.col("n").cast("long").alias("n_bad"), F.col("e").alias("examples"), F.lit(False).alias("skipped")) for p in parts]
    if "cdm_source" in tables:
        found.append(check_single_row(tables["cdm_source"]))
    if coverage is not None and excluded is not None:
        found.append(check_coverage(coverage, excluded, table_counts({t: tables[t] for t in schemas.DOMAIN_TABLE.values() if t in tables})))
    return reduce(DataFrame.unionByName, found)


def planned_checks(tables: dict[str, DataFrame], coverage: DataFrame | None = None, excluded: DataFrame | None = None) -> list[tuple[str, str, bool]]:
    """(check, table, runs) of all that validate() looks at, given the same tables: a row for each table that must be there and each
    check of a table that is. ``runs`` is false where a check lacks the table that it compares with."""
    known = {n: s for n, s in (schemas.TARGET | schemas.ERA | schemas.VOCABULARY).items() if n in tables}
    out = [("tables", n, True) for n in schemas.TARGET] + [("schema", n, True) for n in known]
    for name, schema in known.items():
        has, main = set(tables[name].columns), schemas.MAIN_CONCEPT.get(name)
        out += [("primary_key", name, True)] * (schemas.primary_key(schema) in has)
        out += [("required", name, True)] * any(c in has for c in schemas.required(schema))
        out += [("event_zero", name, True)] * (main in has)
        out += [("person_refs", name, "person" in tables)] * (name != "person" and "person_id" in has)
        if name not in schemas.VOCABULARY and name != "concept" and any(c.endswith("_concept_id") for c in has):
            era = ERA_CONCEPTS.get(name, (None,))[0]
            lookups = ["concepts_exist", "standard"] + ["event_domain"] * (main in has) + ["era_concepts"] * (era in has)
            out += [(check, name, "concept" in tables) for check in lookups]
    out += [("single_row", "cdm_source", True)] * ("cdm_source" in tables)
    return [*out, ("coverage", "coverage", coverage is not None and excluded is not None)]


def check_outcomes(issues: DataFrame, tables: dict[str, DataFrame], coverage: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """check, table, outcome (passed, failed, skipped), n_issues, rows of every planned check, so that one that ran clean can be told
    from one that never ran.

    ``issues``: what validate() gave for the same tables; it is read once, so write it down first. All issues of coverage,
    whatever table they name, are those of one check. ``rows``: of the table, null where it is missing.
    """
    spark = issues.sparkSession
    planned = spark.createDataFrame(planned_checks(tables, coverage, excluded), "check string, table string, runs boolean")
    table = F.when(F.col("check") == "coverage", F.lit("coverage")).otherwise(F.col("table"))
    found = issues.filter("not skipped").groupBy("check", table.alias("table")).agg(F.count("*").alias("n"))
    rows = table_counts({n: t for n, t in tables.items() if n in schemas.TARGET | schemas.ERA | schemas.VOCABULARY})
    outcome = F.when(~F.col("runs"), "skipped").when(F.col("n").isNull(), "passed").otherwise("failed")
    joined = planned.join(found, ["check", "table"], "left").join(rows, "table", "left")
    return joined.select("check", "table", outcome.alias("outcome"), F.coalesce("n", F.lit(0)).alias("n_issues"), "rows")


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """outcome, checks, n_issues; of an outcome that no check has there is a row of zeros."""
    every = outcomes.sparkSession.createDataFrame([("passed",), ("failed",), ("skipped",)], "outcome string")
    n = outcomes.groupBy("outcome").agg(F.count("*").alias("checks"), F.sum("n_issues").alias("n_issues"))
    return every.join(n, "outcome", "left").fillna(0)


def _pattern(glob: Column) -> Column:
    """Regular expression of a shell pattern with ``*`` and ``?``, for the whole lower-case id."""
    quoted = F.regexp_replace(F.lower(glob), r"([.+^${}()|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\?", "."), F.lit("$"))


def matches(checks: DataFrame, accepted: DataFrame) -> DataFrame:
    """check_id and the columns of each pattern that matches it.

    Patterns meet the ids that begin like them: what stands before a pattern's first wildcard is a key of an equi-join, and
    the expression decides only there. The lengths of these beginnings are one row, of as many numbers as patterns are long.
    """
    begin = F.regexp_extract(F.lower("pattern"), "^[^*?]*", 0)
    known = accepted.withColumns({"_begin": begin, "_p": _pattern(F.col("pattern"))})
    lengths = known.agg(F.collect_set(F.length("_begin")).alias("_lengths"))
    ids = checks.select("check_id").distinct().join(F.broadcast(lengths), F.lit(True))
    begins = F.transform(F.filter("_lengths", lambda n: n <= F.length("check_id")), lambda n: F.lower("check_id").substr(F.lit(1), n))
    keyed = ids.select("check_id", F.explode(begins).alias("_begin"))
    return keyed.join(known, "_begin").filter(F.rlike(F.lower("check_id"), F.col("_p"))).drop("_begin", "_p")


def triage_results(checks: DataFrame, accepted: DataFrame) -> DataFrame:
    """check_id, outcome (error, not_applicable, passed, accepted, failed), reason of check results.

    ``checks``: check_id, failed, is_error, not_applicable (0 or 1); ``accepted``: pattern, reason. Of several patterns that
    match, the smallest gives the reason.
    """
    found = matches(checks, accepted).groupBy("check_id").agg(F.min(F.struct("pattern", "reason")).alias("_best"))
    joined = checks.join(found, "check_id", "left")
    good = (F.col("is_error") == 0) & (F.col("failed") == 0)
    outcome = F.when(good & (F.col("not_applicable") == 1), "not_applicable").when(good, "passed").when(F.col("_best").isNotNull(), "accepted").when(F.col("is_error") == 1, "error").otherwise("failed")
    return joined.select("check_id", outcome.alias("outcome"), F.when(outcome == "accepted", F.col("_best.reason")).alias("reason"))


def unused_patterns(checks: DataFrame, accepted: DataFrame) -> DataFrame:
    """Patterns that match no failed or broken check."""
    used = matches(checks.filter("failed = 1 or is_error = 1"), accepted).select("pattern").distinct()
    return accepted.select("pattern").join(used, "pattern", "left_anti")


def triage_counts(triaged: DataFrame) -> DataFrame:
    return triaged.groupBy("outcome").agg(F.count("*").alias("checks"))
