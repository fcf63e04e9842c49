"""Queries of the operators that split, stream, bucket and sketch, and queries over whole tables beside those over a part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremill import schemas
from caremill.operators import cleaning, coverage, entities, intervals, keys, quality, uniqueness, vocabulary
from caremill.plans.inputs import INPUTS
from caremill.plans.refresh import refresh_clean
from caremill.plans.registered import _ALIVE, _BUNDLED, _CONDITION_ERAS, _CUT, _NULLED, _REFERENCED, QUERIES, islands, query
from caremill.plans.steps import CODED, STEPS, quoted, values
from caremill.scratch import bucketed, by_one_key, scratch, settled
from caremill.sources import readers, writers
from caremill.streaming.eras import MARK, streamed_condition_eras

# Intervals

INPUTS["stays"] = """SELECT CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE o_custkey END AS person_id, o_custkey % 40 AS ward, CAST(o_orderdate AS DATE) AS start,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 3 AS INT) END AS finish FROM orders"""


def _stays(stays: DataFrame) -> DataFrame:
    return stays.withColumn("end", F.coalesce("finish", "start"))


@query("split_intervals", f"SELECT person_id, ward, s AS start, e AS \"end\", n FROM ({islands('(SELECT person_id, ward, start AS s, coalesce(finish, start) AS e FROM stays)', 'person_id, ward', 5, 'count(*) AS n')}) AS m", "stays")
def _(spark, stays):
    """Half of all rows belong to one person."""
    return intervals.split_intervals(_stays(stays), ["person_id", "ward"], 5, {"n": F.lit(1).cast("long")})


@query("split_one_key", f"SELECT one, s AS start, e AS \"end\", n FROM ({islands('(SELECT 1 AS one, start AS s, s2 AS e FROM (SELECT start, CASE WHEN ward = 7 THEN coalesce(finish, start) ELSE start END AS s2 FROM stays WHERE ward < 9))', 'one', 0, 'count(*) AS n')}) AS m", "stays")
def _(spark, stays):
    """Wards below 9 share a single key."""
    end = F.when(F.col("ward") == 7, F.col("end")).otherwise(F.col("start"))
    rows = _stays(stays).filter("ward < 9").select(F.lit(1).alias("one"), "start", end.alias("end"))
    return intervals.split_intervals(rows, ["one"], 0, {"n": F.lit(1).cast("long")})


INPUTS["lineage"] = """SELECT p_partkey // 2 AS parent_concept_id, p_partkey AS child_concept_id FROM part WHERE p_partkey > 1
    UNION ALL SELECT p_partkey % 97 + 1, p_partkey FROM part WHERE p_partkey > 97 AND p_size % 3 = 0""".replace("p_partkey // 2", "CAST(floor(p_partkey / 2) AS BIGINT)")


@query("closure_from_edges", "SELECT * FROM (WITH RECURSIVE r AS (SELECT DISTINCT parent_concept_id AS a, child_concept_id AS d, 1 AS n FROM lineage UNION SELECT r.a, child_concept_id, n + 1 FROM r JOIN lineage ON parent_concept_id = r.d) SELECT a AS ancestor_concept_id, d AS descendant_concept_id, min(n) AS min_levels_of_separation, max(n) AS max_levels_of_separation FROM (SELECT * FROM r UNION ALL SELECT DISTINCT x, x, 0 FROM (SELECT parent_concept_id AS x FROM lineage UNION SELECT child_concept_id FROM lineage)) AS p GROUP BY a, d) AS c", "lineage")
def _(spark, lineage):
    return intervals.closure_from_edges(lineage)


@query("streamed_eras", _CONDITION_ERAS, "conditions")
def _(spark, conditions):
    """Files arrive in the order of their years; after each year the stream is stopped and then goes on from its checkpoint.

    However many batches the files of a year take, in whatever order, the watermark stays before that year: nothing comes too late.
    """
    root = scratch(spark)
    arrived = f"{root}/arrived"
    dated = conditions.withColumn("_year", F.coalesce(F.year("condition_start_date"), F.lit(9999)))
    dated.write.partitionBy("_year").parquet(f"{root}/years")
    years = spark.read.schema(dated.schema).parquet(f"{root}/years")

    def follow() -> None:
        stream = spark.readStream.schema(conditions.schema).option("maxFilesPerTrigger", 64).parquet(arrived)
        eras = streamed_condition_eras(stream, "400 days").writeStream.format("parquet").outputMode("append")
        eras.option("path", f"{root}/eras").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()

    conditions.limit(0).write.parquet(arrived)
    for (year,) in sorted(years.select("_year").distinct().collect()):
        years.filter(F.col("_year") == year).drop("_year").write.mode("append").parquet(arrived)
        follow()
    mark = spark.range(1).select(*(F.to_date(F.lit(MARK)).alias(f.name) if f.name == "condition_start_date" else F.lit(None).cast(f.dataType).alias(f.name) for f in conditions.schema))
    mark.write.mode("append").parquet(arrived)
    follow()
    return spark.read.parquet(f"{root}/eras")


# Cleaning in buckets of persons

STEPS["med1"] = f"SELECT DISTINCT * FROM ({_NULLED.format(t='(' + _ALIVE.format(t='medication_ingredient', c='start_date') + ')', k='known1')}) AS x3"
STEPS["lab1"] = f"SELECT DISTINCT * FROM ({_ALIVE.format(t='lab_result', c='date')}) AS x4"
STEPS["vit1"] = f"SELECT DISTINCT * FROM ({_ALIVE.format(t='vitals_signs', c='date')}) AS x5"
STEPS["visits1"] = "SELECT person_id, encounter_id, row_number() OVER (ORDER BY person_id, encounter_id) AS visit_occurrence_id FROM (SELECT DISTINCT person_id, encounter_id FROM enc1 WHERE encounter_id IS NOT NULL)"
_WITH_VISIT = "SELECT {n} AS \"table\", t.person_id, visit_occurrence_id, CAST({d} AS DATE) AS date, {e} AS end_date FROM {t} t LEFT JOIN visits1 v ON v.person_id = t.person_id AND v.encounter_id = t.encounter_id"
_CLEANED = [_WITH_VISIT.format(n="'encounter'", d="start_date", e="end_date", t=f"({_CUT.format(e='enc2')})")]
_CLEANED += [_WITH_VISIT.format(n=quoted(n), d=d, e="NULL", t=t) for n, d, t in (("diagnosis", "date", "dia1"), ("procedure", "date", "pro1"), ("medication_ingredient", "start_date", "med1"))]
_CLEANED += [f"SELECT {quoted(n)}, person_id, NULL, date, NULL FROM {t}" for n, t in (("lab_result", "lab1"), ("vitals_signs", "vit1"))]
_CLEANED += ["SELECT 'patient', person_id, NULL, NULL, NULL FROM (SELECT DISTINCT * FROM patient WHERE year_of_birth IS NOT NULL)"]


def cleaned_in_buckets(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """clean_tables() and visit ids over tables in buckets of person_id: only the buckets themselves and the numbering of visits shuffle."""
    clean = cleaning.clean_tables({n: bucketed(t, "person_id") for n, t in tables.items()})
    visits = bucketed(keys.visit_map(clean["encounter"]), "person_id")
    return {n: keys.add_visit_ids(t, visits) if n in cleaning.TABLE_DATES else t for n, t in clean.items()}


@query("person_buckets", " UNION ALL ".join(_CLEANED), "patient", "encounter", *CODED)
def _(spark, *parts):
    """All tables of persons, cleaned and with visit ids."""
    with by_one_key(spark):
        clean = cleaned_in_buckets(dict(zip(["patient", "encounter", *CODED], parts, strict=True)))
        rows = []
        for n, t in clean.items():
            none = F.lit(None).cast("date")
            visit = F.col("visit_occurrence_id") if n != "patient" else F.lit(None).cast("long")
            date = F.col(cleaning.TABLE_DATES[n]) if n != "patient" else none
            rows.append(settled(t.select(F.lit(n).alias("table"), "person_id", visit.alias("visit_occurrence_id"), date.alias("date"), (F.col("end_date") if n == "encounter" else none).alias("end_date"))))
    return reduce(DataFrame.unionByName, rows)


# Kept up to date

_CLEAN_ROWS = [f"SELECT 'encounter' AS \"table\", person_id, encounter_id, CAST(start_date AS DATE) AS date, end_date FROM ({_CUT.format(e='enc2')}) AS e"]
_CLEAN_ROWS += [f"SELECT {quoted(n)}, person_id, {e}, CAST({d} AS DATE), NULL FROM {t}" for n, d, t, e in (("diagnosis", "date", "dia1", "encounter_id"), ("procedure", "date", "pro1", "encounter_id"), ("medication_ingredient", "start_date", "med1", "encounter_id"), ("lab_result", "date", "lab1", "NULL"), ("vitals_signs", "date", "vit1", "NULL"))]
_CLEAN_ROWS += ["SELECT 'patient', person_id, NULL, NULL, NULL FROM (SELECT DISTINCT * FROM patient WHERE year_of_birth IS NOT NULL) AS p"]


def before_the_change(df: DataFrame, date: str | None) -> DataFrame:
    """A table as it was: some persons weren't there yet, others have gone since, and dates of others were later changed."""
    rows = df.filter("person_id % 10 <> 4")
    gone = rows.filter("person_id % 10 = 5").withColumn("person_id", -F.col("person_id"))
    old = rows.withColumn(date, F.when(F.col("person_id") % 10 == 3, F.date_add(date, 7)).otherwise(F.col(date))) if date else rows
    return old.unionByName(gone)


@query("changed_persons", " UNION ALL ".join(_CLEAN_ROWS), "patient", "encounter", *CODED)
def _(spark, *parts):
    """Clean tables that were made before the sources changed, and then brought up to date."""
    root, names = scratch(spark), ["patient", "encounter", *CODED]
    tables = dict(zip(names, parts, strict=True))
    for version in ({n: before_the_change(t, cleaning.TABLE_DATES.get(n)) for n, t in tables.items()}, tables):
        refresh_clean(version, root, 32)
    rows = []
    for n in names:
        t, none = spark.read.parquet(f"{root}/{n}"), F.lit(None)
        encounter = F.col("encounter_id") if "encounter_id" in t.columns else none.cast("string")
        date = F.col(cleaning.TABLE_DATES[n]) if n in cleaning.TABLE_DATES else none.cast("date")
        rows.append(t.select(F.lit(n).alias("table"), "person_id", encounter.alias("encounter_id"), date.alias("date"), (F.col("end_date") if n == "encounter" else none.cast("date")).alias("end_date")))
    return reduce(DataFrame.unionByName, rows)


# Vocabulary and keys

@query("vocabulary_parts", "SELECT concept_id, vocabulary_id, concept_code, standard_concept, src_rank FROM concepts WHERE vocabulary_id IN (SELECT vocabulary_id FROM named_codes WHERE source_table IN ('diagnosis', 'procedure'))", "concepts", "diagnosis", "procedure")
def _(spark, concepts, diagnosis, procedure):
    """Concepts of the vocabularies that diagnoses and procedures name."""
    named = settled(vocabulary.attach_vocabulary(vocabulary.collect_codes({"diagnosis": diagnosis, "procedure": procedure})))
    parts = vocabulary.vocabulary_parts(concepts, scratch(spark))
    return vocabulary.named_parts(parts, named).select("concept_id", "vocabulary_id", "concept_code", "standard_concept", "src_rank")


INPUTS["order_keys"] = "SELECT CASE WHEN o_orderkey % 101 <> 0 THEN o_orderkey END AS order_id FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 97 = 0"


@query("ordered_keys", "SELECT 'condition_occurrence' AS \"table\", count(*) AS rows, 0 AS n_bad FROM conditions UNION ALL SELECT 'orders', count(*), count(*) - count(DISTINCT order_id) - CASE WHEN count(*) > count(order_id) THEN 1 ELSE 0 END FROM order_keys", "conditions", "order_keys")
def _(spark, conditions, orders):
    """Keys of a table that record_ids() numbered, and of one with repeated and null keys whose order two writers broke."""
    root = scratch(spark)
    named = keys.record_ids(conditions, "condition_occurrence_id", ["person_id", "condition_start_date", "condition_concept_id"])
    writers.write_table(named, root, "condition_occurrence")
    late = F.coalesce(F.col("order_id") % 89 == 0, F.lit(False))
    for part in (orders.filter(~late), orders.filter(late)):
        part.repartitionByRange("order_id").sortWithinPartitions("order_id").write.mode("append").parquet(f"{root}/orders")
    found = []
    for name, key in (("condition_occurrence", "condition_occurrence_id"), ("orders", "order_id")):
        table = spark.read.parquet(f"{root}/{name}")
        both = table.agg(F.count("*").alias("rows"), F.lit(None).cast("long").alias("n")).unionByName(uniqueness.repeated_keys(table, key), allowMissingColumns=True)
        found.append(both.agg(F.max("rows").alias("rows"), F.max("n").alias("n_bad")).select(F.lit(name).alias("table"), "rows", "n_bad"))
    return reduce(DataFrame.unionByName, found)


# Counts and sketches

INPUTS["remarks"] = "SELECT CASE WHEN l_partkey % 4 = 0 THEN 'often ' || CAST(l_suppkey % 37 AS STRING) WHEN l_partkey % 4 = 1 THEN '' WHEN l_partkey % 4 = 2 THEN 'once ' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS remark FROM lineitem"


@query("heavy_values", "SELECT remark, count(*) AS rows FROM remarks WHERE remark <> '' GROUP BY remark ORDER BY rows DESC, remark LIMIT 30", "remarks")
def _(spark, remarks):
    return coverage.heavy_values(remarks, "remark")


@query("written_counts", " UNION ALL ".join(f"SELECT {quoted(n)} AS \"table\", count(*) AS rows FROM {n}" for n in ("patient", "encounter", *CODED)), "patient", "encounter", *CODED)
def _(spark, *parts):
    root = scratch(spark)
    found = [(n, writers.write_counted(t, root, n)[1]) for n, t in zip(("patient", "encounter", *CODED), parts, strict=True)]
    return spark.createDataFrame(found, '"table" string, rows long'.replace('"', "`"))


_IDS = "(" + " UNION ALL ".join(f"SELECT {quoted(c)} AS \"column\", {c} AS id FROM used WHERE {c} <> 0" for c in ("condition_concept_id", "condition_source_concept_id", "condition_status_concept_id")) + ")"


@query("concept_bitmaps", f"SELECT \"column\", count(DISTINCT id) AS n_ids, count(DISTINCT CASE WHEN c.concept_id IS NOT NULL THEN id END) AS n_known, count(DISTINCT CASE WHEN standard_concept = 'S' THEN id END) AS n_standard FROM {_IDS} AS u LEFT JOIN catalog c ON c.concept_id = u.id GROUP BY \"column\"", "used", "catalog")
def _(spark, used, catalog):
    return quality.concept_counts(used, catalog)


# Whole tables

INPUTS["all_map"] = "SELECT CASE c_custkey % 3 WHEN 0 THEN 'gender' WHEN 1 THEN 'race' ELSE 'route' END AS map, CASE WHEN c_custkey % 50 = 0 THEN 'M' ELSE 'X' END || CASE WHEN c_custkey % 50 = 0 AND c_custkey < 51 THEN '' ELSE CAST(c_custkey AS STRING) END AS key, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS STRING) END AS value FROM customer"


@query("all_mapping_overrides", f"SELECT * FROM ({values(_BUNDLED, 'map, key, value')}) AS b WHERE NOT EXISTS (SELECT 1 FROM all_map o WHERE o.map = b.map AND o.key = b.key) UNION ALL SELECT * FROM all_map", "all_map")
def _(spark, own):
    return readers.mapping_overrides(spark.createDataFrame(_BUNDLED, "map string, key string, value string"), own)


@query("all_sources_union", "SELECT patient_id, CASE WHEN _source_id <> 's1' THEN sex END AS sex, CASE WHEN _source_id <> 's0' THEN race END AS race FROM patient", "patient")
def _(spark, patient):
    parts = [patient.filter(f"_source_id = 's{i}'").select(*c) for i, c in enumerate((["patient_id", "sex", "ethnicity"], ["race", "patient_id"], ["race", "sex", "patient_id"]))]
    return readers.union_sources(parts, ["patient_id", "sex", "race"])


_ALL_DATED = {"visit_occurrence": ("encounter", "start_date", "end_date"), "condition_occurrence": ("conditions", "condition_start_date", "condition_end_date"), "procedure_occurrence": ("procedure", "date", None), "drug_exposure": ("exposures", "drug_exposure_start_date", "drug_exposure_end_date"), "measurement": ("lab_result", "date", None), "observation": ("vitals_signs", "date", None), "device_exposure": ("diagnosis", "date", None)}
_ALL_SPANS = " UNION ALL ".join(f"SELECT person_id, least({a}, {b or a}) AS s, greatest({a}, {b or a}) AS e FROM {t}" for t, a, b in _ALL_DATED.values())


@query("all_observation_periods", f"SELECT person_id AS observation_period_id, person_id, min(s) AS observation_period_start_date, max(e) AS observation_period_end_date, CAST(32817 AS BIGINT) AS period_type_concept_id FROM ({_ALL_SPANS}) AS x GROUP BY person_id HAVING min(s) IS NOT NULL", *(t for t, _, _ in _ALL_DATED.values()))
def _(spark, *parts):
    """All seven tables that have dates of persons."""
    tables = {}
    for (name, (_, a, b)), df in zip(_ALL_DATED.items(), parts, strict=True):
        dates = schemas.PERIOD_DATES[name]
        tables[name] = df.select("person_id", F.col(a).alias(dates[0]), *([F.col(b or a).alias(dates[1])] if len(dates) > 1 else []))
    return intervals.observation_period(tables)


_GONE = f"SELECT concept_id FROM ({_REFERENCED}) AS r WHERE concept_id NOT IN (SELECT CAST(concept_id AS BIGINT) FROM concepts)"


@query("all_missing_concepts", f"SELECT count(*) AS n_missing, coalesce((SELECT list(CAST(concept_id AS VARCHAR) ORDER BY concept_id) FROM (SELECT concept_id FROM ({_GONE}) AS g2 ORDER BY concept_id LIMIT 20)), []) AS examples FROM ({_GONE}) AS g", "concepts", "conditions", "exposures")
def _(spark, concepts, conditions, exposures):
    """Against both concept files."""
    found = vocabulary.missing_concepts(vocabulary.referenced_concepts([conditions, exposures]), concepts)
    return found.withColumn("examples", F.transform("examples", lambda x: x.cast("string")))


_PRESENT = {"person": "patient", "visit_occurrence": "encounter", "condition_occurrence": "conditions", "drug_exposure": "exposures"}


@query("tables_and_rows", "SELECT t.n AS \"table\", t.n NOT IN ('person', 'visit_occurrence', 'condition_occurrence', 'drug_exposure') AS missing, coalesce(c.rows, 0) AS rows FROM (" + values([(n,) for n in schemas.TARGET], "n") + ") AS t LEFT JOIN (" + " UNION ALL ".join(f"SELECT {quoted(n)} AS n, count(*) AS rows FROM {t}" for n, t in _PRESENT.items()) + ") AS c USING (n)", *_PRESENT.values())
def _(spark, *parts):
    """Which tables there are, with their rows; those that are missing are written empty."""
    there = dict(zip(_PRESENT, parts, strict=True))
    gone = quality.check_tables_present(spark, list(there), list(schemas.TARGET)).select("table", F.lit(True).alias("missing"))
    empty = {n: writers.empty_table(spark, schemas.TARGET[n]) for n in schemas.TARGET if n not in there}
    return quality.table_counts(there | empty).join(gone, "table", "left").select("table", F.coalesce("missing", F.lit(False)).alias("missing"), "rows")


@query("schema_and_rows", "SELECT k AS error_type, c AS \"column\", filled FROM (SELECT 'EXTRA_COLUMNS' AS k, 'diagnosis_code' AS c, count(condition_concept_id) AS filled FROM conditions UNION ALL SELECT 'TYPE_MISMATCH', 'condition_start_date', count(condition_start_date) FROM conditions UNION ALL SELECT 'MISSING_COLUMNS', x.c, 0 FROM (" + values([(f.name,) for f in schemas.TARGET["condition_occurrence"] if f.name not in ("person_id", "condition_concept_id", "condition_start_date", "condition_end_date")], "c") + ") AS x) AS y", "conditions")
def _(spark, conditions):
    """Faults of a table's schema, each with the rows that fill its column."""
    table = conditions.withColumns({"diagnosis_code": F.col("condition_concept_id"), "condition_start_date": F.col("condition_start_date").cast("string")})
    faults = quality.check_schema(table, "condition_occurrence", schemas.TARGET["condition_occurrence"], spark).select("error_type", "column")
    filled = table.agg(*(F.count(c).alias(c) for c in table.columns)).unpivot([], table.columns, "column", "filled")
    return faults.join(filled, "column", "left").select("error_type", "column", F.coalesce("filled", F.lit(0)).alias("filled"))


# Outcomes of checks

_CHECKED = {"person": QUERIES["person"][1], "death": QUERIES["death"][1], "condition_occurrence": "SELECT * FROM used", "concept": "SELECT * FROM catalog"}
_USED = ["person_id", "condition_concept_id", "condition_source_concept_id", "condition_status_concept_id"]
_CATALOG = ["concept_id", "domain_id", "concept_class_id", "standard_concept"]


def _issue_counts() -> list[str]:
    """SELECT of check, table and number of issues for each check of the tables."""
    out = []
    for name, sql in _CHECKED.items():
        schema, main = schemas.TARGET[name], schemas.MAIN_CONCEPT.get(name)
        names = [f.name for f in schema]
        has = {"condition_occurrence": _USED, "concept": _CATALOG}.get(name, names)
        add = lambda check, n, name=name, sql=sql: out.append(f"SELECT '{check}' AS c, '{name}' AS t, {n} AS n FROM ({sql}) AS x")
        out.append(f"SELECT 'schema', '{name}', {len(set(names) - set(has))}")
        add("required", " + ".join(f"CAST(count(*) > count({c}) AS INT)" for c in schemas.required(schema) if c in has))
        if (key := schemas.primary_key(schema)) in has:
            add("primary_key", f"CAST(count(*) > count(DISTINCT {key}) + CAST(count(*) > count({key}) AS INT) AS INT)")
        if name not in ("person", "concept"):
            add("person_refs", f"CAST(count(*) FILTER (person_id IS NULL OR person_id NOT IN (SELECT person_id FROM ({_CHECKED['person']}) AS p)) > 0 AS INT)")
        if name == "concept":
            continue
        columns = [c for c in has if c.endswith("_concept_id")]
        bad = lambda c, w: f"CAST(count(*) FILTER ({c} <> 0 AND {c} {w}) > 0 AS INT)"
        add("concepts_exist", " + ".join(bad(c, "NOT IN (SELECT concept_id FROM catalog)") for c in columns))
        add("standard", " + ".join(bad(c, "IN (SELECT concept_id FROM catalog WHERE standard_concept IS NULL)") for c in columns if not c.endswith("_source_concept_id")))
        if main:
            add("event_zero", f"CAST(count(*) FILTER (coalesce({main}, 0) = 0) > 0 AS INT)")
            add("event_domain", bad(main, f"IN (SELECT concept_id FROM catalog WHERE coalesce(domain_id, '') <> {quoted(quality.SUPPORTED[name])})"))
    return out


_ROWS = " UNION ALL ".join(f"SELECT {quoted(n)} AS t, count(*) AS rows FROM ({sql}) AS x" for n, sql in _CHECKED.items())
_TABLES = f"SELECT 'tables' AS c, t.n AS t, CASE WHEN t.n IN ({', '.join(map(quoted, _CHECKED))}) THEN 0 ELSE 1 END AS n FROM ({values([(n,) for n in schemas.TARGET], 'n')}) AS t"


@query("check_outcomes", f"SELECT c AS \"check\", t AS \"table\", CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END AS outcome, CAST(n AS BIGINT) AS n_issues, rows FROM ({' UNION ALL '.join([_TABLES, *_issue_counts()])}) AS i LEFT JOIN ({_ROWS}) AS r USING (t) UNION ALL SELECT 'coverage', 'coverage', 'skipped', 0, NULL", "patient", "used", "catalog")
def _(spark, patient, used, catalog):
    """What became of each check over four tables, one of which lacks columns; coverage isn't there."""
    tables = {"person": entities.person(patient), "death": entities.death(patient), "condition_occurrence": used, "concept": catalog}
    tables = {n: settled(t) for n, t in tables.items()}
    return quality.check_outcomes(settled(quality.validate(tables, ordered=True)), tables)
