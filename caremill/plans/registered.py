"""One query for each operator, over inputs derived from the driver's tables, with the SQL that says the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill import schemas
from caremill.functions.values import CONCEPTS, SOURCE_VOCABULARIES, UNIT_CODES, map_value, optional_column, optional_concept, parse_yyyymm, qualified_code
from caremill.operators import cleaning, coverage, entities, events, intervals, keys, quality, vocabulary
from caremill.plans.inputs import INPUTS, load, with_inputs
from caremill.plans.steps import CODED, EXPECTED_SQL, SQL_TYPES, STEPS, death_month, events_of, mapped, percent, quoted, rows_of, select_schema, unique, values
from caremill.scratch import release, scratch, settled
from caremill.sources import readers, writers

QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str | None, *inputs: str):
    """Register a function of (spark, *inputs) with its SQL; the function takes the inputs as DataFrames."""

    def add(fn):
        QUERIES[name] = (lambda spark, sf_dir: fn(spark, *load(spark, sf_dir, *inputs)), sql and with_inputs(sql, STEPS))
        return fn

    return add


def clinical(parts: tuple) -> dict[str, DataFrame]:
    return dict(zip(CODED, parts, strict=True))


# Sources and sinks

_PATIENT = "_source_id, patient_id, sex, race, ethnicity, CAST(year_of_birth AS VARCHAR) AS year_of_birth, month_year_death"


@query("read_source", f"SELECT {_PATIENT} FROM patient", "patient")
def _(spark, patient):
    root = scratch(spark)
    for i in range(3):
        patient.filter(F.col("_source_id") == f"s{i}").drop("_source_id", "person_id").write.option("header", True).csv(f"{root}/s{i}/patient.csv")
    return readers.read_source(spark, root, "patient")


@query("read_unlike_sources", "SELECT _source_id, patient_id, sex, race, CASE WHEN _source_id = 's1' THEN ethnicity END AS ethnicity, CASE WHEN _source_id <> 's0' THEN CAST(year_of_birth AS VARCHAR) END AS year_of_birth FROM patient", "patient")
def _(spark, patient):
    """Sources whose columns differ in order and number."""
    root = scratch(spark)
    for i, columns in enumerate((["patient_id", "sex", "race"], ["race", "ethnicity", "year_of_birth", "sex", "patient_id"], ["year_of_birth", "patient_id", "race", "sex"])):
        patient.filter(F.col("_source_id") == f"s{i}").select(*columns).write.option("header", True).csv(f"{root}/s{i}/patient.csv")
    return readers.read_source(spark, root, "patient")


@query("drop_derived", "SELECT patient_id, sex FROM patient", "patient")
def _(spark, patient):
    return readers.drop_derived(patient.select("patient_id", "sex", F.col("race").alias("race_Derived_By_X"), F.col("ethnicity").alias("DERIVED_BY_Y")))


_RAW = "SELECT CAST(o_orderkey AS STRING) AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'x1' WHEN o_orderkey % 11 = 0 THEN '7.5' ELSE CAST(o_custkey AS STRING) END AS n, CASE WHEN o_orderkey % 5 = 0 THEN '1.5e' ELSE CAST(CAST(o_orderkey % 100 AS DOUBLE) / 4 AS STRING) END AS x, CASE WHEN o_orderkey % 6 = 0 THEN '20231301' WHEN o_orderkey % 13 = 0 THEN '2023010' ELSE '2020' || '0' || CAST(1 + o_orderkey % 9 AS STRING) || '1' || CAST(o_orderkey % 10 AS STRING) END AS d, CASE WHEN o_orderkey % 2 = 0 THEN 'T' ELSE 'F' END AS b FROM orders"
INPUTS["raw"] = _RAW
_TYPES = {"n": "BIGINT", "x": "DECIMAL", "d": "DATE", "b": "BOOLEAN", "id": "VARCHAR"}
_DATE = "CASE WHEN regexp_full_match(d, '[0-9]{8}') THEN CAST(try_strptime(d, '%Y%m%d') AS DATE) END"


@query("apply_types", f"SELECT id, CASE WHEN n NOT LIKE '%.%' THEN TRY_CAST(n AS BIGINT) END AS n, TRY_CAST(x AS DOUBLE) AS x, {_DATE} AS d, b FROM raw", "raw")
def _(spark, raw):
    return readers.apply_types(raw, _TYPES)


@query("parse_dates", f"SELECT id, n, x, {_DATE} AS d, b FROM raw", "raw")
def _(spark, raw):
    return readers.parse_dates(raw, _TYPES)


INPUTS["dictionary"] = "SELECT ' ' || p_brand || ' ' AS c0, CASE WHEN p_size % 9 = 0 THEN '' WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS c1, CASE WHEN p_size > 25 THEN 'DATE' ELSE 'BIGINT ' END AS c2, p_partkey AS c3 FROM part UNION ALL SELECT 'Table', 'Column', 'Data_type', 0 FROM region"
_ROWS = "SELECT trim(c0) AS \"table\", trim(c1) AS \"column\", trim(c2) AS data_type FROM dictionary WHERE coalesce(trim(c0), '') <> '' AND coalesce(trim(c1), '') <> '' AND NOT (lower(trim(c0)) = 'table' AND lower(trim(c1)) = 'column')"


@query("dictionary_rows", _ROWS, "dictionary")
def _(spark, raw):
    return readers.dictionary_rows(raw)


_EVEN, _ODD = (f"(SELECT DISTINCT * FROM ({_ROWS.replace('FROM dictionary WHERE', f'FROM dictionary WHERE {c} AND')}) AS q)" for c in ("c3 % 3 <> 1", "c3 % 3 <> 2"))


@query("dictionary_diff", f"SELECT * FROM (SELECT 'first' AS side, * FROM (SELECT * FROM {_EVEN} AS a EXCEPT SELECT * FROM {_ODD} AS b ORDER BY 1, 2, 3 LIMIT 5)) UNION ALL SELECT * FROM (SELECT 'second' AS side, * FROM (SELECT * FROM {_ODD} AS c EXCEPT SELECT * FROM {_EVEN} AS e ORDER BY 1, 2, 3 LIMIT 5))", "dictionary")
def _(spark, raw):
    part = lambda n: readers.dictionary_rows(raw.filter(f"c3 % 3 <> {n}"))
    return readers.dictionary_diff(part(1), part(2))


@query("union_sources", "SELECT patient_id, CASE WHEN _source_id = 's0' THEN sex END AS sex, CASE WHEN _source_id <> 's0' THEN race END AS race FROM patient WHERE _source_id < 's2'", "patient")
def _(spark, patient):
    one, two = patient.filter("_source_id = 's0'").select("patient_id", "sex", "ethnicity"), patient.filter("_source_id = 's1'").select("race", "patient_id")
    return readers.union_sources([one, two], ["patient_id", "sex", "race", "absent"])


@query("scan_vocabulary", "SELECT concept_id, nullif(concept_name, '') AS concept_name, '\"' || concept_class_id || '\\' AS concept_class_id FROM concepts WHERE concept_name IS NOT NULL", "concepts")
def _(spark, concepts):
    path = scratch(spark)
    named = concepts.filter("concept_name is not null").select("concept_id", "concept_name", F.concat(F.lit('"'), "concept_class_id", F.lit("\\")).alias("concept_class_id"))
    named.write.option("sep", "\t").option("quote", "").option("header", True).option("emptyValue", "").csv(path)
    return readers.scan_vocabulary(spark, path)


_CONCEPT = ", ".join(readers.CONCEPT_COLUMNS)


@query("scan_concepts", f"SELECT {_CONCEPT}, src_rank FROM concepts", "concepts")
def _(spark, concepts):
    return readers.scan_concepts(concepts.filter("src_rank = 0"), concepts.filter("src_rank = 1"))


@query("scan_maps_to", "SELECT * FROM maps", "relationships")
def _(spark, relationships):
    return readers.scan_maps_to(relationships)


@query("vocabulary_version", "SELECT vocabulary_id, (SELECT vocabulary_version FROM vocabularies WHERE vocabulary_id = 'None') AS version FROM vocabularies", "vocabularies")
def _(spark, vocabularies):
    return vocabularies.select("vocabulary_id", F.lit(readers.vocabulary_version(vocabularies)).alias("version"))


_TERMS = "SELECT code_system, code, code_description FROM (SELECT *, row_number() OVER (PARTITION BY code_system, code ORDER BY _source_id, code_description) AS n FROM terminology WHERE code_description IS NOT NULL) WHERE n = 1"


@query("load_terminology", _TERMS, "terminology")
def _(spark, terminology):
    return readers.load_terminology([terminology.filter(f"_source_id = 's{i}'") for i in range(3)])


@query("metadata_values", "SELECT sex AS value FROM patient WHERE sex IS NOT NULL", "patient")
def _(spark, patient):
    return readers.metadata_values(patient, "sex").unionByName(readers.metadata_values(patient, "absent"))


_RELATIONS = "CAST(concept_id_1 AS BIGINT) AS concept_id_1, CAST(concept_id_2 AS BIGINT) AS concept_id_2, relationship_id, DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date, invalid_reason"


@query("typed_vocabulary", f"SELECT {_RELATIONS} FROM relationships", "relationships")
def _(spark, relationships):
    return readers.typed_vocabulary(_as_file(relationships), schemas.VOCABULARY["concept_relationship"])


def _as_file(relationships):
    text = relationships.select(*(F.col(c).cast("string").alias(c) for c in relationships.columns))
    return text.withColumns({"valid_start_date": F.lit("19700101"), "valid_end_date": F.lit("20991231"), "more": F.lit("x")})


@query("export_vocabulary", "SELECT 'concept' AS \"table\", count(DISTINCT concept_id) AS rows FROM concepts UNION ALL SELECT 'concept_relationship', count(*) FROM relationships UNION ALL SELECT 'vocabulary', count(*) FROM vocabularies", "concepts", "relationships", "vocabularies", "terminology")
def _(spark, concepts, relationships, vocabularies, terminology):
    more = vocabularies.withColumns({"vocabulary_name": F.col("vocabulary_id"), "vocabulary_reference": F.lit(None).cast("string"), "vocabulary_concept_id": F.lit("0")})
    return writers.export_vocabulary({"concept": concepts, "concept_relationship": _as_file(relationships), "vocabulary": more}, readers.load_terminology([terminology]), scratch(spark))


_TYPED = "CAST(concept_id AS BIGINT) AS concept_id, coalesce(concept_name, '') AS concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code, DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date, invalid_reason, src_rank"


@query("typed_concepts", f"SELECT {_TYPED} FROM concepts", "concepts")
def _(spark, concepts):
    return readers.typed_concepts(concepts)


_PERIOD = schemas.TARGET["observation_period"]


@query("conform", select_schema(_PERIOD, {"observation_period_id": "person_id", "observation_period_start_date": "start_date", "observation_period_end_date": "end_date", "period_type_concept_id": "1"}, {"person_id"}, "encounter"), "encounter")
def _(spark, encounter):
    named = encounter.withColumnsRenamed({"start_date": "observation_period_start_date", "end_date": "observation_period_end_date"})
    return events.conform(named.withColumns({"period_type_concept_id": F.lit("1"), "observation_period_id": F.col("person_id").cast("string")}), _PERIOD)


@query("empty_table", select_schema(schemas.TARGET["death"], {}, set(), "patient WHERE false"), "patient")
def _(spark, patient):
    return writers.empty_table(spark, schemas.TARGET["death"]).unionByName(patient.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TARGET["death"])).limit(0))


@query("write_table", "SELECT * FROM encounter", "encounter")
def _(spark, encounter):
    return spark.read.parquet(writers.write_table(encounter, scratch(spark), "VISIT"))


@query("write_excluded", "SELECT 'diagnosis' AS source_table, code FROM diagnosis WHERE code IS NULL UNION ALL SELECT 'procedure', code FROM procedure WHERE false", "diagnosis", "procedure")
def _(spark, diagnosis, procedure):
    one, two = writers.write_excluded({"diagnosis": diagnosis.filter("code is null"), "procedure": procedure.limit(0)}, scratch(spark))
    return spark.read.parquet(one).select(F.lit("diagnosis").alias("source_table"), "code").unionByName(spark.read.parquet(two).select(F.lit("procedure").alias("source_table"), "code"))


_COVER = f"SELECT source_table, code_system, outcome, rows, {percent('rows', 'sum(rows) OVER (PARTITION BY source_table)', 2)} AS rows_pct, codes, coalesce({percent('codes', 't.n', 2)}, 0.0) AS codes_pct FROM cover LEFT JOIN (SELECT source_table, count(*) AS n FROM (SELECT DISTINCT source_table, code_system, code FROM parts WHERE code IS NOT NULL) GROUP BY source_table) AS t USING (source_table)"


@query("write_coverage", "SELECT source_table, code_system, outcome, CAST(rows AS VARCHAR) AS rows, CAST(codes AS VARCHAR) AS codes FROM cover WHERE coalesce(code_system, 'x') <> ''", *CODED, "concepts", "relationships")
def _(spark, *parts):
    table = _coverage(spark, *parts).filter("coalesce(code_system, 'x') <> ''")
    return spark.read.option("header", True).csv(writers.write_coverage(table, scratch(spark))).drop("rows_pct", "codes_pct")


_BUNDLED = [(m, k, str(v)) for m, kv in CONCEPTS.items() for k, v in kv.items()]
_OWN = "SELECT 'gender' AS map, CASE c_custkey WHEN 1 THEN 'M' ELSE 'X' || CAST(c_custkey AS STRING) END AS key, CASE WHEN c_custkey <> 3 THEN CAST(c_nationkey AS STRING) END AS value FROM customer WHERE c_custkey < 6"
INPUTS["own_map"] = _OWN


@query("mapping_overrides", f"SELECT * FROM ({values(_BUNDLED, 'map, key, value')}) AS b WHERE NOT EXISTS (SELECT 1 FROM own_map o WHERE o.map = b.map AND o.key = b.key) UNION ALL SELECT * FROM own_map", "own_map")
def _(spark, own):
    return readers.mapping_overrides(spark.createDataFrame(_BUNDLED, "map string, key string, value string"), own)


# Values and projections


@query("map_value", f"SELECT person_id, CAST({mapped('sex', 'gender')} AS BIGINT) AS gender, CAST({mapped('race', 'race')} AS BIGINT) AS race FROM patient", "patient")
def _(spark, patient):
    return patient.select("person_id", map_value(F.col("sex"), CONCEPTS["gender"]).alias("gender"), map_value(F.col("race"), CONCEPTS["race"]).alias("race"))


@query("optional_column", f"SELECT person_id, sex, CAST(NULL AS VARCHAR) AS absent, CAST({mapped('sex', 'gender')} AS BIGINT) AS concept, CAST(0 AS BIGINT) AS absent_concept FROM patient", "patient")
def _(spark, patient):
    return patient.select("person_id", optional_column(patient, "sex").alias("sex"), optional_column(patient, "absent").alias("absent"), optional_concept(patient, "sex", CONCEPTS["gender"]).alias("concept"), optional_concept(patient, "absent", CONCEPTS["gender"]).alias("absent_concept"))


@query("qualified_code", "SELECT person_id, CASE WHEN code_system <> '' THEN code_system || ':' || code ELSE code END AS qualified FROM diagnosis", "diagnosis")
def _(spark, diagnosis):
    return diagnosis.select("person_id", qualified_code(F.col("code_system"), F.col("code")).alias("qualified"))


@query("parse_yyyymm", f"SELECT person_id, {death_month()} AS month FROM patient", "patient")
def _(spark, patient):
    return patient.select("person_id", parse_yyyymm(F.col("month_year_death")).alias("month"))


_PLAIN = {"_start_date": "date", "_source_value": "code"}
_ZERO = {f.name: "0" for f in schemas.EVENT if f.name.endswith("_concept_id") and f.name[0] == "_" and f.name not in ("_concept_id", "_source_concept_id")}


@query("event_projection", select_schema(schemas.EVENT, _ZERO | _PLAIN, {"person_id", "_concept_id", "_source_concept_id"}, "diagnosis_mapped"), *CODED, "concepts", "relationships")
def _(spark, *parts):
    return events.event_projection(_mapped(spark, *parts)["diagnosis"], {"_start_date": F.col("date"), "_source_value": F.col("code")})


def _lookup(spark, *parts):
    *tables, concepts, relationships = parts
    tables = clinical(tables)
    return tables, *vocabulary.build_lookup(concepts, readers.scan_maps_to(relationships), vocabulary.collect_codes(tables), vocabulary.collect_units([tables["lab_result"], tables["vitals_signs"]]))


def _mapped(spark, *parts):
    tables, codes, _ = _lookup(spark, *parts)
    return {t: vocabulary.apply_lookup(df, codes, t)[0] for t, df in tables.items()}


_EVENTS = {"diagnosis": "diagnosis_events", "procedure": "procedure_events", "medication_ingredient": "medication_events", "lab_result": "lab_events", "vitals_signs": "vitals_events"}


def _adapters(units):
    return {"diagnosis": events.diagnosis_events, "procedure": events.procedure_events, "medication_ingredient": events.medication_events, "lab_result": lambda d: events.lab_events(d, units), "vitals_signs": lambda d: events.vitals_events(d, units)}


for _table, _name in _EVENTS.items():

    @query(_name, events_of(_table), *CODED, "concepts", "relationships")
    def _(spark, *parts, table=_table):
        tables, codes, units = _lookup(spark, *parts)
        return _adapters(units)[table](vocabulary.apply_lookup(tables[table], codes, table)[0])


_ALL_EVENTS = {t: f"SELECT e.* FROM ({events_of(t)}) AS e" for t in CODED}


@query("build_from_events", select_schema(_PERIOD, {"observation_period_id": "person_id", "observation_period_start_date": "start_date", "period_type_concept_id": "9"}, {"person_id"}, "encounter"), "encounter")
def _(spark, encounter):
    return events.build_from_events(encounter, _PERIOD, {"observation_period_id": F.col("person_id"), "observation_period_start_date": F.col("start_date"), "period_type_concept_id": F.lit(9)})


for _name, _key, _from in (("build_condition", "condition_occurrence", "diagnosis"), ("build_procedure", "procedure_occurrence", "procedure"), ("build_drug", "drug_exposure", "medication_ingredient"), ("build_measurement", "measurement", "lab_result"), ("build_observation", "observation", "vitals_signs"), ("build_device", "device_exposure", "procedure")):

    @query(_name, rows_of(_key, f"({events_of(_from)}) AS e"), *CODED, "concepts", "relationships")
    def _(spark, *parts, table=_from, key=_key):
        tables, codes, units = _lookup(spark, *parts)
        return events.build_table(_adapters(units)[table](vocabulary.apply_lookup(tables[table], codes, table)[0]), key)


_PERSON = {"person_source_value": "patient_id"} | {f"{t}_concept_id": mapped(s, t) for t, s in (("gender", "sex"), ("race", "race"), ("ethnicity", "ethnicity"))} | {f"{t}_source_value": s for t, s in (("gender", "sex"), ("race", "race"), ("ethnicity", "ethnicity"))} | {f"{t}_source_concept_id": "0" for t in ("gender", "race", "ethnicity")}


@query("person", select_schema(schemas.TARGET["person"], _PERSON, {"person_id", "year_of_birth"}, "patient"), "patient")
def _(spark, patient):
    return entities.person(patient)


@query("death", select_schema(schemas.TARGET["death"], {"death_date": death_month(), "death_type_concept_id": "32817", "cause_concept_id": "0", "cause_source_concept_id": "0"}, {"person_id"}, f"patient WHERE {death_month()} IS NOT NULL"), "patient")
def _(spark, patient):
    return entities.death(patient)


_VISITS = "SELECT person_id, encounter_id, row_number() OVER (ORDER BY person_id, encounter_id) AS visit_occurrence_id FROM (SELECT DISTINCT person_id, encounter_id FROM encounter WHERE person_id IS NOT NULL AND encounter_id IS NOT NULL)"
_VISIT = {"visit_concept_id": mapped("type", "visit_type"), "visit_start_date": "start_date", "visit_end_date": "end_date", "visit_type_concept_id": "32817", "visit_source_value": "encounter_id", "visit_source_concept_id": "0", "admitted_from_concept_id": "0", "discharged_to_concept_id": "0"}


@query("visit", select_schema(schemas.TARGET["visit_occurrence"], _VISIT, {"person_id", "visit_occurrence_id"}, f"encounter LEFT JOIN ({_VISITS}) AS v USING (person_id, encounter_id)"), "encounter")
def _(spark, encounter):
    return entities.visit(keys.add_visit_ids(encounter, keys.visit_map(encounter)))


@query("cdm_source", select_schema(schemas.TARGET["cdm_source"], {"cdm_source_name": "n", "cdm_source_abbreviation": "'EHR'", "cdm_holder": "n", "source_description": "'EHR export. Cohorts: ' || c", "source_release_date": "DATE '1998-06-01'", "cdm_release_date": "DATE '2024-05-01'", "cdm_version": "'v5.4'", "cdm_version_concept_id": "756265", "vocabulary_version": "'v1'"}, set(), "(SELECT string_agg(DISTINCT _source_id, '; ' ORDER BY _source_id) AS n, string_agg(DISTINCT race, '; ' ORDER BY race) AS c FROM patient)"), "patient")
def _(spark, patient):
    details = patient.select(F.col("_source_id").alias("network_name"), F.concat("month_year_death", F.lit("01")).alias("date_created"))
    return entities.cdm_source(details, patient.select(F.col("race").alias("cohort_name")), "2024-05-01", "v1")


@query("attach_vocabulary", "SELECT * FROM named_codes", *CODED)
def _(spark, *parts):
    return vocabulary.attach_vocabulary(vocabulary.collect_codes(clinical(parts)))


# Cleaning

_DEATHS = f"SELECT DISTINCT person_id, {death_month()} AS death_date FROM patient WHERE year_of_birth IS NOT NULL AND {death_month()} IS NOT NULL"
_KNOWN = "(SELECT DISTINCT _source_id, patient_id, encounter_id FROM encounter WHERE encounter_id IS NOT NULL)"


@query("drop_missing_birth_year", "SELECT * FROM patient WHERE year_of_birth IS NOT NULL", "patient")
def _(spark, patient):
    return cleaning.drop_missing_birth_year(patient)


@query("dedupe_rows", "SELECT DISTINCT person_id, code_system, date FROM diagnosis", "diagnosis")
def _(spark, diagnosis):
    return cleaning.dedupe_rows(diagnosis.select("person_id", "code_system", "date"))


@query("death_dates", _DEATHS.replace("year_of_birth IS NOT NULL AND ", ""), "patient")
def _(spark, patient):
    return cleaning.death_dates(patient)


_ALIVE = "SELECT t.* FROM {t} t LEFT JOIN deaths d ON d.person_id = t.person_id WHERE d.death_date IS NULL OR t.{c} < d.death_date"
STEPS["deaths"] = _DEATHS


@query("drop_after_death", _ALIVE.format(t="diagnosis", c="date"), "patient", "diagnosis")
def _(spark, patient, diagnosis):
    return cleaning.drop_after_death(diagnosis, "date", cleaning.death_dates(cleaning.drop_missing_birth_year(patient)))


_NULLED = "SELECT t.* REPLACE (CASE WHEN k.encounter_id IS NOT NULL THEN t.encounter_id END AS encounter_id) FROM {t} t LEFT JOIN {k} AS k ON k._source_id = t._source_id AND k.patient_id = t.patient_id AND k.encounter_id = t.encounter_id"


@query("null_unknown_encounters", _NULLED.format(t="diagnosis", k=_KNOWN), "diagnosis", "encounter")
def _(spark, diagnosis, encounter):
    return cleaning.null_unknown_encounters(diagnosis, encounter)


_BROKEN = "(coalesce(e.end_date < e.start_date, false) OR (e.end_date IS NULL AND coalesce(e.type IN ('IMP', 'ACUTE', 'NONAC'), false)))"
_REPAIR = f"SELECT e.* REPLACE (CASE WHEN {_BROKEN} AND l.a IS NOT NULL THEN l.a ELSE e.start_date END AS start_date, CASE WHEN {_BROKEN} AND l.a IS NOT NULL THEN l.b WHEN {_BROKEN} OR e.end_date IS NULL THEN e.start_date ELSE e.end_date END AS end_date) FROM {{e}} e LEFT JOIN (SELECT person_id, encounter_id, min(date) AS a, max(date) AS b FROM (SELECT person_id, encounter_id, date FROM {{d}} UNION ALL SELECT person_id, encounter_id, date FROM {{p}}) WHERE encounter_id IS NOT NULL AND date IS NOT NULL GROUP BY person_id, encounter_id) AS l ON l.person_id = e.person_id AND l.encounter_id = e.encounter_id"


@query("repair_encounter_dates", _REPAIR.format(e="encounter", d="diagnosis", p="procedure"), "encounter", "diagnosis", "procedure")
def _(spark, encounter, diagnosis, procedure):
    return cleaning.repair_encounter_dates(encounter, [diagnosis, procedure])


_CUT = "SELECT e.* REPLACE (CASE WHEN e.end_date >= d.death_date THEN d.death_date - 1 ELSE e.end_date END AS end_date) FROM {e} e LEFT JOIN deaths d ON d.person_id = e.person_id"


@query("truncate_at_death", _CUT.format(e="encounter"), "encounter", "patient")
def _(spark, encounter, patient):
    return cleaning.truncate_at_death(encounter, cleaning.death_dates(cleaning.drop_missing_birth_year(patient)))


STEPS["enc1"] = _ALIVE.format(t="(SELECT DISTINCT * FROM encounter)", c="start_date")
STEPS["known1"] = "SELECT DISTINCT _source_id, patient_id, encounter_id FROM enc1 WHERE encounter_id IS NOT NULL"
STEPS["dia1"] = f"SELECT DISTINCT * FROM ({_NULLED.format(t='(' + _ALIVE.format(t='diagnosis', c='date') + ')', k='known1')}) AS x1"
STEPS["pro1"] = f"SELECT DISTINCT * FROM ({_NULLED.format(t='(' + _ALIVE.format(t='procedure', c='date') + ')', k='known1')}) AS x2"
STEPS["enc2"] = _REPAIR.format(e="enc1", d="dia1", p="pro1")


@query("clean_tables", f"SELECT 'encounter' AS \"table\", person_id, encounter_id, start_date, end_date FROM ({_CUT.format(e='enc2')}) AS y1 UNION ALL SELECT 'diagnosis', person_id, encounter_id, date, NULL FROM dia1 UNION ALL SELECT 'procedure', person_id, encounter_id, date, NULL FROM pro1 UNION ALL SELECT 'patient', person_id, sex, NULL, NULL FROM (SELECT DISTINCT * FROM patient WHERE year_of_birth IS NOT NULL)", "patient", "encounter", "diagnosis", "procedure")
def _(spark, patient, encounter, diagnosis, procedure):
    out = cleaning.clean_tables({"patient": patient, "encounter": encounter, "diagnosis": diagnosis, "procedure": procedure})
    none = F.lit(None).cast("date")
    parts = [out["encounter"].select(F.lit("encounter").alias("table"), "person_id", "encounter_id", "start_date", "end_date")]
    parts += [out[t].select(F.lit(t).alias("table"), "person_id", "encounter_id", F.col("date").alias("start_date"), none.alias("end_date")) for t in ("diagnosis", "procedure")]
    parts.append(out["patient"].select(F.lit("patient").alias("table"), "person_id", F.col("sex").alias("encounter_id"), none.alias("start_date"), none.alias("end_date")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# Keys

_COUNTED = " UNION ALL ".join(f"SELECT _source_id, patient_id, {c} AS d FROM {t}" for t, c in cleaning.TABLE_DATES.items())
_ROWS_SQL = f"SELECT x._source_id, x.patient_id, count(DISTINCT x.r) AS person_rows, bool_or(coalesce(p.died IS NULL OR x.d < p.died, false)) AS alive FROM (SELECT *, row_number() OVER () AS r FROM ({_COUNTED}) AS u) AS x JOIN (SELECT DISTINCT _source_id, patient_id, {death_month()} AS died FROM patient WHERE year_of_birth IS NOT NULL) AS p ON p._source_id = x._source_id AND p.patient_id = x.patient_id GROUP BY x._source_id, x.patient_id"
STEPS["prows"] = _ROWS_SQL
_ALL = ["patient", "encounter", "diagnosis", "procedure", "medication_ingredient", "lab_result", "vitals_signs"]


@query("person_index", "SELECT _source_id, patient_id, row_number() OVER (ORDER BY _source_id, patient_id) AS person_id, person_rows FROM prows WHERE alive", *_ALL)
def _(spark, *parts):
    return keys.person_index(dict(zip(_ALL, parts, strict=True)))


@query("person_rows", "SELECT * FROM prows", *_ALL)
def _(spark, *parts):
    return keys.person_rows(dict(zip(_ALL, parts, strict=True)))


@query("attach_person_id", "SELECT _source_id, patient_id, code, p.person_id FROM diagnosis JOIN (SELECT _source_id, patient_id, row_number() OVER (ORDER BY _source_id, patient_id) AS person_id FROM prows WHERE alive) AS p USING (_source_id, patient_id)", *_ALL)
def _(spark, *parts):
    tables = dict(zip(_ALL, parts, strict=True))
    return keys.attach_person_id(tables["diagnosis"].select("_source_id", "patient_id", "code"), keys.person_index(tables))


@query("visit_map", _VISITS, "encounter")
def _(spark, encounter):
    return keys.visit_map(encounter)


@query("add_visit_ids", f"SELECT d.person_id, d.encounter_id, d.code, v.visit_occurrence_id FROM diagnosis d LEFT JOIN ({_VISITS}) AS v ON v.person_id = d.person_id AND v.encounter_id = d.encounter_id", "diagnosis", "encounter")
def _(spark, diagnosis, encounter):
    return keys.add_visit_ids(diagnosis.select("person_id", "encounter_id", "code"), keys.visit_map(encounter))


_ORDER = ["person_id", "date", "code", "code_system", "encounter_id"]


@query("record_ids", f"SELECT row_number() OVER (ORDER BY {', '.join(f'{c} NULLS LAST' for c in _ORDER)}) AS id, {', '.join(_ORDER)} FROM diagnosis", "diagnosis")
def _(spark, diagnosis):
    return keys.record_ids(diagnosis.select(F.lit(None).cast("long").alias("id"), *_ORDER), "id", _ORDER)


def _numbered(name: str, source: str) -> str:
    order = keys.order_columns(name)
    columns = ", ".join(f.name for f in schemas.TARGET[name] if f.name != schemas.primary_key(schemas.TARGET[name]))
    return f"SELECT row_number() OVER (ORDER BY {', '.join(f'{c} NULLS LAST' for c in order)}) AS {schemas.primary_key(schemas.TARGET[name])}, {columns} FROM ({source}) AS s"


@query("order_table", _numbered("condition_occurrence", rows_of("condition_occurrence", f"({events_of('diagnosis')}) AS e")), *CODED, "concepts", "relationships")
def _(spark, *parts):
    tables, codes, units = _lookup(spark, *parts)
    return keys.order_table(events.build_table(events.diagnosis_events(vocabulary.apply_lookup(tables["diagnosis"], codes, "diagnosis")[0]), "condition_occurrence"), "condition_occurrence")


# Vocabulary


@query("collect_codes", "SELECT * FROM src_codes", *CODED)
def _(spark, *parts):
    return vocabulary.collect_codes(clinical(parts))


@query("collect_units", "SELECT * FROM src_units", "lab_result", "vitals_signs")
def _(spark, labs, vitals):
    return vocabulary.collect_units([labs, vitals])


@query("unit_lookup_codes", "SELECT * FROM unit_codes", "lab_result", "vitals_signs")
def _(spark, labs, vitals):
    return vocabulary.unit_lookup_codes(vocabulary.collect_units([labs, vitals]))


def _found(spark, *parts):
    *tables, concepts, relationships = parts
    tables = clinical(tables)
    named = settled(vocabulary.attach_vocabulary(vocabulary.collect_codes(tables)))
    units = settled(vocabulary.unit_lookup_codes(vocabulary.collect_units([tables["lab_result"], tables["vitals_signs"]])))
    return named, units, settled(vocabulary.candidate_concepts(concepts, named, units)), concepts, readers.scan_maps_to(relationships)


_VOCABULARY_INPUTS = (*CODED, "concepts", "relationships")


@query("candidate_concepts", "SELECT * FROM candidates", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return _found(spark, *parts)[2]


@query("unique_concepts", f"SELECT * EXCLUDE (src_rank) FROM ({unique('concepts')}) AS u", "concepts")
def _(spark, concepts):
    return vocabulary.unique_concepts(concepts)


@query("first_by_validity", "SELECT * FROM best", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return vocabulary.first_by_validity(_found(spark, *parts)[2], ["vocabulary_id", "concept_code"])


@query("standard_targets", "SELECT * FROM targets", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    _, _, found, concepts, maps = _found(spark, *parts)
    best = vocabulary.first_by_validity(found, ["vocabulary_id", "concept_code"])
    return vocabulary.standard_targets(maps, concepts, best.select(F.col("concept_id").alias("source_concept_id")))


@query("resolve_codes", "SELECT * FROM resolved", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    named, _, found, concepts, maps = _found(spark, *parts)
    best = vocabulary.first_by_validity(found, ["vocabulary_id", "concept_code"])
    return vocabulary.resolve_codes(named, best, vocabulary.standard_targets(maps, concepts, best.select(F.col("concept_id").alias("source_concept_id"))))


@query("resolve_units", "SELECT * FROM resolved_units", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    _, units, found, *_ = _found(spark, *parts)
    return vocabulary.resolve_units(units, vocabulary.first_by_validity(found, ["vocabulary_id", "concept_code"]).filter("vocabulary_id = 'UCUM'"))


@query("build_lookup", "SELECT source_table, code, concept_id FROM resolved UNION ALL SELECT 'unit', units_of_measure, unit_concept_id FROM resolved_units", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    _, codes, units = _lookup(spark, *parts)
    return codes.select("source_table", "code", "concept_id").unionByName(units.select(F.lit("unit").alias("source_table"), F.col("units_of_measure").alias("code"), F.col("unit_concept_id").alias("concept_id")))


@query("missing_unit_overrides", "SELECT DISTINCT override AS concept_code FROM unit_map WHERE override NOT IN (SELECT concept_code FROM concepts WHERE vocabulary_id = 'UCUM' AND standard_concept = 'S')", "concepts")
def _(spark, concepts):
    return vocabulary.missing_unit_overrides(concepts)


_EXCLUDED = "SELECT person_id, code_system, code, _reason AS exclusion_reason, _domain_id AS target_domain_id, _source_concept_id AS source_concept_id, CAST(NULL AS BIGINT) AS concept_id FROM {t}_joined WHERE _reason IS NOT NULL"


@query("apply_lookup", f"{_EXCLUDED.format(t='diagnosis')} UNION ALL SELECT person_id, code_system, code, NULL, _domain_id, _source_concept_id, _concept_id FROM diagnosis_mapped", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    tables, codes, _ = _lookup(spark, *parts)
    good, bad = vocabulary.apply_lookup(tables["diagnosis"], codes, "diagnosis")
    columns = ["person_id", "code_system", "code", "exclusion_reason", "target_domain_id", "source_concept_id", "concept_id"]
    one = good.select("person_id", "code_system", "code", F.lit(None).cast("string").alias("exclusion_reason"), F.col("_domain_id").alias("target_domain_id"), F.col("_source_concept_id").alias("source_concept_id"), F.col("_concept_id").alias("concept_id"))
    return bad.withColumn("concept_id", F.lit(None).cast("long")).select(*columns).unionByName(one)


_ROUTED = " UNION ALL ".join(f"SELECT CASE _domain_id {' '.join(f'WHEN {quoted(d)} THEN {quoted(n)}' for d, n in schemas.DOMAIN_TABLE.items())} END AS \"table\", person_id, _concept_id AS concept_id, {c} AS date FROM {t}_mapped" for t, c in (("diagnosis", "date"), ("procedure", "date"), ("medication_ingredient", "start_date"), ("lab_result", "date"), ("vitals_signs", "date")))


def _routed(spark, *parts):
    tables, codes, units = _lookup(spark, *parts)
    return vocabulary.route_by_domain({t: vocabulary.apply_lookup(df, settled(codes), t)[0] for t, df in tables.items()}, _adapters(settled(units)))


@query("route_by_domain", _ROUTED, *_VOCABULARY_INPUTS)
def _(spark, *parts):
    out = None
    for name, df in _routed(spark, *parts).items():
        one = df.select(F.lit(name).alias("table"), "person_id", F.col(schemas.MAIN_CONCEPT[name]).alias("concept_id"), F.col(schemas.MAIN_DATE[name]).alias("date"))
        out = one if out is None else out.unionByName(one)
    return out


_REFERENCED = "SELECT DISTINCT concept_id FROM (SELECT condition_concept_id AS concept_id FROM conditions UNION SELECT drug_concept_id FROM exposures) WHERE concept_id <> 0"


@query("referenced_concepts", _REFERENCED, "conditions", "exposures")
def _(spark, conditions, exposures):
    return vocabulary.referenced_concepts([conditions, exposures])


_SYSTEMS = "(SELECT DISTINCT vocabulary_id, code_system FROM vocabulary_map WHERE vocabulary_id IS NOT NULL UNION SELECT 'RxNorm Extension', 'RxNorm')"
STEPS["terms"] = _TERMS
STEPS["one_concept"] = f"SELECT CAST(concept_id AS BIGINT) AS concept_id, * EXCLUDE (concept_id, src_rank) FROM ({unique('concepts')}) AS u"
STEPS["descriptions"] = f"SELECT concept_id, code_description FROM (SELECT c.concept_id, t.code_description, row_number() OVER (PARTITION BY c.concept_id ORDER BY t.code_system, t.code_description) AS n FROM one_concept c JOIN {_SYSTEMS} AS s ON s.vocabulary_id = c.vocabulary_id JOIN terms t ON t.code_system = s.code_system AND t.code = c.concept_code WHERE coalesce(c.concept_name, '') = '') WHERE n = 1"
STEPS["built"] = "SELECT concept_id, substr(coalesce(nullif(concept_name, ''), nullif(code_description, ''), concept_code), 1, 255) AS concept_name, domain_id, vocabulary_id, concept_class_id, standard_concept, concept_code, DATE '1970-01-01' AS valid_start_date, DATE '2099-12-31' AS valid_end_date, invalid_reason FROM one_concept LEFT JOIN descriptions USING (concept_id)"


@query("code_descriptions", "SELECT * FROM descriptions", "concepts", "terminology")
def _(spark, concepts, terminology):
    one = vocabulary.unique_concepts(concepts).withColumn("concept_id", F.col("concept_id").cast("long"))
    return vocabulary.code_descriptions(one, readers.load_terminology([terminology]))


@query("build_concepts", "SELECT * FROM built", "concepts", "terminology")
def _(spark, concepts, terminology):
    return vocabulary.build_concepts(concepts, readers.load_terminology([terminology]))


@query("concept_table", f"SELECT * FROM built WHERE concept_id IN ({_REFERENCED})", "concepts", "terminology", "conditions", "exposures")
def _(spark, concepts, terminology, conditions, exposures):
    return vocabulary.concept_table(concepts, vocabulary.referenced_concepts([conditions, exposures]), readers.load_terminology([terminology]))


@query("missing_concepts", f"SELECT count(*) AS n_missing, coalesce((SELECT list(CAST(concept_id AS VARCHAR) ORDER BY concept_id) FROM (SELECT concept_id FROM ({_REFERENCED}) AS r2 WHERE concept_id NOT IN (SELECT CAST(concept_id AS BIGINT) FROM concepts WHERE src_rank = 1) ORDER BY concept_id LIMIT 20)), []) AS examples FROM ({_REFERENCED}) AS r WHERE concept_id NOT IN (SELECT CAST(concept_id AS BIGINT) FROM concepts WHERE src_rank = 1)", "concepts", "conditions", "exposures")
def _(spark, concepts, conditions, exposures):
    return vocabulary.missing_concepts(vocabulary.referenced_concepts([conditions, exposures]), concepts.filter("src_rank = 1")).withColumn("examples", F.transform("examples", lambda x: x.cast("string")))


# Intervals


def islands(source: str, key: str, gap: int, aggregates: str) -> str:
    """Gaps and islands in SQL."""
    return f"SELECT {key}, min(s) AS s, max(e) AS e, {aggregates} FROM (SELECT *, sum(fresh) OVER (PARTITION BY {key} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS era FROM (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY {key} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap} THEN 0 ELSE 1 END AS fresh FROM {source})) GROUP BY {key}, era"


_CONDITION_ERAS = f"SELECT person_id, condition_concept_id, s AS condition_era_start_date, e AS condition_era_end_date, n AS condition_occurrence_count FROM ({islands('(SELECT person_id, condition_concept_id, condition_start_date AS s, greatest(coalesce(condition_end_date, condition_start_date + 1), condition_start_date) AS e FROM conditions WHERE condition_concept_id <> 0)', 'person_id, condition_concept_id', 30, 'count(*) AS n')}) AS c"
_SUB = islands("(SELECT person_id, ingredient_concept_id, drug_exposure_start_date AS s, greatest(coalesce(drug_exposure_end_date, drug_exposure_start_date + CAST(days_supply AS INT), drug_exposure_start_date + 1), drug_exposure_start_date) AS e FROM exposures JOIN pairs USING (drug_concept_id))", "person_id, ingredient_concept_id", 0, "count(*) AS n, max(e) - min(s) AS days")
_DRUG_ERAS = f"SELECT person_id, ingredient_concept_id AS drug_concept_id, s AS drug_era_start_date, e AS drug_era_end_date, CAST(n2 AS BIGINT) AS drug_exposure_count, CAST(e - s - d2 AS BIGINT) AS gap_days FROM ({islands(f'({_SUB})', 'person_id, ingredient_concept_id', 30, 'sum(n) AS n2, sum(days) AS d2')}) AS d"


@query("merge_intervals", f"SELECT person_id, s AS start, e AS \"end\", n FROM ({islands('(SELECT person_id, start_date AS s, coalesce(end_date, start_date) AS e FROM encounter)', 'person_id', 10, 'count(*) AS n')}) AS m", "encounter")
def _(spark, encounter):
    return intervals.merge_intervals(encounter.select("person_id", F.col("start_date").alias("start"), F.coalesce("end_date", "start_date").alias("end")), ["person_id"], 10, [F.count("*").alias("n")])


@query("condition_eras", _CONDITION_ERAS, "conditions")
def _(spark, conditions):
    return intervals.condition_eras(conditions)


@query("drug_eras", _DRUG_ERAS, "exposures", "pairs")
def _(spark, exposures, pairs):
    return intervals.drug_eras(exposures, pairs)


_INGREDIENTS = "(SELECT CAST(concept_id AS BIGINT) AS id FROM concepts WHERE standard_concept = 'S' AND concept_class_id = 'Ingredient' AND vocabulary_id IN ('RxNorm', 'RxNorm Extension'))"
_INGREDIENT_MAP = f"SELECT DISTINCT descendant_concept_id AS drug_concept_id, ancestor_concept_id AS ingredient_concept_id FROM closure WHERE descendant_concept_id IN (SELECT drug_concept_id FROM exposures) AND ancestor_concept_id IN (SELECT id FROM {_INGREDIENTS} AS i1) UNION SELECT drug_concept_id, drug_concept_id FROM exposures WHERE drug_concept_id IN (SELECT id FROM {_INGREDIENTS} AS i2)"


@query("ingredient_map", _INGREDIENT_MAP, "concepts", "closure", "exposures")
def _(spark, concepts, closure, exposures):
    return intervals.ingredient_map(concepts, closure, exposures)


@query("ingredient_coverage", f"SELECT count(*) AS n_rows, count(*) FILTER (drug_concept_id IN (SELECT drug_concept_id FROM ({_INGREDIENT_MAP}) AS q)) AS n_covered FROM exposures", "concepts", "closure", "exposures")
def _(spark, concepts, closure, exposures):
    return intervals.ingredient_coverage(exposures, intervals.ingredient_map(concepts, closure, exposures))


@query("build_eras", f"SELECT 'condition_era' AS \"table\", row_number() OVER (ORDER BY person_id, condition_concept_id, condition_era_start_date) AS era_id, person_id, condition_era_start_date AS start FROM ({_CONDITION_ERAS}) AS c1 UNION ALL SELECT 'drug_era', row_number() OVER (ORDER BY person_id, drug_concept_id, drug_era_start_date), person_id, drug_era_start_date FROM ({_DRUG_ERAS}) AS d1", "conditions", "exposures", "pairs")
def _(spark, conditions, exposures, pairs):
    out = intervals.build_eras(conditions, exposures, pairs)
    one, two = (out[n].select(F.lit(n).alias("table"), F.col(f"{n}_id").alias("era_id"), "person_id", F.col(f"{n}_start_date").alias("start")) for n in ("condition_era", "drug_era"))
    return one.unionByName(two)


@query("observation_period", "SELECT person_id AS observation_period_id, person_id, min(s) AS observation_period_start_date, max(e) AS observation_period_end_date, CAST(32817 AS BIGINT) AS period_type_concept_id FROM (SELECT person_id, least(start_date, end_date) AS s, greatest(start_date, end_date) AS e FROM encounter UNION ALL SELECT person_id, least(condition_start_date, condition_end_date), greatest(condition_start_date, condition_end_date) FROM conditions UNION ALL SELECT person_id, date, date FROM lab_result) GROUP BY person_id HAVING min(s) IS NOT NULL", "encounter", "conditions", "lab_result")
def _(spark, encounter, conditions, labs):
    visits = encounter.withColumnsRenamed({"start_date": "visit_start_date", "end_date": "visit_end_date"})
    return intervals.observation_period({"visit_occurrence": visits, "condition_occurrence": conditions, "measurement": labs.withColumnRenamed("date", "measurement_date")})


# Coverage


def _parts(spark, *parts):
    tables, codes, _ = _lookup(spark, *parts)
    codes, out = settled(codes), None
    for t, df in tables.items():
        one = coverage.record_coverage(df, t, codes)
        out = one if out is None else out.unionByName(one)
    return out


def _coverage(spark, *parts):
    return coverage.coverage(_parts(spark, *parts))


@query("record_coverage", "SELECT * FROM parts", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return _parts(spark, *parts)


QUERIES["coverage"] = (lambda spark, sf_dir: _coverage(spark, *load(spark, sf_dir, *_VOCABULARY_INPUTS)), with_inputs(_COVER, STEPS))


@query("coverage_by_outcome", "SELECT source_table, outcome, CAST(sum(rows) AS BIGINT) AS rows FROM cover GROUP BY source_table, outcome", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.coverage_by_outcome(_coverage(spark, *parts))


_TARGETS = ", ".join(map(quoted, schemas.DOMAIN_TABLE.values()))


@query("excluded_by_table", f"SELECT source_table, CAST(sum(rows) AS BIGINT) AS rows FROM cover WHERE outcome NOT IN ({_TARGETS}) GROUP BY source_table", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.excluded_by_table(_coverage(spark, *parts))


@query("source_code_counts", "SELECT * FROM code_counts", *CODED)
def _(spark, *parts):
    return coverage.source_code_counts(clinical(parts))


@query("source_unit_counts", "SELECT * FROM unit_counts", "lab_result", "vitals_signs")
def _(spark, labs, vitals):
    return coverage.source_unit_counts({"lab_result": labs, "vitals_signs": vitals})


@query("source_text_counts", "SELECT * FROM text_counts", "lab_result")
def _(spark, labs):
    return coverage.source_text_counts(labs)


@query("code_system_pairs", "SELECT source_table, code_system, vocabulary_id, known, CAST(sum(rows) AS BIGINT) AS rows, count(*) AS distinct_codes FROM known_counts GROUP BY source_table, code_system, vocabulary_id, known", *CODED)
def _(spark, *parts):
    return coverage.code_system_pairs(coverage.source_code_counts(clinical(parts)))


@query("vocabulary_availability", "SELECT w.vocabulary_id, w.vocabulary_id IN (SELECT vocabulary_id FROM vocabularies) AS available, count(c.concept_id) AS concepts, count(*) FILTER (c.concept_id IS NOT NULL AND coalesce(c.concept_name, '') = '') AS empty_names FROM (SELECT DISTINCT vocabulary_id FROM vocabulary_map WHERE vocabulary_id IS NOT NULL UNION VALUES ('RxNorm Extension'), ('UCUM')) AS w LEFT JOIN concepts c ON c.vocabulary_id = w.vocabulary_id GROUP BY w.vocabulary_id", "vocabularies", "concepts")
def _(spark, vocabularies, concepts):
    return coverage.vocabulary_availability(vocabularies, concepts)


@query("code_summary", "SELECT * FROM summary", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.code_summary(_lookup(spark, *parts)[1])


@query("source_concepts", "SELECT * FROM source_rows", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.source_concepts(parts[-2], coverage.code_summary(_lookup(spark, *parts)[1]).filter("source_concept_id > 0"))


def _mapped_codes(spark, *parts):
    tables, codes, units = _lookup(spark, *parts)
    return settled(coverage.mapped_codes(coverage.source_code_counts(tables), settled(codes), parts[-2]))


@query("mapped_codes", "SELECT * FROM mapped_codes", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return _mapped_codes(spark, *parts)


@query("self_mapping", "SELECT count(*) AS n_standard, count(*) FILTER (own) AS n_with, count(*) FILTER (NOT own) AS n_without, (SELECT coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id), '') FROM (SELECT source_concept_id AS id FROM source_rows WHERE source_standard AND source_concept_id NOT IN (SELECT concept_id_1 FROM maps WHERE concept_id_1 = concept_id_2) ORDER BY 1 LIMIT 20)) AS examples FROM (SELECT source_concept_id IN (SELECT concept_id_1 FROM maps WHERE concept_id_1 = concept_id_2) AS own FROM source_rows WHERE source_standard)", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    found = settled(coverage.source_concepts(parts[-2], coverage.code_summary(_lookup(spark, *parts)[1]).filter("source_concept_id > 0")))
    return coverage.self_mapping(found, readers.scan_maps_to(parts[-1]))


@query("coverage_by_code", f"SELECT source_table, code_system, codes, codes_src, {percent('codes_src', 'codes')} AS src_pct, codes_src_invalid, codes_std, {percent('codes_std', 'codes')} AS std_pct, codes_multi, codes_off_domain FROM by_code", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.coverage_by_code(_mapped_codes(spark, *parts))


@query("coverage_by_row", f"SELECT source_table, code_system, rows, rows_src, {percent('rows_src', 'rows')} AS src_pct, rows_src_invalid, rows_std, {percent('rows_std', 'rows')} AS std_pct, rows_multi, extra_rows, rows_off_domain, {percent('rows_off_domain', 'rows')} AS off_domain_pct FROM by_code", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.coverage_by_row(_mapped_codes(spark, *parts))


@query("coverage_totals", f"SELECT source_table, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(rows_std) AS BIGINT) AS rows_std, CAST(sum(rows_off_domain) AS BIGINT) AS rows_off_domain, CAST(sum(extra_rows) AS BIGINT) AS extra_rows, {percent('sum(rows_std)', 'sum(rows)')} AS std_pct FROM by_code GROUP BY source_table", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.coverage_totals(_mapped_codes(spark, *parts))


@query("target_domains", f"SELECT r.source_table, r.code_system, {EXPECTED_SQL.replace('source_table', 'r.source_table')} AS expected_domain, r.domain_id, count(DISTINCT r.code) AS codes, CAST(sum(c.rows) AS BIGINT) AS rows FROM resolved r JOIN code_counts c ON c.source_table = r.source_table AND c.code_system = r.code_system AND c.code = r.code WHERE r.domain_id IS NOT NULL GROUP BY ALL", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    tables, codes, _ = _lookup(spark, *parts)
    return coverage.target_domains(codes, coverage.source_code_counts(tables))


@query("top_multi_target", "SELECT source_table, code_system, code, source_concept_name, n_targets, rows FROM mapped_codes WHERE n_targets > 1 ORDER BY rows DESC, source_table, code_system, code LIMIT 15", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.top_multi_target(_mapped_codes(spark, *parts))


@query("unmapped_by_reason", "SELECT source_table, reason, count(*) AS codes, CAST(sum(rows) AS BIGINT) AS rows FROM unmapped GROUP BY source_table, reason", *_VOCABULARY_INPUTS, "vocabularies")
def _(spark, *parts):
    return coverage.unmapped_by_reason(_mapped_codes(spark, *parts[:-1]), parts[-1])


@query("top_unmapped", "SELECT source_table, CAST(nth AS INT) AS nth, code_system, code, rows, reason, source_concept_id, source_concept_name FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY rows DESC, code_system NULLS LAST, code NULLS LAST) AS nth FROM unmapped) WHERE nth <= 20", *_VOCABULARY_INPUTS, "vocabularies")
def _(spark, *parts):
    return coverage.top_unmapped(_mapped_codes(spark, *parts[:-1]), parts[-1])


def _units(spark, *parts):
    tables, _, units = _lookup(spark, *parts)
    return coverage.marked_units(coverage.source_unit_counts({t: tables[t] for t in ("lab_result", "vitals_signs")}), units)


@query("unit_summary", f"SELECT *, {percent('rows_ucum', 'rows')} AS ucum_pct FROM (SELECT source_table, count(*) AS distinct_units, count(*) FILTER (empty) AS distinct_empty, count(*) FILTER (ucum) AS distinct_ucum, CAST(sum(rows) AS BIGINT) AS rows, CAST(coalesce(sum(rows) FILTER (empty), 0) AS BIGINT) AS rows_empty, CAST(coalesce(sum(rows) FILTER (ucum), 0) AS BIGINT) AS rows_ucum FROM marked GROUP BY source_table)", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    return coverage.unit_summary(_units(spark, *parts))


_TOP = "SELECT {l} AS list, * FROM (SELECT units_of_measure, ucum, CAST(sum(rows) AS BIGINT) AS rows FROM marked {w} GROUP BY units_of_measure, ucum ORDER BY rows DESC, units_of_measure LIMIT 30)"


@query("top_units", f"SELECT * FROM ({_TOP.format(l=quoted('all'), w='')}) AS t1 UNION ALL SELECT * FROM ({_TOP.format(l=quoted('unmatched'), w='WHERE NOT ucum AND NOT empty')}) AS t2", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    units = settled(_units(spark, *parts))
    one, two = (coverage.top_units(units, x).select(F.lit(n).alias("list"), "*") for n, x in (("all", False), ("unmatched", True)))
    return one.unionByName(two)


@query("top_text_values", "SELECT lab_result_text_val, rows, (SELECT CAST(sum(rows) AS BIGINT) FROM text_counts) AS all_rows, (SELECT CAST(sum(rows) AS BIGINT) FROM text_counts WHERE lab_result_text_val <> '') AS text_rows, (SELECT count(*) FROM text_counts WHERE lab_result_text_val <> '') AS distinct_texts FROM text_counts WHERE lab_result_text_val <> '' ORDER BY rows DESC, lab_result_text_val LIMIT 30", "lab_result")
def _(spark, labs):
    return coverage.top_text_values(coverage.source_text_counts(labs))


# Checks


def issue(check: str, table: str, kind: str, column: str, n: str, examples: str, source: str) -> str:
    return f"SELECT {quoted(check)} AS \"check\", {quoted(table)} AS \"table\", {quoted(kind)} AS error_type, CAST({column} AS VARCHAR) AS \"column\", CAST({n} AS BIGINT) AS n_bad, CAST({examples} AS VARCHAR[]) AS examples, false AS skipped FROM {source}"


_FIVE = "list_transform(list_slice(list(concept_id ORDER BY concept_id), 1, 5), lambda x: CAST(x AS VARCHAR))"
INPUTS["catalog"] = "SELECT p_partkey AS concept_id, CASE p_partkey % 3 WHEN 0 THEN 'Condition' WHEN 1 THEN 'Drug' END AS domain_id, CASE WHEN p_size % 2 = 0 THEN 'Ingredient' ELSE p_type END AS concept_class_id, CASE WHEN p_size > 15 THEN 'S' END AS standard_concept FROM part WHERE p_partkey % 6 <> 5"
INPUTS["used"] = "SELECT o_custkey AS person_id, l_partkey % 20 AS condition_concept_id, l_partkey AS condition_source_concept_id, CASE WHEN l_linenumber > 2 THEN l_partkey % 30 END AS condition_status_concept_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_LISTED = "(SELECT DISTINCT c, id FROM (" + " UNION ALL ".join(f"SELECT {quoted(c)} AS c, {c} AS id FROM used" for c in ("condition_concept_id", "condition_source_concept_id", "condition_status_concept_id")) + ") WHERE id <> 0)"
_PER = "(SELECT c, count(*) AS n, list_transform(list_slice(list(id ORDER BY id), 1, 5), lambda x: CAST(x AS VARCHAR)) AS e FROM {s} AS l WHERE {w} GROUP BY c)"


@query("check_schema", "SELECT 'schema' AS \"check\", 'death' AS \"table\", t.k AS error_type, t.c AS \"column\", CAST(NULL AS BIGINT) AS n_bad, CAST(NULL AS VARCHAR[]) AS examples, false AS skipped FROM (VALUES ('MISSING_COLUMNS', 'cause_source_value'), ('EXTRA_COLUMNS', 'more'), ('TYPE_MISMATCH', 'death_date')) AS t(k, c)", "patient")
def _(spark, patient):
    faulty = entities.death(patient).drop("cause_source_value").withColumns({"more": F.lit(1), "death_date": F.col("death_date").cast("string")})
    return quality.check_schema(faulty, "death", schemas.TARGET["death"], spark)


@query("check_primary_key", issue("primary_key", "encounter", "DUPLICATE_PRIMARY_KEY", "'person_id'", "n", "NULL", "(SELECT count(*) - count(DISTINCT person_id) AS n FROM encounter) AS k WHERE n > 0"), "encounter")
def _(spark, encounter):
    return quality.check_primary_key(encounter, "encounter", "person_id")


@query("check_required", issue("required", "encounter", "NULL_REQUIRED_COLUMN", "c", "n", "NULL", "(SELECT 'encounter_id' AS c, count(*) FILTER (encounter_id IS NULL) AS n FROM encounter UNION ALL SELECT 'person_id', count(*) FILTER (person_id IS NULL) FROM encounter UNION ALL SELECT 'type', count(*) FILTER (type IS NULL) FROM encounter) AS k WHERE n > 0"), "encounter")
def _(spark, encounter):
    return quality.check_required(encounter, "encounter", ["encounter_id", "person_id", "type"])


@query("check_tables_present", " UNION ALL ".join(issue("tables", t, "TABLES_MISSING", "NULL", "NULL", "NULL", "(SELECT 1) AS o") for t in schemas.TARGET if t not in ("person", "death")), "patient")
def _(spark, patient):
    return quality.check_tables_present(spark, list({"person": entities.person(patient), "death": entities.death(patient)}), list(schemas.TARGET))


@query("check_single_row", issue("single_row", "cdm_source", "ROW_COUNT", "NULL", "n", "NULL", "(SELECT count(*) AS n FROM patient) AS k WHERE n <> 1"), "patient")
def _(spark, patient):
    return quality.check_single_row(patient)


@query("check_person_refs", issue("person_refs", "encounter", "INVALID_PERSON_ID", "'person_id'", "count(*)", "list_transform(list_slice(list(person_id ORDER BY person_id), 1, 5), lambda x: CAST(x AS VARCHAR))", "(SELECT DISTINCT person_id FROM encounter WHERE person_id NOT IN (SELECT person_id FROM patient WHERE year_of_birth IS NOT NULL)) AS b HAVING count(*) > 0"), "encounter", "patient")
def _(spark, encounter, patient):
    return quality.check_person_refs(encounter, "encounter", patient.filter("year_of_birth is not null"))


@query("check_concepts_exist", issue("concepts_exist", "condition_occurrence", "MISSING_CONCEPT", "c", "n", "e", _PER.format(s=_LISTED, w="id NOT IN (SELECT concept_id FROM catalog)") + " AS p"), "used", "catalog")
def _(spark, used, catalog):
    return quality.check_concepts_exist(used, "condition_occurrence", catalog)


@query("check_standard", issue("standard", "condition_occurrence", "NON_STANDARD_CONCEPT", "c", "n", "e", _PER.format(s=_LISTED, w="c NOT LIKE '%source_concept_id' AND id IN (SELECT concept_id FROM catalog WHERE standard_concept IS NULL)") + " AS p"), "used", "catalog")
def _(spark, used, catalog):
    return quality.check_standard(used, "condition_occurrence", catalog)


@query("check_event_zero", issue("event_zero", "condition_occurrence", "ZERO_EVENT_CONCEPT", "'condition_concept_id'", "n", "NULL", "(SELECT count(*) FILTER (coalesce(condition_concept_id, 0) = 0) AS n FROM used) AS k WHERE n > 0"), "used")
def _(spark, used):
    return quality.check_event_zero(used, "condition_occurrence", "condition_concept_id")


_MAIN = "c = 'condition_concept_id' AND id IN (SELECT concept_id FROM catalog WHERE coalesce(domain_id, '') <> 'Condition')"


@query("check_event_domain", issue("event_domain", "condition_occurrence", "DOMAIN_MISMATCH", "c", "n", "e", _PER.format(s=_LISTED, w=_MAIN) + " AS p"), "used", "catalog")
def _(spark, used, catalog):
    return quality.check_event_domain(used, "condition_occurrence", "condition_concept_id", catalog)


@query("check_era_concepts", issue("era_concepts", "condition_era", "ERA_CONCEPT_MISMATCH", "c", "n", "e", _PER.format(s=_LISTED, w=_MAIN) + " AS p") + " UNION ALL " + issue("era_concepts", "drug_era", "ERA_CONCEPT_MISMATCH", "'drug_concept_id'", "n", "e", _PER.format(s=_LISTED, w="c = 'condition_source_concept_id' AND id IN (SELECT concept_id FROM catalog WHERE coalesce(concept_class_id, '') <> 'Ingredient')") + " AS p"), "used", "catalog")
def _(spark, used, catalog):
    return quality.check_era_concepts(used, "condition_era", catalog).unionByName(quality.check_era_concepts(used.select(F.col("condition_source_concept_id").alias("drug_concept_id")), "drug_era", catalog))


def _every_table(spark, sf_dir):
    from caremill.plans.inputs import TABLES

    return quality.table_counts({t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})


QUERIES["table_counts"] = (_every_table, " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()))
_LEFT_OUT = " UNION ALL ".join(f"SELECT {quoted(t)} AS source_table, _reason AS exclusion_reason FROM {t}_joined WHERE _reason IS NOT NULL" for t in CODED)


def _excluded(tables, codes):
    out = None
    for t, df in tables.items():
        one = vocabulary.apply_lookup(df, codes, t)[1].select(F.lit(t).alias("source_table"), "exclusion_reason")
        out = one if out is None else out.unionByName(one)
    return quality.excluded_counts(out)


@query("excluded_counts", f"SELECT source_table, exclusion_reason, count(*) AS rows FROM ({_LEFT_OUT}) AS x GROUP BY source_table, exclusion_reason", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    tables, codes, _ = _lookup(spark, *parts)
    return _excluded(tables, settled(codes))


STEPS["outs"] = f"SELECT source_table, exclusion_reason, count(*) AS rows FROM ({_LEFT_OUT}) AS x9 WHERE source_table <> 'procedure' GROUP BY source_table, exclusion_reason"


@query("check_coverage", f"SELECT 'coverage' AS \"check\", coalesce(a.source_table, b.source_table) AS \"table\", 'COVERAGE_EXCLUDED_MISMATCH' AS error_type, coalesce(outcome, exclusion_reason) AS \"column\", CAST(coalesce(said, 0) - coalesce(b.rows, 0) AS BIGINT) AS n_bad, CAST(NULL AS VARCHAR[]) AS examples, false AS skipped FROM (SELECT source_table, outcome, sum(rows) AS said FROM cover WHERE outcome NOT IN ({_TARGETS}) GROUP BY source_table, outcome) AS a FULL JOIN outs AS b ON a.source_table = b.source_table AND a.outcome = b.exclusion_reason WHERE said IS DISTINCT FROM b.rows UNION ALL SELECT 'coverage', outcome, 'COVERAGE_TABLE_MISMATCH', NULL, CAST(sum(rows) AS BIGINT), NULL, false FROM cover WHERE outcome = 'device_exposure' GROUP BY outcome", *_VOCABULARY_INPUTS)
def _(spark, *parts):
    """Left-out procedures and all devices are withheld, so that both kinds of mismatch show."""
    tables, codes, units = _lookup(spark, *parts)
    codes, units = settled(codes), settled(units)
    out = _excluded(tables, codes).filter("source_table <> 'procedure'")
    routed = vocabulary.route_by_domain({t: vocabulary.apply_lookup(df, codes, t)[0] for t, df in tables.items()}, _adapters(units))
    return quality.check_coverage(settled(_coverage(spark, *parts)), out, quality.table_counts({t: df for t, df in routed.items() if t != "device_exposure"}))


_VALIDATED = [issue("tables", t, "TABLES_MISSING", "NULL", "NULL", "NULL", "(SELECT 1) AS o") for t in schemas.TARGET if t not in ("person", "death")]
_VALIDATED += [f"SELECT 'required', 'person', 'NULL_REQUIRED_COLUMN', 'year_of_birth', n, NULL, false FROM (SELECT count(*) AS n FROM patient WHERE year_of_birth IS NULL) AS k1 WHERE n > 0"]
_VALIDATED += [f"SELECT '{c}', '{t}', 'SKIPPED', NULL, NULL, NULL, true" for c, t in (("concepts_exist", "concept"), ("standard", "concept"), ("coverage", "coverage"))]


@query("validate", " UNION ALL ".join(_VALIDATED), "patient")
def _(spark, patient):
    return quality.validate({"person": entities.person(patient), "death": entities.death(patient)})


def _all_tables_sql() -> dict[str, str]:
    """SELECT of each target and era table; tables made from others read them as all_<table>."""
    plain = lambda name: QUERIES[name][1]
    out = {"person": plain("person"), "death": plain("death"), "visit_occurrence": plain("visit"), "cdm_source": plain("cdm_source"), "concept": plain("build_concepts")}
    for domain, name in schemas.DOMAIN_TABLE.items():
        routed = " UNION ALL ".join(f"({events_of(t)} WHERE _domain_id = {quoted(domain)})" for t in CODED)
        out[name] = with_inputs(_numbered(name, rows_of(name, f"({routed}) AS e")), STEPS)
    spans = " UNION ALL ".join(f"SELECT person_id, least({', '.join(d)}) AS s, greatest({', '.join(d)}) AS e FROM all_{t}" for t, d in schemas.PERIOD_DATES.items())
    out["observation_period"] = f"SELECT person_id AS observation_period_id, person_id, min(s) AS observation_period_start_date, max(e) AS observation_period_end_date, 32817 AS period_type_concept_id FROM ({spans}) AS s GROUP BY person_id HAVING min(s) IS NOT NULL"
    for name, eras, concept in (("condition_era", _CONDITION_ERAS, "condition_concept_id"), ("drug_era", _DRUG_ERAS, "drug_concept_id")):
        read = eras.replace("FROM conditions", "FROM all_condition_occurrence").replace("FROM exposures", "FROM all_drug_exposure")
        out[name] = with_inputs(f"SELECT row_number() OVER (ORDER BY person_id, {concept}, {name}_start_date) AS {name}_id, * FROM ({read}) AS r", STEPS)
    return out


def _all_checks_sql() -> str:
    tables, parts = _all_tables_sql(), []
    for name in tables:
        schema, source = (schemas.TARGET | schemas.ERA)[name], f"all_{name}"
        nulls = " UNION ALL ".join(f"SELECT {quoted(c)} AS c, count(*) FILTER ({c} IS NULL) AS n FROM {source}" for c in schemas.required(schema))
        parts.append(issue("required", name, "NULL_REQUIRED_COLUMN", "c", "n", "NULL", f"({nulls}) AS k WHERE n > 0"))
        if key := schemas.primary_key(schema):
            parts.append(issue("primary_key", name, "DUPLICATE_PRIMARY_KEY", quoted(key), "n", "NULL", f"(SELECT sum(r - 1) AS n FROM (SELECT count(*) AS r FROM {source} GROUP BY {key})) AS k WHERE n > 0"))
        names = [f.name for f in schema]
        if "person_id" in names and name != "person":
            gone = f"(SELECT DISTINCT person_id FROM {source} AS x WHERE NOT EXISTS (SELECT 1 FROM all_person AS y WHERE y.person_id = x.person_id)) AS b HAVING count(*) > 0"
            parts.append(issue("person_refs", name, "INVALID_PERSON_ID", "'person_id'", "count(*)", "list_transform(list_slice(list(person_id ORDER BY person_id), 1, 5), lambda x: CAST(x AS VARCHAR))", gone))
        main = schemas.MAIN_CONCEPT.get(name)
        if main:
            parts.append(issue("event_zero", name, "ZERO_EVENT_CONCEPT", quoted(main), "n", "NULL", f"(SELECT count(*) FILTER (coalesce({main}, 0) = 0) AS n FROM {source}) AS k WHERE n > 0"))
        columns = [c for c in names if c.endswith("_concept_id")]
        if not columns or name == "concept":
            continue
        listed = "(SELECT DISTINCT c, id FROM (" + " UNION ALL ".join(f"SELECT {quoted(c)} AS c, {c} AS id FROM {source}" for c in columns) + ") WHERE id <> 0)"
        known = "id IN (SELECT concept_id FROM all_concept WHERE {w})".format
        tests = [("concepts_exist", "MISSING_CONCEPT", "id NOT IN (SELECT concept_id FROM all_concept)"), ("standard", "NON_STANDARD_CONCEPT", "c NOT LIKE '%source_concept_id' AND " + known(w="coalesce(standard_concept, '') <> 'S'"))]
        if main:
            tests.append(("event_domain", "DOMAIN_MISMATCH", f"c = {quoted(main)} AND " + known(w=f"coalesce(domain_id, '') <> {quoted(quality.SUPPORTED[name])}")))
        if name in quality.ERA_CONCEPTS:
            column, attribute, wanted = quality.ERA_CONCEPTS[name]
            tests.append(("era_concepts", "ERA_CONCEPT_MISMATCH", f"c = {quoted(column)} AND " + known(w=f"coalesce({attribute}, '') <> {quoted(wanted)}")))
        parts += [issue(check, name, kind, "c", "n", "e", _PER.format(s=listed, w=w) + " AS p") for check, kind, w in tests]
    parts.append(issue("single_row", "cdm_source", "ROW_COUNT", "NULL", "n", "NULL", "(SELECT count(*) AS n FROM all_cdm_source) AS k WHERE n <> 1"))
    out = f"(SELECT source_table, exclusion_reason, count(*) AS rows FROM ({_LEFT_OUT}) AS x8 GROUP BY source_table, exclusion_reason)"
    parts.append(f"SELECT 'coverage', coalesce(a.source_table, b.source_table), 'COVERAGE_EXCLUDED_MISMATCH', coalesce(outcome, exclusion_reason), CAST(coalesce(said, 0) - coalesce(b.rows, 0) AS BIGINT), NULL, false FROM (SELECT source_table, outcome, sum(rows) AS said FROM cover WHERE outcome NOT IN ({_TARGETS}) GROUP BY source_table, outcome) AS a FULL JOIN {out} AS b ON a.source_table = b.source_table AND a.outcome = b.exclusion_reason WHERE said IS DISTINCT FROM b.rows")
    counts = " UNION ALL ".join(f"SELECT {quoted(t)} AS t, count(*) AS n FROM all_{t}" for t in schemas.DOMAIN_TABLE.values())
    parts.append(f"SELECT 'coverage', outcome, 'COVERAGE_TABLE_MISMATCH', NULL, CAST(said - n AS BIGINT), NULL, false FROM (SELECT outcome, sum(rows) AS said FROM cover GROUP BY outcome) AS a JOIN ({counts}) AS b ON t = outcome WHERE said <> n")
    return f"SELECT * FROM (WITH {', '.join(f'all_{n} AS MATERIALIZED ({q})' for n, q in tables.items())} {' UNION ALL '.join(parts)}) AS v"


@query("validate_all", _all_checks_sql(), "patient", "encounter", "terminology", "pairs", *_VOCABULARY_INPUTS)
def _(spark, patient, encounter, terminology, pairs, *parts):
    """All checks over all target and era tables, with coverage and left-out rows."""
    sources, codes, units = _lookup(spark, *parts)
    codes, units = settled(codes), settled(units)
    release(spark)
    # joined once: each target table and the left-out rows read what was written
    applied = {t: vocabulary.split_lookup(settled(vocabulary.join_lookup(df, codes, t))) for t, df in sources.items()}
    tables = {"person": entities.person(patient), "death": entities.death(patient), "visit_occurrence": entities.visit(keys.add_visit_ids(encounter, keys.visit_map(encounter)))}
    tables |= {n: keys.order_table(df, n) for n, df in vocabulary.route_by_domain({t: good for t, (good, _) in applied.items()}, _adapters(units)).items()}
    details = patient.select(F.col("_source_id").alias("network_name"), F.concat("month_year_death", F.lit("01")).alias("date_created"))
    tables["cdm_source"] = entities.cdm_source(details, patient.select(F.col("race").alias("cohort_name")), "2024-05-01", "v1")
    tables["concept"] = vocabulary.build_concepts(parts[-2], readers.load_terminology([terminology]))
    tables = {n: settled(df) for n, df in tables.items()}
    release(spark)
    tables["observation_period"] = settled(intervals.observation_period(tables))
    tables |= {n: settled(df) for n, df in intervals.build_eras(tables["condition_occurrence"], tables["drug_exposure"], pairs).items()}
    release(spark)
    cover = coverage.coverage(settled(reduce(DataFrame.unionByName, (coverage.record_coverage(df, t, codes) for t, df in sources.items()))))
    left_out = reduce(DataFrame.unionByName, (gone.select(F.lit(t).alias("source_table"), "exclusion_reason") for t, (_, gone) in applied.items()))
    cover, left_out = settled(cover), settled(quality.excluded_counts(left_out))
    release(spark)
    return quality.validate(tables, cover, left_out)


INPUTS["results"] = "SELECT CASE p_size % 4 WHEN 0 THEN 'Table_' ELSE 'field_' END || p_brand || '.' || CAST(p_partkey AS STRING) AS check_id, CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS failed, CASE WHEN p_size % 11 = 0 THEN 1 ELSE 0 END AS is_error, CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END AS not_applicable FROM part"
_ACCEPTED = [("table_*", "tables may"), ("field_brand#1?.*", "first brands may"), ("field_brand#11.*", "eleven may"), ("nothing[*", "never"), ("*.7", "sevens may")]
_LIKE = [(r"table\_%", "table_*", "tables may"), (r"field\_brand#1_.%", "field_brand#1?.*", "first brands may"), (r"field\_brand#11.%", "field_brand#11.*", "eleven may"), ("nothing[%", "nothing[*", "never"), ("%.7", "*.7", "sevens may")]
STEPS["accepted"] = values(_LIKE, "likes, pattern, reason")
STEPS["triaged"] = "SELECT check_id, CASE WHEN failed = 0 AND is_error = 0 THEN CASE WHEN not_applicable = 1 THEN 'not_applicable' ELSE 'passed' END WHEN p IS NOT NULL THEN 'accepted' WHEN is_error = 1 THEN 'error' ELSE 'failed' END AS outcome, CASE WHEN (failed = 1 OR is_error = 1) AND p IS NOT NULL THEN r END AS reason FROM (SELECT *, (SELECT min(pattern) FROM accepted WHERE lower(check_id) LIKE likes ESCAPE '\\') AS p FROM results) LEFT JOIN (SELECT pattern AS p, reason AS r FROM accepted) AS a USING (p)"


def _triaged(spark, results):
    return quality.triage_results(results, spark.createDataFrame(_ACCEPTED, "pattern string, reason string"))


@query("triage_results", "SELECT * FROM triaged UNION ALL SELECT pattern, 'unused_pattern', NULL FROM accepted WHERE NOT EXISTS (SELECT 1 FROM results WHERE (failed = 1 OR is_error = 1) AND lower(check_id) LIKE likes ESCAPE '\\')", "results")
def _(spark, results):
    unused = quality.unused_patterns(results, spark.createDataFrame(_ACCEPTED, "pattern string, reason string"))
    return _triaged(spark, results).unionByName(unused.select(F.col("pattern").alias("check_id"), F.lit("unused_pattern").alias("outcome"), F.lit(None).cast("string").alias("reason")))


@query("triage_counts", "SELECT outcome, count(*) AS checks FROM triaged GROUP BY outcome", "results")
def _(spark, results):
    return quality.triage_counts(_triaged(spark, results))
