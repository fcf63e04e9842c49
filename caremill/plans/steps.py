"""Common table expressions that several oracle queries share: the lookup, the counts, the mapped codes."""

from __future__ import annotations

from caremill import schemas
from caremill.functions.values import CONCEPTS, SOURCE_VOCABULARIES, UNIT_CODES
from caremill.operators.coverage import EXPECTED

SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
CODED = ["diagnosis", "procedure", "medication_ingredient", "lab_result", "vitals_signs"]


def quoted(x) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(quoted, r)) + ')' for r in rows)}) AS t({names})"


def mapped(column: str, name: str) -> str:
    """CASE for a value map, 0 by default."""
    return f"CASE {column} {' '.join(f'WHEN {quoted(k)} THEN {v}' for k, v in CONCEPTS[name].items())} ELSE 0 END"


def select_schema(schema, given: dict[str, str], have: set[str], source: str) -> str:
    """SELECT of the schema's columns: given, else same-named, else null."""
    pick = lambda f: given.get(f.name) or (f.name if f.name in have else "NULL")
    return "SELECT " + ", ".join(f"CAST({pick(f)} AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}" for f in schema) + f" FROM {source}"


def events_of(table: str) -> str:
    """SELECT of the events of a mapped source table."""
    code = "CASE WHEN code_system <> '' THEN code_system || ':' || code ELSE code END"
    given = {
        "diagnosis": {"_start_date": "date", "_source_value": code, "_status_concept_id": mapped("principal_diagnosis_indicator", "condition_status"), "_status_source_value": "principal_diagnosis_indicator"},
        "procedure": {"_start_date": "date", "_source_value": code, "_modifier_source_value": "modifier_1"},
        "medication_ingredient": {"_start_date": "start_date", "_end_date": "coalesce(end_date, start_date)", "_source_value": "code", "_route_concept_id": mapped("route", "route"), "_route_source_value": "route"},
    }
    for name, number, text in (("lab_result", "lab_result_num_val", "lab_result_text_val"), ("vitals_signs", "value", "text_value")):
        given[name] = {"_start_date": "date", "_source_value": "code", "_value_as_number": number, "_value_source_value": f"nullif({text}, '')", "_value_as_concept_id": mapped(text, "lab_value"), "_unit_concept_id": "coalesce(unit_concept_id, 0)", "_unit_source_value": "units_of_measure"}
    zero = {f.name: "0" for f in schemas.EVENT if f.name.endswith("_concept_id") and f.name not in ("_concept_id", "_source_concept_id", "visit_occurrence_id")}
    join = " LEFT JOIN resolved_units USING (units_of_measure)" if table in ("lab_result", "vitals_signs") else ""
    return select_schema(schemas.EVENT, zero | given[table], {"person_id", "_concept_id", "_source_concept_id"}, f"{table}_mapped{join}")


def rows_of(name: str, source: str) -> str:
    """SELECT of a target table's rows from events."""
    from caremill.operators.events import FROM_EVENT, RECORD_TYPE

    given = {f.name: "0" for f in schemas.TARGET[name] if f.name.endswith("_concept_id") and not f.nullable} | FROM_EVENT[name] | {RECORD_TYPE[name]: "32817"}
    if name == "drug_exposure":
        given["drug_exposure_end_date"] = "coalesce(_end_date, _start_date)"
    return select_schema(schemas.TARGET[name], given, {"person_id", "visit_occurrence_id"}, source)


_UNIQUE = "row_number() OVER (PARTITION BY concept_id ORDER BY CASE WHEN coalesce(concept_name, '') = '' THEN 1 ELSE 0 END, src_rank, concept_class_id NULLS LAST, concept_code NULLS LAST, concept_name NULLS LAST, domain_id NULLS LAST, invalid_reason NULLS LAST, standard_concept NULLS LAST, valid_end_date NULLS LAST, valid_start_date NULLS LAST, vocabulary_id NULLS LAST)"
_DOMAINS = ", ".join(map(quoted, schemas.DOMAIN_TABLE))
_TO_TABLE = f"CASE domain_id {' '.join(f'WHEN {quoted(k)} THEN {quoted(v)}' for k, v in schemas.DOMAIN_TABLE.items())} END"
EXPECTED_SQL = f"CASE source_table {' '.join(f'WHEN {quoted(k)} THEN {quoted(v)}' for k, v in EXPECTED.items())} END"


def unique(source: str) -> str:
    return f"SELECT * EXCLUDE (n) FROM (SELECT *, {_UNIQUE} AS n FROM {source}) WHERE n = 1"


STEPS = {
    "maps": "SELECT concept_id_1, concept_id_2 FROM relationships WHERE relationship_id = 'Maps to' AND coalesce(invalid_reason, '') = ''",
    "vocabulary_map": values([(t, s, v) for t, m in SOURCE_VOCABULARIES.items() for s, v in m.items()], "source_table, code_system, vocabulary_id"),
    "unit_map": values(list(UNIT_CODES.items()), "units_of_measure, override"),
    "src_codes": " UNION ".join(f"SELECT DISTINCT {quoted(t)} AS source_table, code_system, code FROM {t} WHERE code_system IS NOT NULL AND code IS NOT NULL" for t in CODED),
    "src_units": "SELECT DISTINCT units_of_measure FROM lab_result WHERE units_of_measure IS NOT NULL UNION SELECT DISTINCT units_of_measure FROM vitals_signs WHERE units_of_measure IS NOT NULL",
    "named_codes": "SELECT source_table, code_system, code, CASE WHEN vocabulary_id = 'RxNorm' AND starts_with(code, 'OMOP') THEN 'RxNorm Extension' ELSE vocabulary_id END AS vocabulary_id FROM src_codes LEFT JOIN vocabulary_map USING (source_table, code_system)",
    "unit_codes": "SELECT units_of_measure, coalesce(override, units_of_measure) AS lookup_code FROM src_units LEFT JOIN unit_map USING (units_of_measure)",
    "wanted": "SELECT DISTINCT vocabulary_id, code AS concept_code, false AS only_standard FROM named_codes WHERE vocabulary_id IS NOT NULL UNION SELECT DISTINCT 'UCUM', lookup_code, true FROM unit_codes",
    "found": "SELECT concepts.* FROM concepts JOIN wanted USING (vocabulary_id, concept_code) WHERE NOT only_standard OR standard_concept = 'S'",
    "candidates": f"SELECT CAST(concept_id AS BIGINT) AS concept_id, vocabulary_id, concept_code, coalesce(invalid_reason, '') <> '' AS invalid FROM ({unique('found')}) AS x",
    "best": "SELECT vocabulary_id, concept_code, concept_id FROM (SELECT *, row_number() OVER (PARTITION BY vocabulary_id, concept_code ORDER BY invalid, concept_id) AS n FROM candidates) WHERE n = 1",
    "targets": f"""SELECT DISTINCT m.concept_id_1, m.concept_id_2 AS concept_id, t.domain_id FROM maps m JOIN best b ON b.concept_id = m.concept_id_1
        JOIN (SELECT CAST(concept_id AS BIGINT) AS id, domain_id FROM ({unique("(SELECT * FROM concepts WHERE standard_concept = 'S')")}) AS y) AS t ON t.id = m.concept_id_2""",
    "resolved": f"""SELECT DISTINCT source_table, code_system, code, coalesce(source_id, 0) AS source_concept_id, CASE WHEN reason IS NULL THEN concept_id END AS concept_id, domain_id, reason AS exclusion_reason FROM (
        SELECT c.*, b.concept_id AS source_id, t.concept_id, t.domain_id, CASE WHEN b.concept_id IS NULL THEN 'no_source_concept' WHEN t.concept_id IS NULL THEN 'no_standard_mapping' WHEN NOT coalesce(t.domain_id IN ({_DOMAINS}), false) THEN 'unsupported_domain' END AS reason
        FROM named_codes c LEFT JOIN best b ON b.vocabulary_id = c.vocabulary_id AND b.concept_code = c.code LEFT JOIN targets t ON t.concept_id_1 = b.concept_id)""",
    "resolved_units": "SELECT units_of_measure, coalesce(concept_id, 0) AS unit_concept_id FROM unit_codes LEFT JOIN (SELECT * FROM best WHERE vocabulary_id = 'UCUM') AS u ON u.concept_code = lookup_code",
    **{f"{t}_joined": f"SELECT d.*, coalesce(r.source_concept_id, 0) AS _source_concept_id, r.concept_id AS _concept_id, r.domain_id AS _domain_id, CASE WHEN r.concept_id IS NULL THEN coalesce(r.exclusion_reason, 'no_source_concept') END AS _reason FROM {t} d LEFT JOIN (SELECT * FROM resolved WHERE source_table = {quoted(t)}) AS r ON r.code_system = d.code_system AND r.code = d.code" for t in CODED},
    **{f"{t}_mapped": f"SELECT * EXCLUDE (_reason) FROM {t}_joined WHERE _reason IS NULL" for t in CODED},
    "all_events": " UNION ALL ".join(f"SELECT e.*, _domain FROM (SELECT *, _domain_id AS _domain FROM {t}_mapped) AS m, LATERAL (SELECT 1) AS e" for t in CODED[:0]) or "SELECT 1",
    "parts": " UNION ALL ".join(f"SELECT {quoted(t)} AS source_table, code_system, code, outcome, CAST(count(*) AS BIGINT) AS rows FROM (SELECT code_system, code, CASE WHEN _concept_id IS NOT NULL THEN {_TO_TABLE.replace('domain_id', '_domain_id')} ELSE _reason END AS outcome FROM {t}_joined) AS x{i} GROUP BY code_system, code, outcome" for i, t in enumerate(CODED)),
    "cover": """SELECT source_table, code_system, outcome, CAST(sum(rows) AS BIGINT) AS rows, count(DISTINCT code) AS codes FROM parts GROUP BY source_table, code_system, outcome""",
    "code_counts": " UNION ALL ".join(f"SELECT {quoted(t)} AS source_table, code_system, code, count(*) AS rows FROM {t} GROUP BY code_system, code" for t in CODED),
    "unit_counts": " UNION ALL ".join(f"SELECT {quoted(t)} AS source_table, units_of_measure, count(*) AS rows FROM {t} GROUP BY units_of_measure" for t in ("lab_result", "vitals_signs")),
    "text_counts": "SELECT lab_result_text_val, count(*) AS rows FROM lab_result GROUP BY lab_result_text_val",
    "known_counts": "SELECT c.source_table, c.code_system, c.code, c.rows, CASE WHEN v.vocabulary_id = 'RxNorm' AND starts_with(c.code, 'OMOP') THEN 'RxNorm Extension' ELSE v.vocabulary_id END AS vocabulary_id, v.source_table IS NOT NULL AS known FROM code_counts c LEFT JOIN vocabulary_map v ON v.source_table = c.source_table AND v.code_system = c.code_system",
    "summary": f"SELECT source_table, code_system, code, max(source_concept_id) AS source_concept_id, CAST(count(*) FILTER (exclusion_reason IS NULL) AS BIGINT) AS n_targets, coalesce(bool_or(domain_id <> {EXPECTED_SQL}), false) AS off_domain, min(exclusion_reason) AS exclusion_reason FROM resolved GROUP BY source_table, code_system, code",
    "source_rows": f"SELECT CAST(concept_id AS BIGINT) AS source_concept_id, concept_name AS source_concept_name, coalesce(invalid_reason, '') <> '' AS source_invalid, coalesce(standard_concept, '') = 'S' AS source_standard FROM ({unique('concepts')}) AS z WHERE CAST(concept_id AS BIGINT) IN (SELECT source_concept_id FROM summary WHERE source_concept_id > 0)",
    "mapped_codes": """SELECT coalesce(s.source_concept_id, 0) AS source_concept_id, k.source_table, k.code_system, k.code, k.rows, k.vocabulary_id, k.known, coalesce(s.n_targets, 0) AS n_targets, coalesce(s.off_domain, false) AS off_domain, s.exclusion_reason, r.source_concept_name, coalesce(r.source_invalid, false) AS source_invalid, r.source_standard, coalesce(s.source_concept_id, 0) > 0 AS has_source
        FROM known_counts k LEFT JOIN summary s ON s.source_table = k.source_table AND s.code_system = k.code_system AND s.code = k.code LEFT JOIN source_rows r ON r.source_concept_id = s.source_concept_id""",
    "by_code": """SELECT source_table, code_system, count(*) AS codes, count(*) FILTER (has_source) AS codes_src, count(*) FILTER (source_invalid) AS codes_src_invalid, count(*) FILTER (n_targets > 0) AS codes_std, count(*) FILTER (n_targets > 1) AS codes_multi, count(*) FILTER (off_domain) AS codes_off_domain,
        CAST(sum(rows) AS BIGINT) AS rows, CAST(coalesce(sum(rows) FILTER (has_source), 0) AS BIGINT) AS rows_src, CAST(coalesce(sum(rows) FILTER (source_invalid), 0) AS BIGINT) AS rows_src_invalid, CAST(coalesce(sum(rows) FILTER (n_targets > 0), 0) AS BIGINT) AS rows_std, CAST(coalesce(sum(rows) FILTER (n_targets > 1), 0) AS BIGINT) AS rows_multi, CAST(sum(rows * greatest(n_targets - 1, 0)) AS BIGINT) AS extra_rows, CAST(coalesce(sum(rows) FILTER (off_domain), 0) AS BIGINT) AS rows_off_domain
        FROM mapped_codes GROUP BY source_table, code_system""",
    "unmapped": "SELECT m.*, CASE WHEN v.vocabulary_id IS NULL THEN 'no_vocabulary' ELSE coalesce(m.exclusion_reason, 'no_source_concept') END AS reason FROM mapped_codes m LEFT JOIN (SELECT DISTINCT vocabulary_id FROM vocabularies) AS v ON v.vocabulary_id = m.vocabulary_id WHERE n_targets = 0",
    "marked": "SELECT c.source_table, coalesce(c.units_of_measure, '') AS units_of_measure, c.rows, coalesce(u.unit_concept_id, 0) > 0 AS ucum, coalesce(c.units_of_measure, '') = '' AS empty FROM unit_counts c LEFT JOIN resolved_units u ON u.units_of_measure = coalesce(c.units_of_measure, '')",
}
del STEPS["all_events"]


def percent(part: str, whole: str, digits: int = 1) -> str:
    return f"round_even(CAST({part} AS DOUBLE) * 100 / {whole}, {digits})"


def death_month(column: str = "month_year_death") -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]{{6}}') THEN CAST(try_strptime({column} || '01', '%Y%m%d') AS DATE) END"
