"""Clinical-shaped inputs derived from the driver's tables, with expressions that Spark and DuckDB read alike.

Each input is one SELECT over the registered tables. Spark runs it to get the operators' inputs; the oracle SQL
names it as a common table expression.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_PERSON = "CAST('s' || CAST({k} % 3 AS STRING) AS STRING) AS _source_id, CAST({k} AS STRING) AS patient_id, {k} AS person_id"
_DEATH = "CASE WHEN c_custkey % 35 = 0 THEN '199813' WHEN c_custkey % 7 = 0 THEN '199' || CAST(5 + c_custkey % 4 AS STRING) || '06' WHEN c_custkey % 11 = 0 THEN '' END"
_RECORD = f"""{_PERSON.format(k='o_custkey')}, CASE WHEN l_linenumber = 7 THEN 'x' || CAST(l_orderkey AS STRING) WHEN l_linenumber = 6 THEN '' ELSE CAST(l_orderkey AS STRING) END AS encounter_id"""
_LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_DATE = "CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END"
_CODE = "CASE WHEN l_suppkey % 40 <> 0 THEN CAST(l_partkey AS STRING) END"

INPUTS = {
    "patient": f"""SELECT {_PERSON.format(k='c_custkey')}, CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Unknown' END AS sex,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'White' WHEN 'MACHINERY' THEN 'Asian' WHEN 'AUTOMOBILE' THEN 'Black or African American' ELSE 'Other' END AS race,
        CASE WHEN c_acctbal > 5000 THEN 'Hispanic or Latino' WHEN c_acctbal > 0 THEN 'Not Hispanic or Latino' END AS ethnicity,
        CASE WHEN c_custkey % 17 <> 0 THEN 1930 + c_custkey % 70 END AS year_of_birth, {_DEATH} AS month_year_death FROM customer""",
    "encounter": f"""SELECT {_PERSON.format(k='o_custkey')}, CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderkey AS STRING) END AS encounter_id, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 2 AS INT) END AS end_date,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'IMP' WHEN '2-HIGH' THEN 'EMER' WHEN '3-MEDIUM' THEN 'AMB' WHEN '4-NOT SPECIFIED' THEN 'XX' END AS type FROM orders""",
    "diagnosis": f"""SELECT {_RECORD}, CASE WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 4 THEN NULL WHEN l_linenumber = 5 THEN 'ICD-9-CM' ELSE 'ICD-10-CM' END AS code_system, {_CODE} AS code, {_DATE} AS date,
        CASE l_linestatus WHEN 'F' THEN 'P' ELSE CASE WHEN l_partkey % 3 = 0 THEN 'S' ELSE 'x' END END AS principal_diagnosis_indicator {_LINES} WHERE l_returnflag = 'A'""",
    "procedure": f"""SELECT {_RECORD}, CASE WHEN l_linenumber < 4 THEN 'CPT' WHEN l_linenumber < 6 THEN 'ICD-9-CM' ELSE 'Other' END AS code_system, {_CODE} AS code, {_DATE} AS date, l_linestatus AS modifier_1 {_LINES} WHERE l_returnflag = 'N' AND l_linestatus = 'O'""",
    "medication_ingredient": f"""SELECT {_RECORD}, 'RxNorm' AS code_system, CASE WHEN l_linenumber = 5 THEN 'OMOP' || CAST(l_partkey AS STRING) ELSE {_CODE} END AS code, {_DATE} AS start_date,
        CASE WHEN l_suppkey % 3 <> 0 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) END AS end_date,
        CASE WHEN l_linenumber = 1 THEN 'Oral Product' WHEN l_linenumber = 2 THEN 'Nasal Product' WHEN l_linenumber = 3 THEN 'Other' END AS route {_LINES} WHERE l_returnflag = 'R'""",
    "lab_result": f"""SELECT {_PERSON.format(k='user_id')}, CASE WHEN event_id % 9 = 0 THEN 'TNX' ELSE 'LOINC' END AS code_system, CAST(user_id * 7 % 400 AS STRING) AS code, CAST(ts AS DATE) AS date, value AS lab_result_num_val,
        CASE event_id % 5 WHEN 0 THEN 'Negative' WHEN 1 THEN 'Positive' WHEN 2 THEN '' WHEN 3 THEN event_type END AS lab_result_text_val,
        CASE event_id % 6 WHEN 0 THEN 'U/L' WHEN 1 THEN 'mg/dL' WHEN 2 THEN 'g/l' WHEN 3 THEN '' WHEN 4 THEN 'unit' || CAST(event_id % 40 AS STRING) END AS units_of_measure FROM events WHERE event_type <> 'view'""",
    "vitals_signs": f"""SELECT {_PERSON.format(k='user_id')}, 'LOINC' AS code_system, CAST(user_id % 300 AS STRING) AS code, CAST(ts AS DATE) AS date, value, CASE WHEN event_id % 3 = 0 THEN 'Positive' END AS text_value,
        CASE WHEN event_id % 4 = 0 THEN 'mg/dL' WHEN event_id % 4 = 1 THEN 'MG/DL' END AS units_of_measure FROM events WHERE event_type = 'view'""",
    "concepts": """SELECT CAST(p_partkey AS STRING) AS concept_id, CASE WHEN p_partkey % 20 = 0 THEN '' ELSE p_name END AS concept_name,
        CASE p_partkey % 8 WHEN 0 THEN 'Condition' WHEN 1 THEN 'Procedure' WHEN 2 THEN 'Drug' WHEN 3 THEN 'Measurement' WHEN 4 THEN 'Observation' WHEN 5 THEN 'Device' WHEN 6 THEN 'Episode' END AS domain_id,
        CASE p_partkey % 9 WHEN 0 THEN 'ICD10CM' WHEN 1 THEN 'ICD9CM' WHEN 2 THEN 'CPT4' WHEN 3 THEN 'ICD9Proc' WHEN 4 THEN 'RxNorm' WHEN 5 THEN 'LOINC' WHEN 6 THEN 'UCUM' WHEN 7 THEN 'RxNorm Extension' ELSE 'ICD10CM' END AS vocabulary_id,
        CASE WHEN p_size % 3 = 0 THEN 'Ingredient' ELSE p_type END AS concept_class_id, CASE WHEN p_size > 15 THEN 'S' END AS standard_concept,
        CASE p_partkey % 9 WHEN 6 THEN CASE p_partkey % 27 WHEN 6 THEN '[U]/L' WHEN 15 THEN 'mg/dL' ELSE 'g/L' END WHEN 7 THEN 'OMOP' || CAST(p_partkey AS STRING) ELSE CAST(p_partkey % 700 AS STRING) END AS concept_code,
        '19700101' AS valid_start_date, '20991231' AS valid_end_date, CASE WHEN p_size % 13 = 0 THEN 'D' WHEN p_size % 5 = 0 THEN '' END AS invalid_reason, 0 AS src_rank FROM part
        UNION ALL SELECT CAST(p_partkey AS STRING), CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'again ' || p_name END, 'Procedure', 'CPT4', 'CPT4', 'S', CAST(p_partkey % 700 AS STRING), '19700101', '20991231', NULL, 1 FROM part WHERE p_partkey % 5 = 0""",
    "relationships": """SELECT p_partkey AS concept_id_1, CASE WHEN p_size % 2 = 0 THEN p_partkey ELSE p_partkey * 7 % 200 + 1 END AS concept_id_2, CASE WHEN p_size % 7 = 0 THEN 'Mapped from' ELSE 'Maps to' END AS relationship_id, CASE WHEN p_size % 11 = 0 THEN 'D' WHEN p_size % 3 = 0 THEN '' END AS invalid_reason FROM part
        UNION ALL SELECT p_partkey, p_partkey * 11 % 200 + 1, 'Maps to', NULL FROM part WHERE p_partkey % 4 = 0""",
    "closure": "SELECT p_partkey % 50 + 1 AS ancestor_concept_id, p_partkey AS descendant_concept_id FROM part",
    "vocabularies": "SELECT DISTINCT CASE p_size % 5 WHEN 0 THEN 'ICD10CM' WHEN 1 THEN 'CPT4' WHEN 2 THEN 'RxNorm' WHEN 3 THEN 'LOINC' ELSE 'None' END AS vocabulary_id, 'v' || CAST(p_size % 5 AS STRING) AS vocabulary_version FROM part",
    "terminology": "SELECT CASE p_partkey % 3 WHEN 0 THEN 'ICD-10-CM' WHEN 1 THEN 'CPT' ELSE 'RxNorm' END AS code_system, CAST(p_partkey % 700 AS STRING) AS code, CASE WHEN p_size % 4 > 0 THEN p_type END AS code_description, 's' || CAST(p_size % 3 AS STRING) AS _source_id FROM part",
    "conditions": f"SELECT o_custkey AS person_id, l_partkey % 20 AS condition_concept_id, CAST(l_shipdate AS DATE) AS condition_start_date, CASE WHEN l_linenumber % 3 > 0 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity - 5 AS INT) END AS condition_end_date {_LINES}",
    "exposures": f"SELECT o_custkey AS person_id, l_partkey AS drug_concept_id, CAST(l_shipdate AS DATE) AS drug_exposure_start_date, CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity - 3 AS INT) END AS drug_exposure_end_date, CASE WHEN l_linenumber % 3 = 1 THEN CAST(l_quantity AS BIGINT) END AS days_supply {_LINES}",
    "pairs": "SELECT DISTINCT p_partkey AS drug_concept_id, p_partkey % 50 AS ingredient_concept_id FROM part WHERE p_size > 5 UNION ALL SELECT p_partkey, 50 + p_partkey % 7 FROM part WHERE p_size % 10 = 0",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def needs(sql: str, known: dict[str, str]) -> list[str]:
    """Names among ``known`` that the SQL reads, those that they read first."""
    out: list[str] = []
    for name in known:
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql, re.I):
            out += [n for n in [*needs(known[name], {k: v for k, v in known.items() if k != name}), name] if n not in out]
    return out


def with_inputs(sql: str, steps: dict[str, str] | None = None) -> str:
    """The SQL with the inputs and steps that it reads as common table expressions."""
    known = INPUTS | (steps or {})
    names = needs(sql, known)
    return f"WITH {', '.join(f'{n} AS ({known[n]})' for n in names)} {sql}" if names else sql


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named inputs over the driver's tables."""
    out = []
    for name in names:
        sql = INPUTS[name]
        for t in TABLES:
            sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", sql, flags=re.I)
        used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
        out.append(spark.sql(sql, **used))
    return out
