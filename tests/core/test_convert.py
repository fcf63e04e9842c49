"""A tiny export with two sources, converted from files to tables."""

import datetime as dt

import caremill
import pytest
from caremill import schemas
from caremill.plans.convert import read_tables

FILES = {
    "dictionary": "table,column,data_type\npatient,patient_id,VARCHAR\npatient,year_of_birth,BIGINT\nencounter,start_date,DATE\nencounter,end_date,DATE\ndiagnosis,date,DATE\nmedication_ingredient,start_date,DATE\nmedication_ingredient,end_date,DATE\nlab_result,date,DATE\nlab_result,lab_result_num_val,DECIMAL\n",
    "patient": "patient_id,sex,race,ethnicity,year_of_birth,month_year_death,race_derived_by_x\nP1,M,White,,1950,,T\nP2,F,Asian,Hispanic or Latino,1960,202003,F\nP3,F,,,,,F\n",
    "encounter": "encounter_id,patient_id,start_date,end_date,type\nE1,P1,20200101,20200110,IMP\nE2,P2,20200210,20200320,AMB\nE3,P2,20200401,,AMB\n",
    "diagnosis": "patient_id,encounter_id,code_system,code,date,principal_diagnosis_indicator\nP1,E1,ICD-10-CM,I10,20200102,P\nP1,E9,ICD-10-CM,I10,20200120,S\nP1,,ICD-10-CM,C81,20200102,\nP2,E2,ICD-10-CM,none,20200211,\nP2,E3,ICD-10-CM,I10,20200402,\nP3,E1,ICD-10-CM,I10,20200102,\n",
    "medication_ingredient": "patient_id,encounter_id,code_system,code,start_date,end_date,route\nP1,E1,RxNorm,11,20200101,20200110,Oral Product\nP1,,RxNorm,11,20200120,,\n",
    "lab_result": 'patient_id,encounter_id,code_system,code,date,lab_result_num_val,lab_result_text_val,units_of_measure\nP1,E1,LOINC,L1,20200103,1.5,"",U/L\nP1,E1,LOINC,L1,20200104,,Positive,MG\n',
    "dataset_details": "network_name,date_created\nNet,20240101\n",
    "cohort_details": "cohort_name\nAll\n",
    "standardized_terminology": "code_system,code,code_description\nLOINC,L1,A lab test\n",
}
HEAD = "concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\tvalid_start_date\tvalid_end_date\tinvalid_reason\n"
DATES = "19700101\t20991231\t\n"
VOCABULARY = {
    "CONCEPT": HEAD + "".join("\t".join(r) + "\t" + DATES for r in [("1", "I10 source", "Condition", "ICD10CM", "c", "", "I10"), ("2", '"Hypertension"', "Condition", "SNOMED", "c", "S", "38341003"), ("3", "C81", "Episode", "ICD10CM", "c", "", "C81"), ("4", "Episode", "Episode", "X", "c", "S", "e"), ("5", "Drug", "Drug", "RxNorm", "Ingredient", "S", "11"), ("6", "", "Measurement", "LOINC", "Lab", "S", "L1"), ("7", "unit per liter", "Unit", "UCUM", "Unit", "S", "[U]/L")]),
    "CONCEPT_RELATIONSHIP": "concept_id_1\tconcept_id_2\trelationship_id\tvalid_start_date\tvalid_end_date\tinvalid_reason\n" + "".join(f"{a}\t{b}\tMaps to\t{DATES}" for a, b in [(1, 2), (3, 4), (5, 5), (6, 6)]),
    "VOCABULARY": "vocabulary_id\tvocabulary_name\tvocabulary_reference\tvocabulary_version\tvocabulary_concept_id\nNone\tall\t\tv1\t0\n",
    "CONCEPT_ANCESTOR": "ancestor_concept_id\tdescendant_concept_id\tmin_levels_of_separation\tmax_levels_of_separation\n5\t5\t0\t0\n",
}


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("export")
    for source in ("src_a", "src_b"):
        for name, text in FILES.items():
            path = root / "sources" / source / f"{name}.csv"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text if source == "src_a" or name in ("dictionary", "patient") else text.split("\n")[0] + "\n")
    (root / "vocabulary").mkdir()
    for name, text in VOCABULARY.items():
        (root / "vocabulary" / f"{name}.csv").write_text(text)
    caremill.convert(spark, f"file://{root}/sources", f"file://{root}/vocabulary", f"file://{root}/out", "2024-05-01")
    return f"file://{root}/out"


def test_every_table_conforms_and_passes(spark, out):
    tables = read_tables(spark, out)
    for name, schema in (schemas.TARGET | schemas.ERA).items():
        assert [(f.name, f.dataType) for f in tables[name].schema] == [(f.name, f.dataType) for f in schema], name
    found = caremill.validate(spark, out).collect()
    assert {r.error_type for r in found} <= {"MISSING_CONCEPT"}  # the fixed concepts that the tiny vocabulary lacks


def test_counts_and_rows(spark, out):
    t = read_tables(spark, out)
    assert {n: df.count() for n, df in t.items() if n not in ("concept",)} == {"person": 2, "visit_occurrence": 2, "condition_occurrence": 2, "procedure_occurrence": 0, "drug_exposure": 2, "measurement": 2, "observation": 0, "device_exposure": 0, "death": 1, "observation_period": 2, "cdm_source": 1, "condition_era": 1, "drug_era": 1}
    assert sorted(map(tuple, t["visit_occurrence"].select("person_id", "visit_start_date", "visit_end_date").collect())) == [(1, dt.date(2020, 1, 1), dt.date(2020, 1, 10)), (2, dt.date(2020, 2, 10), dt.date(2020, 2, 29))]
    assert sorted(map(tuple, t["measurement"].select("measurement_id", "value_as_number", "value_source_value", "unit_concept_id", "value_as_concept_id").collect())) == [(1, 1.5, None, 7, 0), (2, None, "Positive", 0, 9191)]
    assert sorted(r.concept_name for r in t["concept"].collect()) == ['"Hypertension"', "A lab test", "Drug", "I10 source", "unit per liter"]
    assert [tuple(r) for r in t["drug_era"].select("drug_era_start_date", "drug_era_end_date", "drug_exposure_count", "gap_days").collect()] == [(dt.date(2020, 1, 1), dt.date(2020, 1, 20), 2, 10)]
    left = spark.read.parquet(f"{out}/excluded/diagnosis")
    assert sorted((r.code, r.exclusion_reason) for r in left.collect()) == [("C81", "unsupported_domain"), ("none", "no_source_concept")]


def test_notes(spark, out):
    notes = {(r.kind, r.name): int(r.n) for r in spark.read.option("header", True).csv(f"{out}/notes").collect()}
    assert notes["rows", "person"] == 2 and notes["rows", "condition_occurrence"] == 2


def test_value_overrides_and_report(spark, out):
    root = out.rsplit("/", 1)[0]
    written = caremill.convert(spark, f"{root}/sources", f"{root}/vocabulary", f"{root}/out2", "2024-05-01", values={"gender": {"M": 1, "F": None}}, export=True)
    assert spark.read.parquet(written["concept"]).count() == len(VOCABULARY["CONCEPT"].strip().split("\n")) - 1
    assert spark.read.parquet(written["concept_relationship"]).count() == 4 and spark.read.parquet(written["vocabulary"]).count() == 1
    assert sorted(r.gender_concept_id for r in spark.read.parquet(written["person"]).collect()) == [0, 1]
    with pytest.raises(ValueError, match="unknown value maps"):
        caremill.convert(spark, f"{root}/sources", f"{root}/vocabulary", f"{root}/out3", "2024-05-01", values={"sex": {}})
    report = caremill.coverage_report(spark, f"{root}/sources", f"{root}/vocabulary")
    assert {(r.source_table, r.rows, r.rows_std) for r in report["totals"].collect()} == {("diagnosis", 6, 4), ("medication_ingredient", 2, 2), ("lab_result", 2, 2)}
    assert all(df.columns and df.count() >= 0 for df in report.values())


def test_report_tells_checks_that_ran_clean_from_those_that_never_ran(spark, out):
    report = caremill.validation_report(spark, out)
    checks = {(r.check, r.table): r for r in report["checks"].collect()}
    assert {r.table for r in checks.values() if r.check == "tables"} == set(schemas.TARGET) and not any(r.outcome == "skipped" for r in checks.values())
    failed = {(r.check, r.table) for r in report["issues"].collect()}
    assert failed == {k for k, r in checks.items() if r.outcome == "failed"} and all(r.n_issues > 0 for r in checks.values() if r.outcome == "failed")
    assert checks["primary_key", "condition_occurrence"].outcome == "passed" and checks["primary_key", "condition_occurrence"].rows == 2
    totals = {r.outcome: r.checks for r in report["totals"].collect()}
    assert set(totals) == {"passed", "failed", "skipped"} and totals["skipped"] == 0 and sum(totals.values()) == len(checks)
