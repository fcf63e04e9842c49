"""Golden cases of single operators, and a sample of the registered queries against their SQL."""

import datetime as dt
import random
from pathlib import Path

import duckdb
import pytest
from caremill import plans
from caremill.functions.values import CONCEPTS, map_value, parse_yyyymm, qualified_code
from caremill.operators import cleaning, intervals, keys, quality
from caremill.plans.inputs import TABLES
from caremill.sources import readers
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)


def eras(spark, spans):
    rows = [(1, 9, day(a), None if b is None else day(b)) for a, b in spans]
    df = spark.createDataFrame(rows, "person_id long, condition_concept_id long, condition_start_date date, condition_end_date date")
    return sorted(((r.condition_era_start_date - day(0)).days, (r.condition_era_end_date - day(0)).days, r.condition_occurrence_count) for r in intervals.condition_eras(df).collect())


@pytest.mark.parametrize("spans,want", [
    ([(0, 10), (40, 45), (76, 80)], [(0, 45, 2), (76, 80, 1)]), ([(0, 10), (41, 42)], [(0, 10, 1), (41, 42, 1)]), ([(0, 60), (10, 12), (84, 85)], [(0, 85, 3)]),
    ([(0, None), (31, None)], [(0, 32, 2)]), ([(5, 2)], [(5, 5, 1)]),
])
def test_condition_eras(spark, spans, want):
    assert eras(spark, spans) == want


@pytest.mark.parametrize("rows,want", [
    ([(10, 0, 10, None), (10, 5, 20, None)], [(0, 20, 2, 0)]), ([(10, 0, 10, None), (10, 20, 30, None)], [(0, 30, 2, 10)]), ([(10, 0, 10, None), (10, 8, 12, None), (10, 20, 25, None)], [(0, 25, 3, 8)]),
    ([(10, 0, 100, None), (10, 120, 125, None), (10, 150, 151, None)], [(0, 151, 3, 45)]), ([(10, 0, None, 7), (10, 37, 40, None)], [(0, 40, 2, 30)]), ([(10, 0, 5, None), (11, 6, 9, None)], [(0, 9, 2, 1)]),
])
def test_drug_eras(spark, rows, want):
    df = spark.createDataFrame([(1, d, day(a), None if b is None else day(b), n) for d, a, b, n in rows], "person_id long, drug_concept_id long, drug_exposure_start_date date, drug_exposure_end_date date, days_supply long")
    pairs = spark.createDataFrame([(10, 1), (11, 1)], "drug_concept_id long, ingredient_concept_id long")
    assert [((r.drug_era_start_date - day(0)).days, (r.drug_era_end_date - day(0)).days, r.drug_exposure_count, r.gap_days) for r in intervals.drug_eras(df, pairs).collect()] == want


def test_eras_against_a_plain_loop(spark):
    rng = random.Random(7)
    rows = [(rng.randint(1, 6), rng.randint(1, 3), a, a + rng.randint(0, 25)) for a in (rng.randint(0, 400) for _ in range(600))]
    want, open_eras = [], {}
    for p, c, a, b in sorted(rows):
        era = open_eras.get((p, c))
        if era and a - era[1] <= 30:
            era[1], era[2] = max(era[1], b), era[2] + 1
        else:
            open_eras[p, c] = era = [a, b, 1]
            want.append((p, c, era))
    df = spark.createDataFrame([(p, c, day(a), day(b)) for p, c, a, b in rows], "person_id long, condition_concept_id long, condition_start_date date, condition_end_date date")
    got = sorted((r[0], r[1], (r[2] - day(0)).days, (r[3] - day(0)).days, r[4]) for r in intervals.condition_eras(df).collect())
    assert got == sorted((p, c, *era) for p, c, era in want)


def test_values(spark):
    df = spark.createDataFrame([("M", "A", "x"), (None, None, "x"), ("", "", "x"), ("q", "A", None)], "sex string, system string, code string")
    got = df.select(map_value(F.col("sex"), CONCEPTS["gender"]), qualified_code(F.col("system"), F.col("code"))).collect()
    assert [tuple(r) for r in got] == [(8507, "A:x"), (0, "x"), (0, "x"), (0, None)]
    months = spark.createDataFrame([(m,) for m in ("202003", "", None, "202013", "202000", "032020", "20203")], "m string")
    assert [r[0] for r in months.select(parse_yyyymm(F.col("m"))).collect()] == [dt.date(2020, 3, 1)] + [None] * 6


def encounter(spark, kind, start, end, linked=()):
    e = spark.createDataFrame([(1, "E", start, end, kind)], "person_id long, encounter_id string, start_date date, end_date date, type string")
    d = spark.createDataFrame([(1, "E", x) for x in linked], "person_id long, encounter_id string, date date")
    r = cleaning.repair_encounter_dates(e, [d]).first()
    return r.start_date, r.end_date


def test_repair_of_encounter_dates(spark):
    assert encounter(spark, "AMB", day(5), None, [day(3)]) == (day(5), day(5))
    assert encounter(spark, "IMP", day(9), day(4), [day(2), day(11), day(6)]) == (day(2), day(11))
    assert encounter(spark, "IMP", day(9), None, [day(10), day(14)]) == (day(10), day(14))
    assert encounter(spark, "IMP", day(9), None) == (day(9), day(9))
    assert encounter(spark, None, day(9), day(12)) == (day(9), day(12))


def test_unknown_encounters_become_null_before_rows_are_made_distinct(spark):
    patient = spark.createDataFrame([("s", "P", 1, "1950", None)], "_source_id string, patient_id string, person_id long, year_of_birth string, month_year_death string")
    visits = spark.createDataFrame([("s", "P", 1, "E1", day(0), day(0), "AMB")], "_source_id string, patient_id string, person_id long, encounter_id string, start_date date, end_date date, type string")
    rows = spark.createDataFrame([("s", "P", 1, e, day(0)) for e in ("E8", "E9", "", "E1", "E1")], "_source_id string, patient_id string, person_id long, encounter_id string, date date")
    out = cleaning.clean_tables({"patient": patient, "encounter": visits, "diagnosis": rows})
    assert sorted(str(r.encounter_id) for r in out["diagnosis"].collect()) == ["E1", "None"]


def test_numbering_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab") + "c", rng.choice(["", "é", "z"]) + str(rng.randrange(10**4))) for _ in range(400)]
    df = spark.createDataFrame(rows, "_source_id string, patient_id string").distinct()
    buckets = [F.col("_source_id"), F.concat_ws("\0", "_source_id", F.substring("patient_id", 1, 2))]
    want = sorted(set(rows), key=lambda r: (r[0].encode(), r[1].encode()))
    for n in (1, 7):
        got = keys.number_rows(df.repartition(n), "id", [F.col("_source_id"), F.col("patient_id")], buckets).orderBy("id").collect()
        assert [(r._source_id, r.patient_id) for r in got] == want and [r.id for r in got] == list(range(1, len(want) + 1))


def test_record_ids_in_the_order_of_the_keys(spark):
    df = spark.createDataFrame([(None, 2, 5, 5), (None, 1, 5, 7), (None, 1, 5, 6), (None, 1, 1, 9)], "id long, person_id long, day long, concept long")
    got = keys.record_ids(df, "id", ["person_id", "day", "concept"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, 9), (2, 1, 5, 6), (3, 1, 5, 7), (4, 2, 5, 5)]


def test_readers_keep_empty_and_null_apart(spark, tmp_path):
    (tmp_path / "src_a").mkdir()
    (tmp_path / "src_a" / "t.csv").write_text('a,b\n"",\nx,"y ""q"""\n')
    got = readers.read_source(spark, f"file://{tmp_path}", "t").collect()
    assert sorted((r.a, r.b, r._source_id) for r in got) == [("", None, "src_a"), ("x", 'y "q"', "src_a")]
    with pytest.raises(ValueError):
        readers.vocabulary_version(spark.createDataFrame([("x", "1")], "vocabulary_id string, vocabulary_version string"))


def test_primary_key_counts_null_as_a_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert quality.check_primary_key(df, "t", "k").first().n_bad == 2


SAMPLE = """read_source apply_types dictionary_diff load_terminology export_vocabulary medication_events lab_events build_drug person visit cdm_source clean_tables person_index
record_ids order_table resolve_codes resolve_units apply_lookup route_by_domain concept_table drug_eras build_eras observation_period coverage coverage_by_row top_unmapped unit_summary check_person_refs
check_concepts_exist check_coverage check_outcomes validate triage_results""".split()


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(plans.oracle_sql()[name])
    got = plans.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    text = lambda rows: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)
    assert text(map(tuple, got.select(*want.columns).collect())) == text(want.fetchall())


def test_examples_of_a_column_are_bounded_before_they_are_collected(spark):
    used = spark.range(1, 2001).selectExpr("id % 700 as condition_concept_id", "id * 3 as condition_source_concept_id")
    found = quality.check_concepts_exist(used, "condition_occurrence", spark.createDataFrame([(1,), (3,), (4,)], "concept_id long"))
    assert {r["column"]: (r.n_bad, r.examples) for r in found.collect()} == {"condition_concept_id": (696, ["2", "5", "6", "7", "8"]), "condition_source_concept_id": (1999, ["6", "9", "12", "15", "18"])}
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")
def test_validation_of_all_tables_against_its_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(map(str, con.sql(plans.oracle_sql()["validate_all"]).fetchall()))
    rows = plans.queries()["validate_all"](spark, SF).collect()
    assert sorted(str(tuple(r)) for r in rows) == want
    assert not {"tables", "schema"} & {r.check for r in rows} and not any(r.skipped for r in rows)
    assert {"required", "primary_key", "concepts_exist", "standard", "era_concepts"} <= {r.check for r in rows} and len({r.table for r in rows}) > 9


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())
