"""Persons, deaths, visits and the one row that describes a source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremill import schemas
from caremill.functions.values import CONCEPTS, EHR_TYPE, NO_CONCEPT, optional_column, optional_concept, parse_yyyymm, parse_yyyymmdd
from caremill.operators.events import build_from_events

#: Fixed values of the row that describes a source.
SOURCE_NAME, SOURCE_SHORT, DESCRIPTION, VERSION, VERSION_CONCEPT = "Record export", "EHR", "EHR export", "v5.4", 756265


def person(patients: DataFrame, maps: dict = CONCEPTS) -> DataFrame:
    """One row per patient row: mapped sex, race and ethnicity, their texts, and the patient id as source value."""
    zero = F.lit(NO_CONCEPT)
    columns = {"person_source_value": F.col("patient_id")}
    for target, source in (("gender", "sex"), ("race", "race"), ("ethnicity", "ethnicity")):
        columns |= {f"{target}_concept_id": optional_concept(patients, source, maps[target]), f"{target}_source_value": optional_column(patients, source), f"{target}_source_concept_id": zero}
    return build_from_events(patients, schemas.TARGET["person"], columns)


def death(patients: DataFrame) -> DataFrame:
    """One row per patient row with a valid month of death; none if the table lacks the column."""
    dated = patients.withColumn("death_date", parse_yyyymm(optional_column(patients, "month_year_death"))).filter(F.col("death_date").isNotNull())
    return build_from_events(dated, schemas.TARGET["death"], {"death_type_concept_id": F.lit(EHR_TYPE), "cause_concept_id": F.lit(NO_CONCEPT), "cause_source_concept_id": F.lit(NO_CONCEPT)})


def visit(encounters: DataFrame, maps: dict = CONCEPTS) -> DataFrame:
    """One row per encounter row with its visit id."""
    zero = F.lit(NO_CONCEPT)
    return build_from_events(encounters, schemas.TARGET["visit_occurrence"], {
        "visit_concept_id": optional_concept(encounters, "type", maps["visit_type"]), "visit_start_date": F.col("start_date"), "visit_end_date": F.col("end_date"), "visit_type_concept_id": F.lit(EHR_TYPE),
        "visit_source_value": F.col("encounter_id"), "visit_source_concept_id": zero, "admitted_from_concept_id": zero, "discharged_to_concept_id": zero,
    })


def cdm_source(details: DataFrame, cohorts: DataFrame, released: str, vocabulary_version: str, reference: str | None = None) -> DataFrame:
    """The row on the source: its names, cohorts and newest export date, or else the release date."""
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "; ")
    one = details.agg(names(optional_column(details, "network_name")).alias("name"), F.max(parse_yyyymmdd(optional_column(details, "date_created"))).alias("made"))
    two = cohorts.agg(names(optional_column(cohorts, "cohort_name")).alias("cohorts"))
    both = one.join(F.broadcast(two), F.lit(True))  # one row each
    name = F.when(F.col("name") != "", F.col("name")).otherwise(F.lit(SOURCE_NAME))
    about = F.concat(F.lit(DESCRIPTION), F.when(F.col("cohorts") != "", F.concat(F.lit(". Cohorts: "), F.col("cohorts"))).otherwise(F.lit("")))
    day = F.lit(released).cast("date")
    return build_from_events(both, schemas.TARGET["cdm_source"], {
        "cdm_source_name": name, "cdm_source_abbreviation": F.lit(SOURCE_SHORT), "cdm_holder": name, "source_description": about, "cdm_etl_reference": F.lit(reference).cast("string"),
        "source_release_date": F.coalesce("made", day), "cdm_release_date": day, "cdm_version": F.lit(VERSION), "cdm_version_concept_id": F.lit(VERSION_CONCEPT), "vocabulary_version": F.lit(vocabulary_version),
    })
