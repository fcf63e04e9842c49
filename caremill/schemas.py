"""Tables as Spark schemas. A field that must be filled is not nullable; a primary key has metadata ``pk``."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(), "datetime": T.TimestampNTZType()}


def schema_of(text: str) -> T.StructType:
    """``name type`` for each field; ``!`` after a type that must be filled, ``*`` after that of the primary key."""
    fields = []
    for part in text.replace("\n", " ").split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, TYPES[kind.rstrip("!*")], kind[-1] not in "!*", {"pk": True} if kind.endswith("*") else {}))
    return T.StructType(fields)


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def primary_key(schema: T.StructType) -> str | None:
    return next((f.name for f in schema if f.metadata.get("pk")), None)


# Columns and types of the target tables, in their order.
TARGET = {
    "person": schema_of("""person_id long*, gender_concept_id long!, year_of_birth long!, month_of_birth long, day_of_birth long, birth_datetime datetime,
        race_concept_id long!, ethnicity_concept_id long!, location_id long, provider_id long, care_site_id long, person_source_value string,
        gender_source_value string, gender_source_concept_id long!, race_source_value string, race_source_concept_id long!,
        ethnicity_source_value string, ethnicity_source_concept_id long!"""),
    "visit_occurrence": schema_of("""visit_occurrence_id long*, person_id long!, visit_concept_id long!, visit_start_date date!, visit_start_datetime datetime,
        visit_end_date date, visit_end_datetime datetime, visit_type_concept_id long!, provider_id long, care_site_id long, visit_source_value string,
        visit_source_concept_id long!, admitted_from_concept_id long!, admitted_from_source_value string, discharged_to_concept_id long!,
        discharged_to_source_value string, preceding_visit_occurrence_id long"""),
    "condition_occurrence": schema_of("""condition_occurrence_id long*, person_id long!, condition_concept_id long!, condition_start_date date!,
        condition_start_datetime datetime, condition_end_date date, condition_end_datetime datetime, condition_type_concept_id long!,
        condition_status_concept_id long!, stop_reason string, provider_id long, visit_occurrence_id long, visit_detail_id long,
        condition_source_value string, condition_source_concept_id long!, condition_status_source_value string"""),
    "procedure_occurrence": schema_of("""procedure_occurrence_id long*, person_id long!, procedure_concept_id long!, procedure_date date!, procedure_datetime datetime,
        procedure_end_date date, procedure_end_datetime datetime, procedure_type_concept_id long!, modifier_concept_id long!, quantity long, provider_id long,
        visit_occurrence_id long, visit_detail_id long, procedure_source_value string, procedure_source_concept_id long!, modifier_source_value string"""),
    "drug_exposure": schema_of("""drug_exposure_id long*, person_id long!, drug_concept_id long!, drug_exposure_start_date date!, drug_exposure_start_datetime datetime,
        drug_exposure_end_date date!, drug_exposure_end_datetime datetime, verbatim_end_date date, drug_type_concept_id long!, stop_reason string, refills long,
        quantity double, days_supply long, sig string, route_concept_id long!, lot_number string, provider_id long, visit_occurrence_id long,
        visit_detail_id long, drug_source_value string, drug_source_concept_id long!, route_source_value string, dose_unit_source_value string"""),
    "measurement": schema_of("""measurement_id long*, person_id long!, measurement_concept_id long!, measurement_date date!, measurement_datetime datetime,
        measurement_time string, measurement_type_concept_id long!, operator_concept_id long!, value_as_number double, value_as_concept_id long!,
        unit_concept_id long!, range_low double, range_high double, provider_id long, visit_occurrence_id long, visit_detail_id long,
        measurement_source_value string, measurement_source_concept_id long!, unit_source_value string, unit_source_concept_id long!,
        value_source_value string, measurement_event_id long, meas_event_field_concept_id long!"""),
    "observation": schema_of("""observation_id long*, person_id long!, observation_concept_id long!, observation_date date!, observation_datetime datetime,
        observation_type_concept_id long!, value_as_number double, value_as_string string, value_as_concept_id long!, qualifier_concept_id long!,
        unit_concept_id long!, provider_id long, visit_occurrence_id long, visit_detail_id long, observation_source_value string,
        observation_source_concept_id long!, unit_source_value string, qualifier_source_value string, value_source_value string,
        observation_event_id long, obs_event_field_concept_id long!"""),
    "device_exposure": schema_of("""device_exposure_id long*, person_id long!, device_concept_id long!, device_exposure_start_date date!,
        device_exposure_start_datetime datetime, device_exposure_end_date date, device_exposure_end_datetime datetime, device_type_concept_id long!,
        unique_device_id string, production_id string, quantity long, provider_id long, visit_occurrence_id long, visit_detail_id long,
        device_source_value string, device_source_concept_id long!, unit_concept_id long!, unit_source_value string, unit_source_concept_id long!"""),
    "death": schema_of("""person_id long*, death_date date!, death_datetime datetime, death_type_concept_id long, cause_concept_id long, cause_source_value string,
        cause_source_concept_id long"""),
    "observation_period": schema_of("""observation_period_id long*, person_id long!, observation_period_start_date date!, observation_period_end_date date!,
        period_type_concept_id long!"""),
    "cdm_source": schema_of("""cdm_source_name string!, cdm_source_abbreviation string!, cdm_holder string!, source_description string,
        source_documentation_reference string, cdm_etl_reference string, source_release_date date!, cdm_release_date date!, cdm_version string,
        cdm_version_concept_id long!, vocabulary_version string!"""),
    "concept": schema_of("""concept_id long*, concept_name string!, domain_id string!, vocabulary_id string!, concept_class_id string!, standard_concept string,
        concept_code string!, valid_start_date date!, valid_end_date date!, invalid_reason string"""),
}
ERA = {
    "condition_era": schema_of("""condition_era_id long*, person_id long!, condition_concept_id long!, condition_era_start_date date!, condition_era_end_date date!,
        condition_occurrence_count long"""),
    "drug_era": schema_of("""drug_era_id long*, person_id long!, drug_concept_id long!, drug_era_start_date date!, drug_era_end_date date!, drug_exposure_count long,
        gap_days long"""),
}
VOCABULARY = {
    "concept_relationship": schema_of("concept_id_1 long!, concept_id_2 long!, relationship_id string!, valid_start_date date!, valid_end_date date!, invalid_reason string"),
    "concept_ancestor": schema_of("ancestor_concept_id long!, descendant_concept_id long!, min_levels_of_separation long!, max_levels_of_separation long!"),
    "vocabulary": schema_of("vocabulary_id string*, vocabulary_name string!, vocabulary_reference string, vocabulary_version string, vocabulary_concept_id long!"),
    "domain": schema_of("domain_id string*, domain_name string!, domain_concept_id long!"),
    "concept_class": schema_of("concept_class_id string*, concept_class_name string!, concept_class_concept_id long!"),
    "relationship": schema_of("relationship_id string*, relationship_name string!, is_hierarchical string!, defines_ancestry string!, reverse_relationship_id string!, relationship_concept_id long!"),
    "concept_synonym": schema_of("concept_id long!, concept_synonym_name string!, language_concept_id long!"),
    "drug_strength": schema_of("""drug_concept_id long!, ingredient_concept_id long!, amount_value double, amount_unit_concept_id long, numerator_value double,
        numerator_unit_concept_id long, denominator_value double, denominator_unit_concept_id long, box_size long, valid_start_date date!, valid_end_date date!,
        invalid_reason string"""),
}
EVENT = schema_of("""person_id long, visit_occurrence_id long, _start_date date, _end_date date, _concept_id long, _source_concept_id long, _source_value string,
    _value_as_number double, _value_source_value string, _value_as_concept_id long, _unit_concept_id long, _unit_source_value string, _status_concept_id long,
    _status_source_value string, _route_concept_id long, _route_source_value string, _modifier_source_value string""")

# Domains, their tables, and each event table's main concept and date.
DOMAIN_TABLE = {"Condition": "condition_occurrence", "Procedure": "procedure_occurrence", "Drug": "drug_exposure", "Measurement": "measurement", "Observation": "observation", "Device": "device_exposure"}
MAIN_CONCEPT = {"condition_occurrence": "condition_concept_id", "procedure_occurrence": "procedure_concept_id", "drug_exposure": "drug_concept_id", "measurement": "measurement_concept_id", "observation": "observation_concept_id", "device_exposure": "device_concept_id"}
MAIN_DATE = {"condition_occurrence": "condition_start_date", "procedure_occurrence": "procedure_date", "drug_exposure": "drug_exposure_start_date", "measurement": "measurement_date", "observation": "observation_date", "device_exposure": "device_exposure_start_date"}
#: Dates whose span is a person's observation period.
PERIOD_DATES = {
    "visit_occurrence": ["visit_start_date", "visit_end_date"], "condition_occurrence": ["condition_start_date", "condition_end_date"],
    "procedure_occurrence": ["procedure_date", "procedure_end_date"], "drug_exposure": ["drug_exposure_start_date", "drug_exposure_end_date"],
    "measurement": ["measurement_date"], "observation": ["observation_date"], "device_exposure": ["device_exposure_start_date", "device_exposure_end_date"],
}
