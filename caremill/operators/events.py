"""Records of one source table as domain-neutral events, and events as rows of a target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremill import schemas
from caremill.functions.values import CONCEPTS, EHR_TYPE, NO_CONCEPT, optional_column, optional_concept, qualified_code


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; a missing one is an error."""
    if missing := [f.name for f in schema if f.name not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def build_from_events(events: DataFrame, schema: T.StructType, columns: dict[str, Column]) -> DataFrame:
    """Each target column is the given expression, else the column of that name, else null."""
    pick = lambda name: columns[name] if name in columns else optional_column(events, name)
    return events.select(*(pick(f.name).cast(f.dataType).alias(f.name) for f in schema))


def event_projection(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Events of a resolved source table. Concepts that neither is given nor there are 0; other such columns are null."""
    concept = F.lit(NO_CONCEPT).cast("long")
    shared = {"_concept_id", "_source_concept_id"}
    extra = {f.name: concept for f in schemas.EVENT if f.name.endswith("_concept_id") and f.name not in columns and f.name not in shared}
    return build_from_events(df, schemas.EVENT, columns | extra)


def diagnosis_events(df: DataFrame, maps: dict = CONCEPTS) -> DataFrame:
    flag = "principal_diagnosis_indicator"
    return event_projection(df, {"_start_date": F.col("date"), "_source_value": qualified_code(F.col("code_system"), F.col("code")), "_status_concept_id": optional_concept(df, flag, maps["condition_status"]), "_status_source_value": optional_column(df, flag)})


def procedure_events(df: DataFrame) -> DataFrame:
    return event_projection(df, {"_start_date": F.col("date"), "_source_value": qualified_code(F.col("code_system"), F.col("code")), "_modifier_source_value": optional_column(df, "modifier_1")})


def medication_events(df: DataFrame, maps: dict = CONCEPTS) -> DataFrame:
    end = F.coalesce(optional_column(df, "end_date", "date"), F.col("start_date"))
    return event_projection(df, {"_start_date": F.col("start_date"), "_end_date": end, "_source_value": F.col("code"), "_route_concept_id": optional_concept(df, "route", maps["route"]), "_route_source_value": optional_column(df, "route")})


def result_events(df: DataFrame, units: DataFrame, number: str, text: str, maps: dict = CONCEPTS) -> DataFrame:
    """Results with number, text and unit; ``units``: units_of_measure, unit_concept_id, of bounded size by nature."""
    found = units.select(F.col("units_of_measure").alias("_unit"), F.col("unit_concept_id").alias("_unit_id"))
    joined = df.join(found, optional_column(df, "units_of_measure") == F.col("_unit"), "left")
    said = optional_column(df, text)
    return event_projection(joined, {
        "_start_date": F.col("date"), "_source_value": F.col("code"), "_value_as_number": optional_column(df, number, "double"), "_value_source_value": F.nullif(said, F.lit("")),
        "_value_as_concept_id": optional_concept(df, text, maps["lab_value"]), "_unit_concept_id": F.coalesce("_unit_id", F.lit(NO_CONCEPT)), "_unit_source_value": optional_column(df, "units_of_measure"),
    })


def lab_events(df: DataFrame, units: DataFrame, maps: dict = CONCEPTS) -> DataFrame:
    return result_events(df, units, "lab_result_num_val", "lab_result_text_val", maps)


def vitals_events(df: DataFrame, units: DataFrame, maps: dict = CONCEPTS) -> DataFrame:
    return result_events(df, units, "value", "text_value", maps)


#: What the columns of each target table are taken from; columns named here alone are 0 or the record type.
FROM_EVENT = {
    "condition_occurrence": {"condition_concept_id": "_concept_id", "condition_start_date": "_start_date", "condition_status_concept_id": "_status_concept_id", "condition_source_value": "_source_value", "condition_source_concept_id": "_source_concept_id", "condition_status_source_value": "_status_source_value"},
    "procedure_occurrence": {"procedure_concept_id": "_concept_id", "procedure_date": "_start_date", "procedure_source_value": "_source_value", "procedure_source_concept_id": "_source_concept_id", "modifier_source_value": "_modifier_source_value"},
    "drug_exposure": {"drug_concept_id": "_concept_id", "drug_exposure_start_date": "_start_date", "route_concept_id": "_route_concept_id", "drug_source_value": "_source_value", "drug_source_concept_id": "_source_concept_id", "route_source_value": "_route_source_value"},
    "measurement": {"measurement_concept_id": "_concept_id", "measurement_date": "_start_date", "value_as_number": "_value_as_number", "value_as_concept_id": "_value_as_concept_id", "unit_concept_id": "_unit_concept_id", "measurement_source_value": "_source_value", "measurement_source_concept_id": "_source_concept_id", "unit_source_value": "_unit_source_value", "value_source_value": "_value_source_value"},
    "observation": {"observation_concept_id": "_concept_id", "observation_date": "_start_date", "value_as_number": "_value_as_number", "value_as_string": "_value_source_value", "value_as_concept_id": "_value_as_concept_id", "unit_concept_id": "_unit_concept_id", "observation_source_value": "_source_value", "observation_source_concept_id": "_source_concept_id", "unit_source_value": "_unit_source_value", "value_source_value": "_value_source_value"},
    "device_exposure": {"device_concept_id": "_concept_id", "device_exposure_start_date": "_start_date", "device_source_value": "_source_value", "device_source_concept_id": "_source_concept_id"},
}
RECORD_TYPE = {"condition_occurrence": "condition_type_concept_id", "procedure_occurrence": "procedure_type_concept_id", "drug_exposure": "drug_type_concept_id", "measurement": "measurement_type_concept_id", "observation": "observation_type_concept_id", "device_exposure": "device_type_concept_id"}


def build_table(events: DataFrame, name: str) -> DataFrame:
    """Rows of a target table from its events. Required concepts without a source are 0; a drug exposure without end ends when it starts."""
    schema, source = schemas.TARGET[name], FROM_EVENT[name]
    columns = {f.name: F.lit(NO_CONCEPT) for f in schema if f.name.endswith("_concept_id") and not f.nullable and f.name not in source}
    columns |= {target: F.col(c) for target, c in source.items()} | {RECORD_TYPE[name]: F.lit(EHR_TYPE)}
    if name == "drug_exposure":
        columns["drug_exposure_end_date"] = F.coalesce("_end_date", "_start_date")
    return build_from_events(events, schema, columns)
