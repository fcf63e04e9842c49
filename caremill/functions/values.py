"""Column functions: value maps, optional columns, codes, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source values and the concepts they stand for.
CONCEPTS = {
    "gender": {"M": 8507, "F": 8532},
    "race": {"American Indian or Alaska Native": 8657, "Asian": 8515, "Black or African American": 8516, "Native Hawaiian or Other Pacific Islander": 8557, "White": 8527},
    "ethnicity": {"Hispanic or Latino": 38003563, "Not Hispanic or Latino": 38003564},
    "visit_type": {"IMP": 9201, "ACUTE": 9201, "NONAC": 9201, "EMER": 9203, "AMB": 9202, "SS": 9202, "OBSENC": 9202, "PRENC": 9202, "HH": 581476, "VR": 722455, "FLD": 581478},
    "condition_status": {"P": 32902, "S": 32908},
    "route": {"Oral Product": 4132161, "Injectable Product": 706184, "Inhalant Product": 40486069, "Topical Product": 4263689, "Rectal Product": 4290759, "Ophthalmic Product": 4184451, "Nasal Product": 4262914, "Otic Product": 4023156, "Drug Implant Product": 706185, "Vaginal Product": 4057765, "Urethral Product": 4233974, "Intraperitoneal Product": 4243022},
    "lab_value": {"Negative": 9189, "Positive": 9191},
}
UNIT_CODES = {"U/L": "[U]/L", "mL/min/{1.73_m2}": "mL/min/(173.10*-2.m2)", "[IU]/L": "[iU]/L", "[IU]/mL": "[iU]/mL", "U/mL": "[U]/mL", "{Ratio}": "{ratio}", "[pH]": "pH", "g/l": "g/L", "ug/(24.H)": "ug/(24.h)"}
SOURCE_VOCABULARIES = {
    "diagnosis": {"ICD-10-CM": "ICD10CM", "ICD-9-CM": "ICD9CM"},
    "procedure": {"ICD-9-CM": "ICD9Proc", "ICD-10-PCS": "ICD10PCS", "CPT": "CPT4", "HCPCS": "HCPCS", "CVX": "CVX", "VA": "VA Class"},
    "medication_ingredient": {"RxNorm": "RxNorm"},
    "lab_result": {"LOINC": "LOINC", "TNX": None},
    "vitals_signs": {"LOINC": "LOINC", "TNX": None},
}
#: Concept of records that come from health records; the concept of what is not known.
EHR_TYPE, NO_CONCEPT = 32817, 0


def with_overrides(own: dict[str, dict[str, int | None]], maps: dict[str, dict[str, int]] = CONCEPTS) -> dict[str, dict[str, int]]:
    """The value maps with the user's values added or put in place; a value without a concept is taken out. An unknown map is an error."""
    if unknown := sorted(set(own) - set(maps)):
        raise ValueError(f"unknown value maps: {', '.join(unknown)}")
    return {name: {k: v for k, v in (values | own.get(name, {})).items() if v is not None} for name, values in maps.items()}


def map_value(value: Column, mapping: dict[str, int]) -> Column:
    """The value's concept; null and unknown values have NO_CONCEPT."""
    if not mapping:
        return F.lit(NO_CONCEPT).cast("long")
    pairs = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, value.cast("string")), F.lit(NO_CONCEPT)).cast("long")


def optional_column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def optional_concept(df: DataFrame, name: str, mapping: dict[str, int]) -> Column:
    return map_value(F.col(name), mapping) if name in df.columns else F.lit(NO_CONCEPT).cast("long")


def qualified_code(system: Column, code: Column) -> Column:
    """``system:code``; the bare code where the system is null or empty; null where the code is."""
    return F.when(system.isNotNull() & (system != ""), F.concat(system, F.lit(":"), code)).otherwise(code.cast("string"))


def parse_yyyymm(value: Column) -> Column:
    """First day of the month of six digits; null for anything else."""
    text = value.cast("string")
    return F.when(text.rlike("^[0-9]{6}$"), F.try_to_date(F.concat(text, F.lit("01")), "yyyyMMdd"))


def parse_yyyymmdd(value: Column) -> Column:
    """Date of eight digits; null for anything else."""
    return F.when(value.rlike("^[0-9]{8}$"), F.try_to_date(value, "yyyyMMdd"))


def dictionary_type(kind: str) -> str:
    """A dictionary's type without its size, in capitals."""
    return kind.strip().upper().split("(")[0].strip()


def dictionary_cast(value: Column, kind: str) -> Column:
    """A string as its dictionary type; null if it doesn't parse. Unknown types stay strings."""
    name = dictionary_type(kind)
    if name == "DATE":
        return parse_yyyymmdd(value)
    return value.try_cast({"BIGINT": "bigint", "DECIMAL": "double"}.get(name, "string"))
