"""The whole conversion: source exports and a vocabulary in, target tables, left-out rows and coverage out.

Between stages tables are written down once, so that a lost executor costs no more than a stage, and what several
stages read is not computed twice. Shuffles are on the person key, but for those on codes, which are few.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill import schemas
from caremill.functions.values import SOURCE_VOCABULARIES, UNIT_CODES, with_overrides
from caremill.operators import coverage as cover
from caremill.operators import events, intervals, keys, quality, vocabulary
from caremill.operators.cleaning import TABLE_DATES, clean_tables
from caremill.operators.entities import cdm_source, death, person, visit
from caremill.scratch import bucketed, by_one_key, release, settled
from caremill.sources import readers, writers

RECORDS = ("diagnosis", "procedure", "medication_ingredient", "lab_result", "vitals_signs")
OPTIONAL = ("encounter", *RECORDS)
VOCABULARY_FILES = ("concept", "concept_relationship", "vocabulary", "concept_ancestor", "domain", "concept_class", "relationship", "concept_synonym", "drug_strength")


def exists(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_typed(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Source tables in the types of the sources' dictionary, without derived columns."""
    listed = readers.dictionary_rows(readers.read_source(spark, root, "dictionary").drop("_source_id")).distinct()
    out = {}
    for name in ("patient", *OPTIONAL):
        if exists(spark, f"{root}/*/{name}.csv"):
            out[name] = readers.apply_types(readers.drop_derived(readers.read_source(spark, root, name)), readers.dictionary_of(listed, name))
    if "patient" not in out:
        raise ValueError("no source has a patient table")
    return out


def read_vocabulary(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    files = {n: readers.scan_vocabulary(spark, f"{root}/{n.upper()}.csv") for n in VOCABULARY_FILES if exists(spark, f"{root}/{n.upper()}.csv")}
    if missing := [n for n in writers.REQUIRED_VOCABULARY if n not in files]:
        raise ValueError(f"missing vocabulary tables: {', '.join(missing)}")
    return files


def read_concepts(spark: SparkSession, root: str, files: dict[str, DataFrame]) -> DataFrame:
    """All concepts: those of CONCEPT, and of CONCEPT_CPT4 where it is there."""
    more = readers.scan_vocabulary(spark, f"{root}/CONCEPT_CPT4.csv") if exists(spark, f"{root}/CONCEPT_CPT4.csv") else None
    return readers.scan_concepts(files["concept"], more)


def read_metadata(spark: SparkSession, root: str, name: str, columns: list[str]) -> DataFrame:
    if exists(spark, f"{root}/*/{name}.csv"):
        return readers.read_source(spark, root, name)
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))


def convert(spark: SparkSession, source_root: str, vocabulary_root: str, out_root: str, released: str, mapping: dict = SOURCE_VOCABULARIES, overrides: dict[str, str] = UNIT_CODES, values: dict | None = None, export: bool = False) -> dict[str, str]:
    """Convert ``<source_root>/<source>/<table>.csv`` with the vocabulary's files; return the folder of each table written.

    ``values``: concepts of source values that replace or add to the built-in ones, by map (see with_overrides()).
    ``export``: write the vocabulary's tables too, and all concepts in place of those that the other tables name.
    Row counts, referenced concepts that are missing, and unit codes without a concept go to ``notes``. Where CONCEPT_ANCESTOR is
    missing, ancestors are made from the relationships that RELATIONSHIP says define them; without that too there are no
    drug eras, and ``notes`` says so.
    """
    named = with_overrides(values or {})
    work = f"{spark.conf.get('spark.checkpoint.dir', None) or out_root + '/_work'}/convert-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.partitionBy(*by).parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    files = read_vocabulary(spark, vocabulary_root)
    version = readers.vocabulary_version(files["vocabulary"])
    # the text of the concepts is read once
    parts = vocabulary.vocabulary_parts(read_concepts(spark, vocabulary_root, files), f"{work}/concepts")
    concepts, maps = parts.drop(vocabulary.PART), readers.scan_maps_to(files["concept_relationship"])
    raw = {n: kept(t, f"raw/{n}") for n, t in read_typed(spark, source_root).items()}
    persons = kept(keys.person_index(raw), "persons")
    # in buckets of a person, cleaning and visit ids need no shuffle
    with by_one_key(spark):
        numbered = {n: bucketed(keys.attach_person_id(t, persons), "person_id") for n, t in raw.items()}
        clean = {n: bucketed(t, "person_id") for n, t in clean_tables(numbered).items()}
        if "encounter" in clean:
            visits = bucketed(keys.visit_map(clean["encounter"]), "person_id")
            clean |= {n: kept(keys.add_visit_ids(t, visits), f"clean/{n}") for n, t in clean.items() if n in TABLE_DATES}
    release(spark)

    records = {n: clean[n] for n in RECORDS if n in clean}
    measured = [records[n] for n in ("lab_result", "vitals_signs") if n in records and "units_of_measure" in records[n].columns]
    units = vocabulary.collect_units(measured) if measured else spark.createDataFrame([], "units_of_measure string")
    found, named_units = vocabulary.build_lookup(parts, maps, vocabulary.collect_codes(records, mapping), units, mapping, overrides)
    codes, named_units = kept(found, "codes"), kept(named_units, "units")
    adapters = {"diagnosis": lambda d: events.diagnosis_events(d, named), "procedure": events.procedure_events, "medication_ingredient": lambda d: events.medication_events(d, named), "lab_result": lambda d: events.lab_events(d, named_units, named), "vitals_signs": lambda d: events.vitals_events(d, named_units, named)}
    # joined once and laid out by domain: each target table reads its own part
    applied = {n: vocabulary.split_lookup(kept(vocabulary.join_lookup(t, codes, n), f"resolved/{n}", "_domain_id")) for n, t in records.items()}

    written: dict[str, str] = {}
    rows: dict[str, int] = {}

    def put(df: DataFrame, name: str) -> None:
        written[name], rows[name] = writers.write_counted(df, out_root, name)

    put(person(clean["patient"], named), "person")
    put(death(clean["patient"]), "death")
    put(visit(clean["encounter"], named) if "encounter" in clean else writers.empty_table(spark, schemas.TARGET["visit_occurrence"]), "visit_occurrence")
    routed = vocabulary.route_by_domain({n: mapped for n, (mapped, _) in applied.items()}, adapters) if applied else {n: writers.empty_table(spark, schemas.TARGET[n]) for n in schemas.DOMAIN_TABLE.values()}
    for name, df in routed.items():
        put(keys.order_table(df, name), name)
    writers.write_excluded({n: excluded for n, (_, excluded) in applied.items()}, out_root)
    table = lambda n: spark.read.parquet(written[n])
    put(intervals.observation_period({n: table(n) for n in schemas.PERIOD_DATES}), "observation_period")
    details = read_metadata(spark, source_root, "dataset_details", ["network_name", "date_created"])
    put(cdm_source(details, read_metadata(spark, source_root, "cohort_details", ["cohort_name"]), released, version), "cdm_source")
    closure = files.get("concept_ancestor")
    if closure is None and "relationship" in files:
        closure = kept(intervals.closure_from_edges(readers.ancestry_edges(files["concept_relationship"], files["relationship"])), "closure")
    pairs = kept(intervals.ingredient_map(concepts, closure, table("drug_exposure").select("drug_concept_id").filter("drug_concept_id <> 0")), "ingredients") if closure is not None else None
    for name, df in intervals.build_eras(table("condition_occurrence"), table("drug_exposure"), pairs).items():
        put(df, name)
    terms = readers.load_terminology([readers.read_source(spark, source_root, "standardized_terminology").select("code_system", "code", "code_description", "_source_id")]) if exists(spark, f"{source_root}/*/standardized_terminology.csv") else spark.createDataFrame([], "code_system string, code string, code_description string")
    referenced = kept(vocabulary.referenced_concepts([table(n) for n in written]), "referenced")
    if export:
        exported = {r["table"]: r["rows"] for r in writers.export_vocabulary(files | {"concept": concepts}, terms, out_root).collect()}
        written, rows = written | {n: f"{out_root}/{n}" for n in exported}, rows | exported
    else:
        put(vocabulary.concept_table(concepts, referenced, terms, mapping), "concept")
    said = [("rows", n, r) for n, r in rows.items()] + ([] if closure is not None else [("no_drug_eras", "CONCEPT_ANCESTOR and RELATIONSHIP are missing", 1)])
    numbers = [spark.createDataFrame(said, "kind string, name string, n long")]
    numbers.append(vocabulary.missing_concepts(referenced, concepts).select(F.lit("missing_concepts").alias("kind"), F.concat_ws(",", "examples").alias("name"), F.col("n_missing").alias("n")).filter("n > 0"))
    numbers.append(vocabulary.missing_unit_overrides(concepts, overrides).select(F.lit("unknown_unit_code").alias("kind"), F.col("concept_code").alias("name"), F.lit(1).cast("long").alias("n")))
    written["notes"] = f"{out_root}/notes"
    reduce(DataFrame.unionByName, numbers).coalesce(1).write.mode("overwrite").option("header", True).csv(written["notes"])
    if applied:
        parts = reduce(DataFrame.unionByName, (cover.record_coverage(records[n], n, codes) for n in records))
        written["coverage"] = writers.write_coverage(cover.coverage(parts), out_root)
    return written


def coverage_report(spark: SparkSession, source_root: str, vocabulary_root: str, mapping: dict = SOURCE_VOCABULARIES, overrides: dict[str, str] = UNIT_CODES) -> dict[str, DataFrame]:
    """How far a vocabulary covers an export, without converting it: every table of the report by name."""
    files, raw = read_vocabulary(spark, vocabulary_root), read_typed(spark, source_root)
    concepts, maps = read_concepts(spark, vocabulary_root, files), readers.scan_maps_to(files["concept_relationship"])
    records = {n: raw[n] for n in RECORDS if n in raw}
    counts, unit_counts = settled(cover.source_code_counts(records)), settled(cover.source_unit_counts(records)) if any("units_of_measure" in t.columns for t in records.values()) else None
    units = unit_counts.select("units_of_measure").dropna().distinct() if unit_counts else spark.createDataFrame([], "units_of_measure string")
    found, named_units = vocabulary.build_lookup(concepts, maps, counts.select(*vocabulary.KEYS).dropna(), units, mapping, overrides)
    codes = settled(found)
    mapped = settled(cover.mapped_codes(counts, codes, concepts, mapping))
    known = files["vocabulary"]
    out = {
        "code_systems": cover.code_system_pairs(counts, mapping), "vocabularies": cover.vocabulary_availability(known, concepts, mapping), "self_mapping": cover.self_mapping(mapped, maps),
        "by_code": cover.coverage_by_code(mapped), "by_row": cover.coverage_by_row(mapped), "totals": cover.coverage_totals(mapped), "target_domains": cover.target_domains(codes, counts),
        "multi_target": cover.top_multi_target(mapped), "unmapped_by_reason": cover.unmapped_by_reason(mapped, known), "top_unmapped": cover.top_unmapped(mapped, known),
    }
    if unit_counts:
        marked = cover.marked_units(unit_counts, named_units)
        out |= {"units": cover.unit_summary(marked), "top_units": cover.top_units(marked), "top_unmatched_units": cover.top_units(marked, unmatched=True)}
    if "lab_result_text_val" in (records["lab_result"].columns if "lab_result" in records else []):
        out["texts"] = cover.top_text_values(cover.source_text_counts(records["lab_result"]))
    return out


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Written tables by name."""
    known = [*schemas.TARGET, *schemas.ERA, *schemas.VOCABULARY]
    return {n: spark.read.parquet(f"{root}/{n}") for n in known if exists(spark, f"{root}/{n}")}


def read_coverage(spark: SparkSession, root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """Written coverage and the counts of left-out rows, where they are there."""
    if not exists(spark, f"{root}/coverage"):
        return None, None
    coverage = spark.read.option("header", True).schema("source_table string, code_system string, outcome string, rows long, rows_pct double, codes long, codes_pct double").csv(f"{root}/coverage")
    parts = [spark.read.parquet(f"{root}/excluded/{n}").select(F.lit(n).alias("source_table"), "exclusion_reason") for n in RECORDS if exists(spark, f"{root}/excluded/{n}")]
    return coverage, quality.excluded_counts(reduce(DataFrame.unionByName, parts)) if parts else None


def validate(spark: SparkSession, root: str) -> DataFrame:
    """Issues of the tables that convert() wrote; none means that all checks passed. Keys are checked file by file."""
    return quality.validate(read_tables(spark, root), *read_coverage(spark, root), ordered=True)


def validation_report(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``issues`` (see validate()), ``checks`` (each with its outcome, issues and rows) and ``totals`` by outcome."""
    tables, said = read_tables(spark, root), read_coverage(spark, root)
    issues = settled(quality.validate(tables, *said, ordered=True))
    checks = settled(quality.check_outcomes(issues, tables, *said))
    return {"issues": issues, "checks": checks, "totals": quality.outcome_totals(checks)}
