"""Interval merging, eras and observation periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremill import schemas
from caremill.operators.events import build_from_events
from caremill.operators.keys import record_ids
from caremill.scratch import settled

#: Days between two stretches of one era; vocabularies of ingredients.
ERA_GAP = 30
#: Days of a slice in which a key's intervals are merged by themselves.
SLICE_DAYS = 256
INGREDIENT_CLASS, INGREDIENT_VOCABULARIES, PERIOD_TYPE = "Ingredient", ("RxNorm", "RxNorm Extension"), 32817


def merge_intervals(df: DataFrame, keys: list[str], gap: int, aggregates: list[Column]) -> DataFrame:
    """Intervals (start, end) of a key that start at most ``gap`` days after all earlier ones have ended, as one.

    Returns keys, start, end and the aggregates. An interval without a start is one by itself. One shuffle on the keys; a window
    in order of start, those without one last.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("start").asc_nulls_last(), F.col("end").asc_nulls_last())
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.datediff("start", reach) <= gap, 0).otherwise(1))
    grouped = marked.withColumn("_era", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "_era").agg(F.min("start").alias("start"), F.max("end").alias("end"), *aggregates).drop("_era")


def split_intervals(df: DataFrame, keys: list[str], gap: int, sums: dict[str, Column], days: int = SLICE_DAYS) -> DataFrame:
    """merge_intervals() with a key's rows in many tasks: keys, start, end and the sums by name.

    A key's time is cut into slices of ``days``. The intervals that start in a slice are merged by themselves. What goes from
    slice to slice is one row a slice: how far its intervals reach, and which era is the last that begins in it. An
    interval that a slice before reaches belongs to the last era begun before it. Two shuffles: rows by key and slice,
    then a row for each key and slice, with at most ``days`` merged intervals. No window holds a whole key. An interval without a start is one by
    itself and meets no other.
    """
    named = df.select(*keys, "start", "end", *(c.alias(n) for n, c in sums.items()))
    part = [*keys, "_slice"]
    sliced = named.filter("start is not null").withColumn("_slice", F.floor(F.unix_date("start") / days))
    islands = merge_intervals(sliced, part, gap, [F.sum(n).alias(n) for n in sums])
    inorder = F.array_sort(F.collect_list(F.struct("start", F.col("end").isNull().alias("_open"), "end", *sums)))
    slices = islands.groupBy(*part).agg(F.max("end").alias("_reach"), inorder.alias("_islands"))
    w = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.withColumn("_before", F.max("_reach").over(w))
    held = lambda x: F.coalesce(F.datediff(x, F.col("_before")) <= gap, F.lit(False))
    last = F.when(~held(F.element_at("_islands", -1)["start"]), F.struct("_slice", F.size("_islands").alias("_nth")))
    eras = before.withColumn("_begun", last).withColumn("_last", F.max("_begun").over(w))
    eras = eras.select(*keys, "_slice", "_before", "_last", F.posexplode("_islands").alias("_nth", "_x")).select("*", "_x.*")
    era = F.when(held(F.col("start")), F.col("_last")).otherwise(F.struct("_slice", (F.col("_nth") + 1).alias("_nth")))
    whole = eras.withColumn("_era", era).groupBy(*keys, "_era").agg(F.min("start").alias("start"), F.max("end").alias("end"), *(F.sum(n).alias(n) for n in sums))
    return whole.drop("_era").unionByName(named.filter("start is null"))


def condition_spans(conditions: DataFrame) -> DataFrame:
    """person_id, condition_concept_id, start, end of condition records; a record lasts a day at least."""
    start, end = F.col("condition_start_date"), F.col("condition_end_date")
    return conditions.select("person_id", "condition_concept_id", start.alias("start"), F.greatest(F.coalesce(end, F.date_add(start, 1)), start).alias("end"))


def condition_eras(conditions: DataFrame) -> DataFrame:
    """person_id, condition_concept_id, condition_era_start_date, condition_era_end_date, condition_occurrence_count.

    A record without a start date is an era by itself.
    """
    spans = condition_spans(conditions.filter("condition_concept_id <> 0"))
    eras = split_intervals(spans, ["person_id", "condition_concept_id"], ERA_GAP, {"condition_occurrence_count": F.lit(1).cast("long")})
    return eras.withColumnsRenamed({"start": "condition_era_start_date", "end": "condition_era_end_date"})


def drug_eras(exposures: DataFrame, ingredients: DataFrame) -> DataFrame:
    """person_id, drug_concept_id (of the ingredient), drug_era_start_date, drug_era_end_date, drug_exposure_count, gap_days.

    Exposures that touch are merged first, so that gap_days is the length of an era without what they cover.
    An exposure without a start date is an era by itself, without gap_days.
    """
    start = F.col("drug_exposure_start_date")
    end = F.coalesce(F.col("drug_exposure_end_date"), F.date_add(start, F.col("days_supply").cast("int")), F.date_add(start, 1))
    key = ["person_id", "ingredient_concept_id"]
    spans = exposures.join(ingredients, "drug_concept_id").select(*key, start.alias("start"), F.greatest(end, start).alias("end"))
    stretches = split_intervals(spans, key, 0, {"n": F.lit(1).cast("long")})
    eras = split_intervals(stretches, key, ERA_GAP, {"drug_exposure_count": F.col("n"), "_days": F.datediff("end", "start").cast("long")})
    return eras.select("person_id", F.col("ingredient_concept_id").alias("drug_concept_id"), F.col("start").alias("drug_era_start_date"), F.col("end").alias("drug_era_end_date"), "drug_exposure_count", (F.datediff("end", "start") - F.col("_days")).cast("long").alias("gap_days"))


def ingredient_map(concepts: DataFrame, closure: DataFrame, drugs: DataFrame) -> DataFrame:
    """Distinct (drug_concept_id, ingredient_concept_id): standard ingredients above each drug, and itself if it is one.

    The closure is read once and reduced by two semi joins; Spark broadcasts their sides when they are small.
    """
    wanted = drugs.select("drug_concept_id").distinct()
    ingredients = concepts.filter((F.col("standard_concept") == "S") & (F.col("concept_class_id") == INGREDIENT_CLASS) & F.col("vocabulary_id").isin(*INGREDIENT_VOCABULARIES)).select(F.col("concept_id").cast("long").alias("ingredient_concept_id")).distinct()
    pairs = closure.select(F.col("descendant_concept_id").cast("long").alias("drug_concept_id"), F.col("ancestor_concept_id").cast("long").alias("ingredient_concept_id"))
    above = pairs.join(wanted, "drug_concept_id", "left_semi").join(ingredients, "ingredient_concept_id", "left_semi")
    itself = wanted.join(ingredients, F.col("drug_concept_id") == F.col("ingredient_concept_id"), "left_semi").select("drug_concept_id", F.col("drug_concept_id").alias("ingredient_concept_id"))
    return above.select("drug_concept_id", "ingredient_concept_id").unionByName(itself).distinct()


def closure_from_edges(edges: DataFrame, most: int = 1000) -> DataFrame:
    """ancestor_concept_id, descendant_concept_id, min_levels_of_separation, max_levels_of_separation of the pairs that edges
    (parent_concept_id, child_concept_id) connect, and of each concept with itself at 0.

    Round k extends the pairs that a path of k - 1 edges connects by one edge; equal pairs meet, so a round has at most as many
    rows as the closure. The least distance needs new pairs alone and ends on cycles. The greatest is looked for without the concepts that lie on
    cycles; where a path can go through one of those, there is none (null). More than ``most`` rounds are an error.
    """
    step = edges.select(F.col("parent_concept_id").cast("long").alias("a"), F.col("child_concept_id").cast("long").alias("d")).dropna()
    loops, step = step.filter("a = d").select("a"), settled(step.filter("a <> d").distinct())
    onward = step.select(F.col("a").alias("d"), F.col("d").alias("_next"))

    def rounds(first: DataFrame, along: DataFrame, new_only: bool) -> DataFrame:
        """a, d, level of the pairs of each round; with ``new_only`` of those that no round before had."""
        fresh = settled(first.select("a", "d", F.lit(1).alias("level")))
        found = fresh
        for level in range(2, most + 2):
            longer = fresh.join(along, "d").select("a", F.col("_next").alias("d")).distinct()
            fresh = settled((longer.join(found, ["a", "d"], "left_anti") if new_only else longer).withColumn("level", F.lit(level)))
            if fresh.isEmpty():
                return found
            found = found.unionByName(fresh)
        raise ValueError(f"paths of more than {most} edges")

    least = settled(rounds(step, onward, True))
    cyclic = settled(least.filter("a = d").select("a").unionByName(loops).distinct())
    free = lambda df, c: df.join(cyclic.select(F.col("a").alias(c)), c, "left_anti")
    longest = rounds(free(free(step, "a"), "d"), free(free(onward, "d"), "_next"), False).groupBy("a", "d").agg(F.max("level").alias("most"))
    above, below = least.join(cyclic.withColumnRenamed("a", "d"), "d", "left_semi"), least.join(cyclic, "a", "left_semi")
    itself = cyclic.select("a", F.col("a").alias("d"))
    through = above.select("a", F.col("d").alias("_c")).join(below.select(F.col("a").alias("_c"), "d"), "_c").select("a", "d")
    endless = through.unionByName(above.select("a", "d")).unionByName(below.select("a", "d")).unionByName(itself).distinct().withColumn("_endless", F.lit(True))
    nodes = step.select("a").unionByName(step.select(F.col("d").alias("a"))).unionByName(loops).distinct()
    zero = nodes.select("a", F.col("a").alias("d"), F.lit(0).alias("least"))
    pairs = zero.unionByName(least.filter("a <> d").select("a", "d", F.col("level").alias("least")))
    joined = pairs.join(longest, ["a", "d"], "left").join(endless, ["a", "d"], "left")
    greatest = F.when(F.col("_endless").isNull(), F.coalesce("most", F.lit(0)))
    return joined.select(F.col("a").alias("ancestor_concept_id"), F.col("d").alias("descendant_concept_id"), F.col("least").alias("min_levels_of_separation"), greatest.alias("max_levels_of_separation"))


def ingredient_coverage(exposures: DataFrame, ingredients: DataFrame) -> DataFrame:
    """n_rows of exposures and n_covered whose drug has an ingredient."""
    per_drug = exposures.groupBy("drug_concept_id").agg(F.count("*").alias("n"))
    marked = per_drug.join(ingredients.select(F.col("drug_concept_id").alias("_d")).distinct(), F.col("drug_concept_id") == F.col("_d"), "left")
    return marked.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("_d").isNotNull(), F.col("n"))), F.lit(0)).alias("n_covered"))


def build_eras(conditions: DataFrame | None, exposures: DataFrame | None, ingredients: DataFrame | None) -> dict[str, DataFrame]:
    """Both era tables, numbered by person, concept and start; the tables given decide which there are."""
    out = {}
    if conditions is not None:
        out["condition_era"] = condition_eras(conditions)
    if exposures is not None and ingredients is not None:
        out["drug_era"] = drug_eras(exposures, ingredients)
    for name, eras in out.items():
        concept = "condition_concept_id" if name == "condition_era" else "drug_concept_id"
        numbered = record_ids(build_from_events(eras, schemas.ERA[name], {}), f"{name}_id", ["person_id", concept, f"{name}_start_date"])
        out[name] = numbered.select(*(f.name for f in schemas.ERA[name]))
    return out


def observation_period(tables: dict[str, DataFrame]) -> DataFrame:
    """One period per person: from the first to the last date of its records. Tables are reduced to a row per person first."""
    parts = []
    for name, dates in schemas.PERIOD_DATES.items():
        if name in tables:
            first, last = (F.least(*dates), F.greatest(*dates)) if len(dates) > 1 else (F.col(dates[0]),) * 2
            parts.append(tables[name].select("person_id", first.alias("s"), last.alias("e")).groupBy("person_id").agg(F.min("s").alias("s"), F.max("e").alias("e")))
    whole = reduce(DataFrame.unionByName, parts).groupBy("person_id").agg(F.min("s").alias("s"), F.max("e").alias("e")).filter("s is not null")
    return build_from_events(whole, schemas.TARGET["observation_period"], {"observation_period_id": F.col("person_id"), "observation_period_start_date": F.col("s"), "observation_period_end_date": F.col("e"), "period_type_concept_id": F.lit(PERIOD_TYPE)})
