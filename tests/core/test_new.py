"""Splitting, streaming, bucketing, sketches and closures against plain versions; plans that must hold."""

import datetime as dt
import random
from collections import Counter

import pytest
from caremill.operators import coverage, intervals, keys, quality, uniqueness, vocabulary
from caremill.plans import inputs, refresh, registered, whole
from caremill.scratch import bucketed, by_one_key
from caremill.sources import writers
from caremill.streaming.arrivals import follow_source
from caremill.streaming.eras import MARK, streamed_intervals
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def spans(rng, n, keys=4, wide=3000):
    for _ in range(n):
        a = rng.randint(0, wide)
        yield rng.randint(1, keys), None if rng.random() < 0.03 else day(a), None if rng.random() < 0.1 else day(a + rng.choice((-4, 0, 1, 5, 30, 400, 900)))


@pytest.mark.parametrize("gap,days", [(0, 1), (0, 256), (30, 7), (30, 256), (400, 30)])
def test_split_intervals_are_merged_intervals(spark, gap, days):
    rng = random.Random(gap + days)
    df = spark.createDataFrame(list(spans(rng, 120)) + list(spans(rng, 40, 1)) * 2, "k int, start date, `end` date")
    got = intervals.split_intervals(df, ["k"], gap, {"n": F.lit(1).cast("long")}, days)
    want = intervals.merge_intervals(df, ["k"], gap, [F.count("*").alias("n")])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert intervals.split_intervals(df.limit(0), ["k"], gap, {"n": F.lit(1)}).collect() == []


def test_no_window_holds_a_whole_key(spark):
    df = spark.createDataFrame([(1, day(0), day(1))], "k int, start date, `end` date")
    windows = [x for x in plan_of(intervals.split_intervals(df, ["k"], 30, {"n": F.lit(1)})).split("\n") if " Window [" in x or "Window [" in x.strip()[:12]]
    assert windows and all("_slice" in x for x in windows)


def plain_closure(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    out = {}
    for a in {x for e in edges for x in e}:
        level, walk, least, most = 0, {a}, {}, {}
        while walk and level < 40:
            for x in walk:
                least.setdefault(x, level)
                most[x] = level
            walk, level = {y for x in walk for y in after.get(x, ())}, level + 1
        out |= {(a, x): (least[x], None if most[x] > 25 else most[x]) for x in least}
    return out


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (1, 3), (3, 4), (5, 4), (1, 2)], [(1, 2), (2, 3), (3, 1), (3, 4), (0, 1), (4, 5), (6, 5)], [(1, 1), (1, 2)], [(1, 2), (2, 1)]])
def test_closure(spark, edges):
    df = spark.createDataFrame([*edges, (None, 1), (1, None)], "parent_concept_id long, child_concept_id long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in intervals.closure_from_edges(df).collect()}
    assert got == plain_closure(edges)
    assert intervals.closure_from_edges(df.limit(0)).collect() == []


def test_closure_of_a_chain_that_is_too_long(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(6)], "parent_concept_id long, child_concept_id long")
    assert intervals.closure_from_edges(df, 6).count() == 28
    with pytest.raises(ValueError, match="more than 3"):
        intervals.closure_from_edges(df, 3)


@pytest.fixture
def export(tmp_path, spark):
    for source, text in (("a", "patient_id,sex\nP1,M\n"), ("b", 'patient_id,sex\nP2,""\nP3,\n')):
        (tmp_path / source).mkdir()
        (tmp_path / source / "patient.csv").write_text(text)
    for i in (1, 2):
        folder = tmp_path / "parts" / "patient.csv"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"part-{i}.csv").write_text(f"patient_id,sex\nQ{i},F\n")
    return f"file://{tmp_path}"


@pytest.mark.parametrize("source,want", [("a", [("P1", "M", "a")]), ("b", [("P2", "", "b"), ("P3", None, "b")]), ("parts", [("Q1", "F", "parts"), ("Q2", "F", "parts")]), ("*", [("P1", "M", "a"), ("P2", "", "b"), ("P3", None, "b"), ("Q1", "F", "parts"), ("Q2", "F", "parts")])])
def test_follow_files_and_folders(spark, export, source, want):
    name = f"followed_{'all' if source == '*' else source}"
    stream = follow_source(spark, export, "patient", ["patient_id", "sex"], source)
    stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table(name).collect())) == want


def test_streamed_intervals_with_late_rows_and_restarts(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, s, e) for k, s, e in spans(rng, 300, wide=900) if s]
    rows.sort(key=lambda r: (r[1] - day(0)).days + rng.randint(0, 60))  # late by up to 60 days
    schema = "k int, start date, `end` date"
    for i in range(5):
        part = rows[i * 60 : (i + 1) * 60] if i < 4 else rows[240:] + [(None, dt.date.fromisoformat(MARK), None)]
        spark.createDataFrame(part + ([(7, None, day(3))] if i == 1 else []), schema).write.mode("append").parquet(f"{tmp_path}/in")
        eras = streamed_intervals(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), ["k"], 10, "n", "90 days")
        eras.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        if i == 3:
            assert 0 < spark.read.parquet(f"{tmp_path}/out").count() < len(rows)  # closed eras come before the end
    whole = spark.createDataFrame([(k, s, max(s, e) if e else None) for k, s, e in rows] + [(7, None, day(3))], schema)
    want = intervals.merge_intervals(whole.withColumn("end", F.coalesce("end", "start")), ["k"], 10, [F.count("*").alias("n")])
    got = spark.read.parquet(f"{tmp_path}/out").select("k", "start", "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select("k", "start", "n").collect()))


def test_streamed_eras_of_many_files(spark, monkeypatch, tmp_path):
    """What arrives between two stops takes more than two batches, and the watermark leaves nothing of it behind."""
    start = F.expr("case when id % 97 > 0 then date_add(date'1995-01-01', cast(id * 37 % 1090 as int)) end")
    rows = spark.range(2800).select((F.col("id") % 20).alias("person_id"), (F.col("id") % 3).alias("condition_concept_id"), start.alias("condition_start_date"))
    rows = rows.withColumn("condition_end_date", F.expr("case when person_id > 2 then date_add(condition_start_date, cast(person_id as int) - 5) end"))
    monkeypatch.setattr(registered, "load", lambda spark, path, *names: [rows.repartition(140)])
    monkeypatch.setattr(whole, "scratch", lambda spark: f"file://{tmp_path}/stream")
    conf = {"spark.sql.files.openCostInBytes": "64m", "spark.sql.files.maxPartitionBytes": "64m"}  # a task for each file
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = registered.QUERIES["streamed_eras"][0](spark, SF).collect()
    finally:
        for k in conf:
            spark.conf.unset(k)
    want = intervals.condition_eras(rows).collect()
    assert len(list((tmp_path / "stream/arrived").glob("part-*"))) > 2 * 128
    assert Counter(map(str, got)) == Counter(map(str, want))


def test_heavy_values_are_exact(spark):
    rng = random.Random(3)
    texts = [f"v{min(rng.randint(0, 400), rng.randint(0, 400))}" for _ in range(4000)] + ["", None] * 50
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    count = sorted(((-n, t) for t, n in Counter(t for t in texts if t).items()))
    for tracked in (16, 64, 4096):  # with few counters everything is counted
        assert [(-r["rows"], r.t) for r in coverage.heavy_values(df, "t", 12, tracked).collect()] == count[:12]
    assert coverage.heavy_values(df.limit(0), "t").collect() == []
    assert len(coverage.heavy_values(df, "t", 1000).collect()) == len(count)


def test_written_counts(spark, tmp_path):
    path, n = writers.write_counted(spark.range(0, 5000, 1, 7).withColumnRenamed("id", "person_id"), str(tmp_path), "T")
    assert n == 5000 == spark.read.parquet(path).count()
    assert writers.write_counted(spark.range(0), str(tmp_path), "E")[1] == 0


def test_cleaning_in_buckets_shuffles_nothing(spark):
    names = ["patient", "encounter", "diagnosis", "procedure", "medication_ingredient", "lab_result", "vitals_signs"]
    tables = dict(zip(names, inputs.load(spark, SF, *names), strict=True))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with by_one_key(spark):
            for name, df in whole.cleaned_in_buckets(tables).items():
                assert "Exchange" not in plan_of(df), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_bucketed_keeps_rows(spark):
    df = spark.createDataFrame([(i % 3 or None, f"x{i}") for i in range(20)], "k int, v string")
    assert sorted(map(str, bucketed(df, "k").collect())) == sorted(map(str, df.collect()))


def test_concept_bitmaps(spark):
    df = spark.createDataFrame([(5, 0, 32768), (5, None, 32769), (-3, 7, 2_000_000_123), (None, 7, 5)], "a_concept_id long, b_concept_id long, c_concept_id long")
    known = spark.createDataFrame([(5, "S"), (7, None), (32769, "S"), (2_000_000_123, "C")], "concept_id long, standard_concept string")
    got = {r["column"]: (r.n_ids, r.n_known, r.n_standard) for r in quality.concept_counts(df, known).collect()}
    assert got == {"a_concept_id": (2, 1, 1), "b_concept_id": (1, 1, 0), "c_concept_id": (4, 3, 2)}
    assert "Generate" not in plan_of(quality.concept_bitmaps(df)) and "Generate" not in plan_of(vocabulary.referenced_concepts([df]))


def test_lookup_reads_each_table_a_few_times(spark):
    *tables, concepts, relationships = inputs.load(spark, SF, *whole.CODED, "concepts", "relationships")
    tables = dict(zip(whole.CODED, tables, strict=True))
    codes, units = vocabulary.build_lookup(concepts, relationships.select("concept_id_1", "concept_id_2"), vocabulary.collect_codes(tables), vocabulary.collect_units([tables["lab_result"], tables["vitals_signs"]]))
    assert plan_of(codes).count("Scan parquet") + plan_of(units).count("Scan parquet") <= 20


def test_patterns_meet_ids_by_their_beginnings(spark):
    checks = spark.createDataFrame([("Table_a.x",), ("field_b",), ("FIELD_bc",), ("z",), ("",)], "check_id string")
    accepted = spark.createDataFrame([("table_*", "1"), ("field_b", "2"), ("field_?c", "3"), ("*", "4"), ("field_bcd*", "5"), ("table_a+x", "6")], "pattern string, reason string")
    got = sorted((r.check_id, r.reason) for r in quality.matches(checks, accepted).collect())
    assert got == sorted([(c, "4") for c in ("Table_a.x", "field_b", "FIELD_bc", "z", "")] + [("Table_a.x", "1"), ("field_b", "2")] + [("FIELD_bc", "3")] )


KEYED = {"ordered": [[1, 2, 3], [4, 5], [6, 7, 9]], "repeats": [[1, 2, 2, 2], [3, 3], [4]], "shared": [[1, 2, 5], [5, 6], [3, 3, 9]], "nulls": [[None, None, 1], [None, 2]], "mixed": [[(i * 7919) % 211 for i in range(400)], [1000, 1000, 1001], [50, 2000]], "none": [[], []], "only nulls": [[None]]}


@pytest.mark.parametrize("name,kind", [(n, "long") for n in KEYED] + [("mixed", "string"), ("shared", "date")])
def test_ordered_keys(spark, tmp_path, name, kind):
    for part in KEYED[name]:
        keyed = spark.createDataFrame([(x,) for x in part], "k long").coalesce(1)
        keyed.select(F.date_add(F.lit("2000-01-01"), F.col("k").cast("int")).alias("k") if kind == "date" else F.lpad(F.col("k").cast("string"), 5, "0").alias("k") if kind == "string" else F.col("k")).write.mode("append").parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    want = sum(n - 1 for n in Counter(x for part in KEYED[name] for x in part).values())
    assert uniqueness.repeated_keys(df, "k").collect()[0][0] == want
    assert [r.n_bad for r in quality.check_ordered_key(df, "t", "k").collect()] == [n for n in [r.n_bad for r in quality.check_primary_key(df, "t", "k").collect()] if n]


def test_ranges_are_joined_beyond_a_number(spark):
    runs = spark.createDataFrame([(i * 10 + j, i * 10 + j + 3, 0, False, 0) for i in range(300) for j in (0, 2)] + [(5000, 5001, 4, False, 0)], "lo long, hi long, repeats long, mixed boolean, nulls long")
    ranges = uniqueness.shared_ranges(runs)
    assert len(ranges) <= uniqueness.RANGES and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert all(any(lo <= i * 10 and i * 10 + 5 <= hi for lo, hi in ranges) for i in range(300)) and ranges[-1][1] < 5000
    with pytest.raises(ValueError, match="no ranges"):
        uniqueness.key_runs(spark.range(1).selectExpr("cast(id as double) k"), "k")


def test_written_ids_are_checked_without_a_shuffle(spark, tmp_path):
    (conditions,) = inputs.load(spark, SF, "conditions")
    written = keys.record_ids(conditions, "condition_occurrence_id", ["person_id", "condition_start_date", "condition_concept_id"])
    writers.write_table(written, str(tmp_path), "condition_occurrence", 7)
    df = spark.read.parquet(f"{tmp_path}/condition_occurrence")
    assert uniqueness.shared_ranges(uniqueness.key_runs(df, "condition_occurrence_id")) == []
    assert "condition_occurrence_id" not in plan_of(uniqueness.repeated_keys(df, "condition_occurrence_id"))


def test_vocabulary_parts(spark, tmp_path):
    rows = [(str(i), v, f"c{i}") for i, v in enumerate(["A", "B", "C", None, "", "B", "A b/c=%", "none"])]
    concepts = spark.createDataFrame(rows, "concept_id string, vocabulary_id string, concept_code string")
    parts = vocabulary.vocabulary_parts(concepts, f"{tmp_path}/parts")
    assert sorted(map(str, parts.drop(vocabulary.PART).collect())) == sorted(map(str, concepts.collect()))
    wanted = spark.createDataFrame([("B",), (None,), ("",), ("B",), ("A b/c=%",), ("Z",), ("none",)], "vocabulary_id string")
    wanted.write.parquet(f"{tmp_path}/wanted")
    near = vocabulary.named_parts(parts, spark.read.parquet(f"{tmp_path}/wanted"))
    assert sorted(r.concept_id for r in near.collect()) == ["1", "5", "6", "7"]
    assert "dynamicpruning" in plan_of(near).lower()


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet") if not {x.split("-")[0] for x in p.relative_to(root).parts} & {"digests", "pending"}}


def test_only_changed_persons_are_made_again(spark, tmp_path):
    made, root = [], tmp_path / "out"

    def build(part):
        rows = part["t"].groupBy("p").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
        made.append(sorted(r.p or 0 for r in rows.collect()))
        return {"sums": rows, "copy": part["t"]}

    def run(rows, buckets=8):
        t = spark.createDataFrame(rows, "p long, x long")
        said = refresh.refresh({"t": t, "u": t.filter("x > 90")}, f"file://{root}", build, ["p"], buckets)
        want = t.groupBy("p").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
        assert sorted(map(str, spark.read.parquet(f"{root}/sums").drop("_bucket").collect())) == sorted(map(str, want.collect()))
        assert sorted(map(str, spark.read.parquet(f"{root}/copy").drop("_bucket").collect())) == sorted(map(str, t.collect()))
        return said

    rows = [(p, x) for p in range(1, 21) for x in (p, p + 1)] + [(None, 3)]
    run(rows)
    before = files_of(root)
    assert run(rows) == (0, 0) and files_of(root) == before
    assert run(list(reversed(rows))) == (0, 0)  # order says nothing
    assert run([r for r in rows if r[0] != 7] + [(3, 4), (30, None), (None, None)])[0] == 4
    assert made[-1] == [0, 3, 30]  # 7 is gone
    after = files_of(root)
    assert len(set(before.items()) & set(after.items())) > len(before) / 4
    assert run(rows[:1])[0] == 21 and run(rows)[0] == 21  # emptied buckets go and come back
    assert run(rows, 4)[1] == 4 and run(rows)[1] == 8 and run(rows) == (0, 0)


def test_a_run_that_broke_off_is_made_good(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    frame = lambda rows: {"t": spark.createDataFrame(rows, "p long, x long")}
    refresh.refresh(frame([(1, 1), (2, 2)]), root, dict, ["p"], 4)

    def breaks(part):
        yield_first = part["t"]
        return {"t": yield_first, "never": yield_first.select("p", F.raise_error(F.lit("lost")).cast("long").alias("x"))}

    with pytest.raises(Exception, match="lost"):
        refresh.refresh(frame([(1, 1), (2, 2), (9, 9)]), root, breaks, ["p"], 4)
    assert spark.read.parquet(f"{tmp_path}/out/t").count() == 3
    assert refresh.refresh(frame([(1, 1), (2, 2)]), root, dict, ["p"], 4) == (1, 1)  # 9 was written, but never noted as done
    assert sorted(r.p for r in spark.read.parquet(f"{tmp_path}/out/t").collect()) == [1, 2]


def test_digests(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, "a"), (2, "a", None), (2, "a", None), (3, "a", None)], "p long, x string, y string")
    got = {r.p: (r.n, r.a, r.b) for r in refresh.digests({"t": df}, ["p"]).collect()}
    once = refresh.digests({"t": df.filter("p = 2").limit(1)}, ["p"]).first()
    assert got[1][0] == got[2][0] == 2 and got[2][1:] == (2 * once.a, 2 * once.b)
    moved = refresh.digests({"t": df.filter("p = 1").select("p", F.col("y").alias("x"), F.lit("a").alias("y"))}, ["p"]).first()
    assert (moved.n, moved.a, moved.b) != got[1]
    assert {r.p: (r.n, r.a, r.b) for r in refresh.digests({"t": df.select("y", "p", "x").repartition(3)}, ["p"]).collect()} == got


def test_outcomes_of_checks_without_their_tables(spark):
    death = spark.createDataFrame([(1, None), (1, 5), (None, 5)], "person_id long, cause_concept_id long")
    issues = quality.validate({"death": death}, ordered=True)
    got = {(r.check, r.table): (r.outcome, r.n_issues, r.rows) for r in quality.check_outcomes(issues, {"death": death}).collect()}
    assert got["primary_key", "death"] == ("failed", 1, 3) and got["required", "death"] == ("failed", 1, 3)
    assert {k for k, v in got.items() if v[0] == "skipped"} == {("person_refs", "death"), ("concepts_exist", "death"), ("standard", "death"), ("coverage", "coverage")}
    assert got["tables", "death"] == ("passed", 0, 3) and got["tables", "person"] == ("failed", 1, None) and ("single_row", "cdm_source") not in got


def test_keys_in_order_give_the_same_issues(spark):
    rows = [(i // 2, None if i % 7 == 0 else i % 5) for i in range(60)]
    death = spark.createDataFrame(rows, "person_id long, cause_concept_id long").repartition(4)
    person = spark.createDataFrame([(i,) for i in range(28)], "person_id long")
    plain, ordered = (sorted(map(str, quality.validate({"death": death, "person": person}, ordered=o).collect())) for o in (False, True))
    assert plain == ordered and any("DUPLICATE_PRIMARY_KEY" in r for r in plain)
