"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing columns: for every operator."""

import hashlib

import corpus_pipeline
import pytest
from caremill.llm import bpe, chat_format, decontamination, exact_dedup, html_extract, language_id, license_scan, lm_score, near_dedup, substring_dedup
from caremill.llm.common import settled

CLASH = "_row long, _class long, _doc string, h16 long, n_words string, kept string, g1 long, name string, b string, a string, pos int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
SAME = " ".join(f"w{i}" for i in range(60))
TEXTS = [(1, None), (2, ""), (3, SAME), (4, SAME), (4, SAME), (None, "no id here"), (None, None), (5, " \n\t "), (6, "x" * 200_000), (7, "Ünï " * 60_000), (8, "..."), (9, "under the MIT license")]


def docs_of(spark, texts):
    return spark.createDataFrame([(d, t, "en" if i % 2 else None, None, None, 7, 8, "x", 9, "y", None, 1, "n", "b", "a", 3) for i, (d, t) in enumerate(texts)], SCHEMA)


def bench_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


BENCH = [(1, None), (None, "a b"), (2, ""), (3, "..."), (4, "w1 w2 w3"), (4, "w5 w6"), (5, SAME), (6, SAME)]


def operators(spark):
    bench, path = bench_of(spark, BENCH), bpe.tokenizer_path()
    return {
        "decontamination": lambda d: decontamination.contamination(d, bench),
        "language_id": lambda d: language_id.predict(d, language_id.train(d, epochs=1)),
        "license_scan": license_scan.scan_licenses,
        "exact_dedup": exact_dedup.exact_dedup,
        "lm_score": lambda d: lm_score.score(d, lm_score.learn(d)),
        "bpe": lambda d: bpe.coded(d, path, bpe.build_lexicon(d, path)),
        "substring_dedup": substring_dedup.substring_dedup,
        "near_dedup": near_dedup.near_dedup,
    }


NAMES = ["decontamination", "language_id", "license_scan", "exact_dedup", "lm_score", "bpe", "substring_dedup", "near_dedup"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name):
    rows = operators(spark)[name](docs_of(spark, TEXTS)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d) for d, _ in TEXTS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark)[name](docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_only_nulls(spark, name):
    assert len(operators(spark)[name](docs_of(spark, [(None, None), (None, None)])).collect()) == 2


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    bench_of(spark, BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    for texts in (TEXTS, []):
        docs = docs_of(spark, texts)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = settled(stage(spark, docs, str(tmp_path)))
            assert kept.columns == docs.columns
            assert {r[0] for r in kept.select("doc_id").collect()} <= {d for d, _ in texts}
            docs = kept
        assert docs.count() == (0 if not texts else docs.count())


def test_exact_dedup_of_odd_rows(spark):
    rows = exact_dedup.exact_dedup(docs_of(spark, TEXTS)).collect()
    empty = [r for r in rows if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert len(empty) == 3 and sum(r.kept for r in empty) == 1 and {r.keep_id for r in empty} == {2}
    same = [r for r in rows if r.text_sha256 == hashlib.sha256(SAME.encode()).hexdigest()]
    assert [r.group_size for r in same] == [3] * 3 and sum(r.kept for r in same) == 1 and {r.keep_id for r in same} == {4}
    left = exact_dedup.drop_copies(docs_of(spark, TEXTS)).collect()
    assert sorted(str(r.doc_id) for r in left if r.text == SAME) == ["4"] and len(left) == 8


def test_near_dedup_of_odd_rows(spark):
    rows = near_dedup.near_dedup(docs_of(spark, TEXTS)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size, r.kept) for r in rows if r.doc_id in (3, 4)) == [(3, 3, 3, True), (4, 3, 3, False), (4, 3, 3, False)]
    assert all(r.kept and r.class_size == 1 for r in rows if r.doc_id in (1, 2, 5, 8))


def test_pages_and_conversations(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<p>" + "word " * 100_000, "x"), (2, "u", "<", "x"), (3, "u", "<!-- <p>a</p>", "x")], "page_id long, url string, html string, text string")
    rows = html_extract.extract(pages, html_extract.learned_weights(pages)).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.n_chars) for r in rows) == [(False, 1, 0), (False, 2, 1), (False, 2, 499_999), (False, 3, 0), (True, 0, 0)]
    none = html_extract.extract(pages.limit(0), html_extract.learned_weights(pages.limit(0)))
    assert none.collect() == []
    turns = spark.createDataFrame([(1, 0, None, None, 1), (1, 0, None, None, 1), (None, None, "assistant", "x", 1), (2, 1, "assistant", "b" * 300_000, 1), (2, 0, "assistant", "", 1)], "conv_id long, turn long, role string, text string, n_turns int")
    got = {r.conv_id: r for r in chat_format.digest(chat_format.format_conversations(turns)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {1: (2, 0), None: (1, 1), 2: (2, 300_000)}
    assert chat_format.digest(chat_format.format_conversations(turns.limit(0))).collect() == []
