"""Sources whose columns differ in order and number, read at once and as a stream."""

import pytest
from caremill.sources.readers import parse_dates, read_source
from caremill.streaming.arrivals import follow_source
from pyspark.errors import StreamingQueryException


@pytest.fixture
def root(tmp_path):
    for source, text in (("a", "patient_id,sex,race\nP1,M,White\n"), ("b", 'patient_id,race,sex,year_of_birth\nP1,Asian,F,1950\nP2,"",,\n'), ("c", "year_of_birth,patient_id\n1960,P3\n")):
        (tmp_path / source).mkdir()
        (tmp_path / source / "patient.csv").write_text(text)
    return f"file://{tmp_path}"


def test_read_source_goes_by_name(spark, root):
    got = read_source(spark, root, "patient")
    assert got.columns == ["patient_id", "sex", "race", "year_of_birth", "_source_id"]
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("P1", "F", "Asian", "1950", "b"), ("P1", "M", "White", "-", "a"), ("P2", "-", "", "-", "b"), ("P3", "-", "-", "1960", "c")]
    with pytest.raises(ValueError, match="no source"):
        read_source(spark, root, "encounter")


def _streamed(df, name):
    query = df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(tuple(r) for r in df.sparkSession.table(name).collect())


def test_stream_refuses_other_headers(spark, root):
    assert _streamed(follow_source(spark, root, "patient", ["patient_id", "sex", "race"], "a"), "one") == [("P1", "M", "White", "a")]
    with pytest.raises(StreamingQueryException):
        _streamed(follow_source(spark, root, "patient", ["patient_id", "sex", "race"]), "all_of_them")


def test_types_are_trimmed(spark):
    df = spark.createDataFrame([("20200102", "20200102")], "a string, b string")
    assert [str(x) for x in parse_dates(df, {"a": " Date ", "b": "VARCHAR"}).first()] == ["2020-01-02", "20200102"]
