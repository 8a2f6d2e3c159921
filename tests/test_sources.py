from datetime import datetime

import pytest
from conftest import rows
from lms import BIG

from coursemart.sinks import write_table
from coursemart.sources import LmsSource, clean_zero_dates, read_raw, read_text_lines, split_lines, unreadable_values
from coursemart.sources.raw import raw_schema


def test_raw_tables_from_a_folder(spark, tmp_path):
    # Everything as text, as a dump delivers it: zero dates become NULL, large ids stay exact.
    schema = "id string, name string, date_start string, date_end string, extra string"
    terms = spark.createDataFrame(
        [(str(BIG + 3), "Fall 2015", "2015-09-01 00:00:00", "0000-00-00 00:00:00", "unused"), (None, None, None, None, "x")],
        schema,
    )
    terms.write.parquet(str(tmp_path / "enrollment_term_dim"))
    source = LmsSource.from_folder(spark, str(tmp_path))
    assert "enrollment_term_dim" in source
    assert rows(source["enrollment_term_dim"]) == [
        (BIG + 3, "Fall 2015", datetime(2015, 9, 1), None), (None, None, None, None),
    ]
    assert source["enrollment_term_dim"] is source["enrollment_term_dim"]
    with pytest.raises(KeyError):
        source["no_such_table"]


def test_text_of_another_type_is_an_error(spark):
    schema = "id string, name string, date_start string, date_end string"
    bad = spark.createDataFrame([("12x", "a", "2020-13-45", None), ("12x", "b", "2020-01-01", "0000-00-00")], schema)
    declared = raw_schema("enrollment_term_dim")
    with pytest.raises(Exception, match="12x|2020-13-45"):
        clean_zero_dates(bad, declared).collect()
    assert rows(unreadable_values(bad, declared)) == [("date_start", "2020-13-45", 1), ("id", "12x", 2)]
    assert unreadable_values(bad.where("false"), declared).isEmpty()


def test_raw_tables_from_csv_and_catalog(spark, tmp_path):
    (tmp_path / "user_dim.csv").write_text("id,name\n35910000000000001,Ann\n,Bob\n")
    found = read_raw(spark, "user_dim", str(tmp_path / "user_dim.csv"), "csv", header="true")
    assert rows(found) == [(35910000000000001, "Ann"), (None, "Bob")]
    spark.sql(f"CREATE DATABASE lms_raw LOCATION '{tmp_path}/db'")
    try:
        found.write.saveAsTable("lms_raw.user_dim")
        assert rows(LmsSource.from_catalog(spark, "lms_raw")["user_dim"]) == rows(found)
    finally:
        spark.sql("DROP DATABASE lms_raw CASCADE")


def test_bucketed_facts_join_without_an_exchange(spark, tmp_path):
    spark.sql(f"CREATE DATABASE lms_buckets LOCATION '{tmp_path}/db'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(1000).withColumnRenamed("id", "submission_id")
        left = write_table(keys, "lms_buckets.a", ["submission_id"], 4)
        right = write_table(keys, "lms_buckets.b", ["submission_id"], 4)
        joined = left.join(right, "submission_id")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE lms_buckets CASCADE")


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    assert rows(read_text_lines(spark, str(tmp_path))) == [("one",), ("two",)]
    texts = spark.createDataFrame([(1, "a\nb"), (2, "c"), (3, None)], "id int, text string")
    assert rows(split_lines(texts, "text", "id")) == [(1, "a"), (1, "b"), (2, "c")]
