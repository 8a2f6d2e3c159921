from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from coursemart.functions import (
    collated,
    date_in_quarter,
    find_in_set_flag,
    is_one_of,
    join_names,
    none_of,
    parse_snapshot_name,
    qualified_db_name,
    qualified_table_name,
    quarter_lower_date,
    quarter_upper_date,
    register_sql_functions,
    same_text,
    sanitize_text,
    term_year,
    utc_to_local_text,
    wordcount,
)


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("day", "quarter", "year", "expected"),
    [
        ("2014-01-02", "winter", 2013, True),
        ("2013-12-02", "winter", 2013, True),
        ("2013-11-30", "fall", 2013, True),
        ("2014-03-30", "spring", "%", True),
        ("2020-03-30", "spring", "%", True),
        ("2013-11-30", "Fall", "2013", True),
        ("2013-09-01", "fall", 2012, False),
        ("2014-08-31", "summer", 2013, True),
        ("2014-08-31", "summer", 2014, False),
        ("2016-02-29", "winter", 2015, True),
        ("2016-01-31", "winter", "%", True),
        # The winter branch does not look at the quarter name once the year is concrete.
        ("2014-01-02", "fall", 2013, True),
        ("2014-01-02", "fall", "%", False),
    ],
)
def test_date_in_quarter(spark, day, quarter, year, expected):
    assert value(spark, date_in_quarter(F.lit(day), quarter, year)) is expected


def test_date_in_quarter_strict_and_null(spark):
    assert value(spark, date_in_quarter(F.lit("2014-01-02"), "fall", 2013, strict=True)) is False
    nothing = F.lit(None).cast("date")
    assert value(spark, date_in_quarter(nothing, "winter", "%")) is True
    assert value(spark, date_in_quarter(nothing, "winter", 2013)) is None


def test_quarter_bounds(spark):
    assert value(spark, quarter_lower_date("fall", 2013)) == date(2013, 9, 1)
    assert value(spark, quarter_lower_date("Winter", 2013)) == date(2013, 12, 1)
    assert value(spark, quarter_lower_date("spring", 2013)) == date(2014, 3, 1)
    assert value(spark, quarter_lower_date("summer", 2013)) == date(2014, 6, 1)
    assert value(spark, quarter_upper_date("winter", 2015)) == date(2016, 2, 28)
    assert value(spark, quarter_upper_date("fall", 2015)) == date(2015, 11, 30)
    assert value(spark, quarter_upper_date("autumn", 2015)) is None


@pytest.mark.parametrize(
    ("text", "seen", "exact"),
    [("one two three", 3, 3), ("one a", 1, 2), ("a", 0, 1), ("", 0, 0), (None, 0, 0), ("ünï çödé 42!", 3, 3), (" x y ", 2, 2)],
)
def test_wordcount_misses_a_final_letter(spark, text, seen, exact):
    c = F.lit(text).cast("string")
    assert (value(spark, wordcount(c)), value(spark, wordcount(c, exact=True))) == (seen, exact)


@pytest.mark.parametrize(
    ("tag", "listed", "expected"),
    [
        ("WAY-ER", "THINK, WAY-ER,Writing 1", 1),
        ("THINK", "THINK, WAY-ER,Writing 1", 1),
        ("Writing 1", "THINK, WAY-ER,Writing 1", 0),
        ("GER:DB-NatSci", "GER: DB-NatSci, WAY-SMA", 1),
        ("WAY-E", "WAY-ER", 0),
        ("WAY-ER", None, 0),
        ("WAY-ER", "", 0),
        ("WAY-ER", "way-er", 1),
    ],
)
def test_find_in_set_flag(spark, tag, listed, expected):
    assert value(spark, find_in_set_flag(tag, F.lit(listed).cast("string"))) == expected


def test_text_comparison_ignores_case_and_trailing_spaces(spark):
    assert value(spark, same_text(F.lit("TaEnrollment "), "TAEnrollment")) is True
    assert value(spark, is_one_of(F.lit("Claimed"), ["claimed", "available"])) is True
    assert value(spark, none_of(F.lit("x"), ["y"])) is True
    assert value(spark, none_of(F.lit(None).cast("string"), ["y"])) is None
    assert value(spark, collated(F.lit("é ")) == collated(F.lit("E"))) is True


def test_names(spark):
    assert value(spark, qualified_db_name(F.lit("db.tbl.x"), "here")) == "db"
    assert value(spark, qualified_db_name(F.lit("tbl"), "here")) == "here"
    assert value(spark, qualified_table_name(F.lit("db.tbl.x"))) == "tbl.x"
    assert value(spark, qualified_table_name(F.lit("tbl"))) == "tbl"
    assert value(spark, term_year(F.lit("Winter 2016"))) == 2016
    assert value(spark, term_year(F.lit("Default Term"))) == 0


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("Terms_2019_05_09_11_51_03", ("Terms", "2019_05_09_11_51_03", datetime(2019, 5, 9, 11, 51, 3))),
        (
            "Terms_2019_01_10_14_14_40_123456",
            ("Terms", "2019_01_10_14_14_40_123456", datetime(2019, 1, 10, 14, 14, 40, 123456)),
        ),
        (
            "ExploreCourses_2019_01_10_14_14_40_1234",
            ("ExploreCourses", "2019_01_10_14_14_40_1234", datetime(2019, 1, 10, 14, 14, 40, 123400)),
        ),
        ("xTerms_2019_05_09_11_51_03", ("Terms", "2019_05_09_11_51_03", datetime(2019, 5, 9, 11, 51, 3))),
        ("foo_2019_05_09_11_51_03", (None, None, None)),
        ("2019_05_09_11_51_03", (None, None, None)),
        ("Terms_2019_02_30_11_51_03", (None, None, None)),
        ("Terms_2019_05_09_11_51_03_", (None, None, None)),
        ("Terms_2019_05_09_11_51_031", (None, None, None)),
        ("Terms_2019_05_09_11_51_03_1234567", (None, None, None)),
        ("Terms", (None, None, None)),
    ],
)
def test_parse_snapshot_name(spark, name, expected):
    roots = ["Terms", "Courses", "ExploreCourses"]
    assert tuple(value(spark, parse_snapshot_name(F.lit(name), roots))) == expected


def test_utc_to_local_text(spark):
    instant = F.lit(datetime(2011, 9, 30, 20, 10, 4)).cast("timestamp_ntz")
    assert value(spark, utc_to_local_text(instant, "America/Los_Angeles")) == "2011-09-30 13:10:04 PDT"
    winter = F.lit(datetime(2011, 1, 30, 20, 10, 4)).cast("timestamp_ntz")
    assert value(spark, utc_to_local_text(winter, "America/Los_Angeles")) == "2011-01-30 12:10:04 PST"
    assert value(spark, utc_to_local_text(winter, "UTC")) == "2011-01-30 20:10:04 UTC"


def test_join_names_skips_nulls_and_copies(spark):
    names = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, name string")
    result = {r["k"]: r["names"] for r in names.groupBy("k").agg(join_names("name").alias("names")).collect()}
    assert result == {1: "a, b", 2: None}


def test_sanitize_text(spark):
    assert value(spark, sanitize_text(F.lit("a\tb\nc"))) == "a        b c"


def test_sql_functions_agree_with_the_column_functions(spark):
    register_sql_functions(spark)
    days = spark.sql(
        """SELECT CAST(timestampadd(DAY, id, TIMESTAMP '2013-01-01') AS TIMESTAMP_NTZ) AS day,
                  element_at(array('fall', 'Winter', 'spring', 'SUMMER', 'x'), CAST(id % 5 + 1 AS INT)) AS quarter,
                  element_at(array('2012', '2013', '%', '2014', 'y'), CAST(id % 7 % 5 + 1 AS INT)) AS year
             FROM range(1200)
           UNION ALL SELECT NULL, 'winter', '%' UNION ALL SELECT NULL, 'winter', '2013'"""
    )
    pairs = days.select(
        F.expr("dateInQuarter(day, quarter, year)").alias("a"),
        date_in_quarter("day", F.col("quarter"), F.col("year")).alias("b"),
        F.expr("makeUpperQuarterDate(quarter, TRY_CAST(year AS INT))").alias("c"),
        quarter_upper_date(F.col("quarter"), F.col("year")).alias("d"),
        F.expr("makeLowQuarterDate(quarter, TRY_CAST(year AS INT))").alias("e"),
        quarter_lower_date(F.col("quarter"), F.col("year")).alias("f"),
    )
    assert pairs.where("NOT (a <=> b AND c <=> d AND e <=> f)").count() == 0
    assert pairs.where("a").count() > 50
    row = spark.sql(
        "SELECT wordcount('one two a') w, DATABASE_NAME('x.y.z') d, DATABASE_NAME('y') c, TABLE_BASENAME('x.y.z') t, TABLE_BASENAME('y') b"
    ).first()
    assert tuple(row) == (2, "x", "default", "y.z", "y")
    assert spark.sql("SELECT sum(wordcount(s)) FROM VALUES ('a b c'), ('one two'), (NULL) AS t(s)").first()[0] == 4
