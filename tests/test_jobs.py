from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from lms import source

from coursemart.jobs import (
    asof,
    latest,
    load_log_history,
    load_log_latest,
    log_errors,
    health_findings,
    load_log_entry,
    prune,
    read_latest,
    read_snapshots,
    restore,
    retain,
    shrunken,
    snapshot,
    snapshot_times,
    split_attribute_prefix,
    stale,
    word_frequency,
)
from coursemart.functions.calendar import utc_to_local_text
from coursemart.jobs.snapshots import SnapshotError
from coursemart.plans import TABLES, build
from coursemart.sources import read_log_lines

EARLY, LATE, LAST = datetime(2019, 1, 1, 11, 0, 10), datetime(2019, 11, 1, 11, 0, 10), datetime(2019, 12, 1, 1, 1, 1, 5)


# --- words -------------------------------------------------------------------------------------------------------------


def frequencies(spark, *texts, **options):
    df = word_frequency(spark.createDataFrame([(t,) for t in texts], "line string"), "line", **options)
    return {(r["attribute"], r["word"]): r["frequency"] for r in df.collect()}


def test_words_are_filtered_before_they_are_lowered(spark):
    # Only the last full stop of a line is split off.
    found = frequencies(spark, "The cat sat on the mat. The 42 cats: a 3.5 I x.", "Monday monday Cat")
    assert found == {
        ("all", "the"): 2, ("all", "cat"): 2, ("all", "sat"): 1, ("all", "mat."): 1, ("all", "cats"): 1,
        ("all", "3.5"): 1, ("all", "monday"): 1,
    }


@pytest.mark.parametrize(
    ("line", "tokens"),
    [
        ("They'll save and invest more.", ["They", "'ll", "save", "and", "invest", "more", "."]),
        ("hi, my name can't hello,", ["hi", ",", "my", "name", "ca", "n't", "hello", ","]),
        ('Good muffins cost $3.88 "in" (York).', ["Good", "muffins", "cost", "$", "3.88", "``", "in", "''", "(", "York", ")", "."]),
        ("He cannot, gonna go -- now...", ["He", "can", "not", ",", "gon", "na", "go", "--", "now", "..."]),
        ("Jane's cat; 10:30 ok?", ["Jane", "'s", "cat", ";", "10:30", "ok", "?"]),
    ],
)
def test_treebank_tokens(spark, line, tokens):
    from coursemart.jobs import treebank_tokens

    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(treebank_tokens("line").alias("t")).first()["t"] == tokens


def test_counting_pieces_first_changes_no_token(spark):
    import random

    from pyspark.sql import functions as F

    from coursemart.jobs import treebank_tokens
    from coursemart.jobs.text import treebank_counts

    rng = random.Random(5)
    parts = ["the", "can't", "cannot", "'tis", "x", "3,5", "a,b", "$", "\"", "''", "'", ".", "...", "--", ":", "?", "(", ")", "<",
             "gonna", "wanna", "s'", "'s", "I'll", "end.", ".)", ",,", " ", "  ", "\t", "d'ye", "é", "`", "``", "Gonna", "lemme", "7"]
    lines = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\t"]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    df = spark.createDataFrame([("a", line) for line in lines], "attribute string, line string")
    whole = df.select(F.explode(treebank_tokens("line")).alias("token")).groupBy("token").count()
    pieces = treebank_counts(df).groupBy("token").agg(F.sum("n"))
    assert rows(pieces) == rows(whole)


def test_attributes(spark):
    lines = spark.createDataFrame([("cs1,good, clear course",), ("no attribute",), (",bare",), ("cs1,good",)], "line string")
    parts = split_attribute_prefix(lines)
    assert rows(parts) == [("", "bare"), ("cs1", "good"), ("cs1", "good, clear course")]
    found = rows(word_frequency(parts, "text", "attribute", tokenizer="words"))
    assert found == [("", "bare", 1), ("cs1", "clear", 1), ("cs1", "course", 1), ("cs1", "good", 2)]


def test_word_counts_against_plain_python(spark):
    texts = [f"alpha beta{i % 3} alpha Gamma" for i in range(50)]
    expected = Counter(("all", w.lower()) for t in texts for w in t.split())
    assert frequencies(spark, *texts, tokenizer="words") == expected


# --- load log ----------------------------------------------------------------------------------------------------------


def test_load_log(spark):
    log = spark.createDataFrame(
        [
            ("Rooms", datetime(2021, 3, 14, 9, 59, 59), 7),
            ("Bells", datetime(2021, 11, 7, 9, 0), 3),
            ("Rooms", datetime(2021, 3, 14, 10, 0), 8),
        ],
        "tbl_name string, time_refreshed timestamp_ntz, num_rows bigint",
    )
    # The clock goes forward between the two loads of Rooms, and back in the hour of Bells.
    assert [tuple(r) for r in load_log_history(log, "America/Los_Angeles").collect()] == [
        ("Bells", "2021-11-07 01:00:00 PST", 3), ("Rooms", "2021-03-14 01:59:59 PST", 7),
        ("Rooms", "2021-03-14 03:00:00 PDT", 8),
    ]
    assert [r["num_rows"] for r in load_log_latest(log, "America/Los_Angeles").collect()] == [3, 8]


def test_zone_names_follow_the_moment(spark):
    # Four hours ahead of UTC was summer time in one year and standard time in another.
    times = spark.createDataFrame([(datetime(2005, 7, 1),), (datetime(2013, 7, 1),), (None,)], "t timestamp_ntz")
    found = [r[0] for r in times.select(utc_to_local_text("t", "Europe/Moscow")).collect()]
    assert found[:2] == ["2005-07-01 04:00:00 MSD", "2013-07-01 04:00:00 MSK"]


@pytest.fixture(params=["UTC", "America/Los_Angeles"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: A time that Los Angeles' clocks skip.
GAP = datetime(2021, 3, 14, 2, 30, 0, 5)


def test_times_do_not_depend_on_the_session(spark, tmp_path, zone):
    logged = load_log_entry(spark.range(3), "Rooms", GAP).selectExpr("cast(time_refreshed AS string)", "num_rows").first()
    assert tuple(logged) == ("2021-03-14 02:30:00.000005", 3)
    aware = datetime(2021, 3, 14, 4, 30, tzinfo=timezone(timedelta(hours=2)))
    assert load_log_entry(spark.range(1), "x", aware).selectExpr("cast(time_refreshed AS string)").first()[0].endswith("02:30:00")
    base = str(tmp_path / "snaps")
    snapshot(one(spark, 1), base, "Rooms", GAP)
    for session in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", session)
        assert snapshot_times(spark, base, "Rooms") == [GAP]
        found = read_snapshots(spark, base, "Rooms")
        assert rows(asof(found, GAP)) == [(1,)]
        assert found.selectExpr("cast(snapshot_ts AS string)").first()[0] == "2021-03-14 02:30:00.000005"
        assert rows(read_latest(spark, base, "Rooms")) == [(1,)]


# --- snapshots ---------------------------------------------------------------------------------------------------------


def one(spark, foo):
    return spark.createDataFrame([(foo,)], "foo int")


def test_snapshots_restore(spark, tmp_path):
    base, current = str(tmp_path / "snaps"), str(tmp_path / "Terms")
    snapshot(one(spark, 20), base, "Terms", EARLY)
    assert restore(read_snapshots(spark, base, "Terms"), current)
    assert rows(spark.read.parquet(current)) == [(20,)]
    snapshot(one(spark, 30), base, "Terms", LATE)
    found = read_snapshots(spark, base, "Terms")
    assert rows(latest(found)) == [(30,)]
    assert rows(asof(found, EARLY)) == [(20,)]
    assert restore(found, current, EARLY)
    assert rows(spark.read.parquet(current)) == [(20,)]
    with pytest.raises(SnapshotError):
        asof(found, LAST)
    assert restore(found.where("foo < 0"), current) is False


def test_snapshot_retention(spark, tmp_path):
    base = str(tmp_path / "snaps")
    for foo, at in ((1, EARLY), (2, LATE), (3, LAST)):
        snapshot(one(spark, foo), base, "Terms", at)
    found = read_snapshots(spark, base, "Terms")
    assert rows(retain(found, 2).select("foo")) == [(2,), (3,)]
    assert rows(retain(found, 3).select("foo")) == [(1,), (2,), (3,)]
    assert rows(retain(found, 0)) == []
    assert prune(spark, base, "Terms", 2) == [EARLY]
    assert rows(read_snapshots(spark, base, "Terms").select("foo")) == [(2,), (3,)]
    assert prune(spark, base, "Terms", 5) == []
    assert snapshot_times(spark, base, "Terms") == [LAST, LATE]
    assert snapshot_times(spark, base, "Nothing") == []
    with pytest.raises(SnapshotError):
        read_latest(spark, base, "Nothing")


# --- quality -----------------------------------------------------------------------------------------------------------


def test_shrunken(spark):
    sizes = spark.createDataFrame(
        [("oak", 40), ("elm", 39), ("fir", 0), ("ash", 70), ("new", 5), ("bare", 0), (None, 5)], "tbl_name string, size long"
    )
    marks = spark.createDataFrame(
        [("oak", 40), ("elm", 41), ("fir", 0), ("ash", 60), ("gone", 7), (None, 6)], "tbl_name string, expected long"
    )
    findings, baseline = shrunken(sizes, marks)
    assert rows(findings) == [("bare", 0, 0), ("elm", 39, 41), ("fir", 0, 0), (None, 5, 6)]
    for _ in range(2):
        # Marks do not multiply, however often they are renewed.
        found = rows(baseline)
        assert found == [("ash", 70), ("bare", 0), ("elm", 41), ("fir", 0), ("gone", 7), ("new", 5), ("oak", 40), (None, 6)]
        baseline = shrunken(sizes, baseline)[1]


def test_health(spark):
    present = spark.createDataFrame([("oak",), ("elm",)], "tbl_name string")
    sizes = spark.createDataFrame([("oak", 4)], "tbl_name string, size long")
    marks = spark.createDataFrame([("oak", 5)], "tbl_name string, expected long")
    lines = spark.createDataFrame(
        [("b.log", datetime(2021, 1, 2), "an ERROR here"), ("a.log", datetime(2021, 1, 1), "ERROR before")],
        "file string, file_time timestamp_ntz, line string",
    )
    assert rows(health_findings(present, ["oak", "yew"], sizes, marks, lines)) == [
        ("log", "b.log", "an ERROR here"), ("missing", "yew", ""), ("shrunken", "oak", "4 of 5"),
    ]
    assert health_findings(present, ["oak"], sizes, sizes.toDF("tbl_name", "expected"), lines.limit(0)).isEmpty()


def test_stale_is_strict(spark):
    times = spark.createDataFrame(
        [("a", datetime(2020, 1, 2)), ("b", datetime(2020, 1, 1)), ("c", datetime(2019, 12, 31, 23, 59, 59)),
         ("c", datetime(2019, 1, 1))],
        "tbl_name string, ts timestamp_ntz",
    )
    assert rows(stale(times)) == [("c", datetime(2019, 12, 31, 23, 59, 59))]
    assert rows(stale(times, hours=25)) == []


def test_log_errors(spark, tmp_path):
    import os

    (tmp_path / "old.log").write_text("ERROR of old\n")
    os.utime(tmp_path / "old.log", (1_000_000, 1_000_000))
    (tmp_path / "new.log").write_text("no error so far\nhere an ERROR shows\nall is well\nERROR at the end\n")
    found = log_errors(read_log_lines(spark, str(tmp_path)))
    assert rows(found) == [("new.log", "ERROR at the end"), ("new.log", "here an ERROR shows")]
    (tmp_path / "newer.log").write_text("fine\n")
    os.utime(tmp_path / "newer.log", (4_000_000_000, 4_000_000_000))
    assert rows(log_errors(read_log_lines(spark, str(tmp_path)))) == []


# --- build -------------------------------------------------------------------------------------------------------------


def test_build(spark, tmp_path):
    lms = source(spark, enrollment_term_dim=[{"id": 1, "name": "Fall 2015"}], account_dim=[{"id": 1, "name": "A"}])
    target, log = str(tmp_path / "aux"), str(tmp_path / "log")
    report = build(spark, lms, target, tables=["Terms", "Accounts", "StudentUnits"], load_log=log)
    assert report.built == ["Accounts", "Terms", "StudentUnits"]
    assert rows(spark.read.parquet(f"{target}/StudentUnits").select("account_name", "course_id")) == [("A", None)]
    assert rows(spark.read.parquet(log).select("tbl_name", "num_rows")) == [("Accounts", 1), ("StudentUnits", 1), ("Terms", 1)]
    again = build(spark, lms, target, tables=["Terms", "Students"], new_only=True)
    assert again.built == ["Students"] and "Terms" in again.skipped
    with pytest.raises(ValueError):
        build(spark, lms, target, tables=["Nothing"])


def test_full_build_reads_what_it_wrote(spark, tmp_path):
    lms = source(spark, enrollment_term_dim=[{"id": 1, "name": "Fall 2015"}])
    report = build(spark, lms, str(tmp_path / "aux"), exclude=["Graders"])
    # All tables of a full build but the catalog (no source) and the one left out.
    assert report.built == [n for n, s in TABLES.items() if s.in_build and n not in ("Graders", "ExploreCourses")]
    assert all("/CourseInstructorTeams/" in f for f in report.tables["CourseInstructorTeams"].inputFiles())
