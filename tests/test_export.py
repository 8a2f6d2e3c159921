from datetime import datetime

import pytest
from conftest import rows

from coursemart.sinks import (
    export,
    export_all,
    export_by_account_batches,
    export_by_seq_batches,
    rows_since_term_year,
    sanitize_strings,
    with_seq_batch,
    write_table,
)
from coursemart.sources import read_excerpt


def lines(folder):
    return [line for part in sorted(folder.rglob("part-*.csv")) for line in part.read_text().splitlines()]


ROUGH = ["a\rb", "a\r\nb", "a\nb", "a\tb", "a\0b", "a\\b", 'say "b"', "'", ",", "", " ", None, "\\N?"]


def test_quoted_export(spark, tmp_path):
    data = [(i, t, i / 4) for i, t in enumerate(ROUGH)]
    df = spark.createDataFrame(data, "id int, remark string, share double")
    export(df.coalesce(1), str(tmp_path / "a"), "csv_quoted")
    (part,) = (tmp_path / "a").glob("part-*.csv")
    text = part.read_bytes().decode()
    assert text.startswith('"id","remark","share"\n"0","a\rb","0.0"\n"1","a\r\nb","0.25"\n')
    options = {"header": True, "escape": '"', "multiLine": True, "lineSep": "\n", "nullValue": "\1"}
    back = spark.read.schema(df.schema).options(**options).csv(str(tmp_path / "a"))
    shown = {i: "NULL" if t is None else t for i, t, _ in data}
    assert {r[0]: r[1] or "" for r in back.collect()} == shown


def test_every_dialect_keeps_rough_text(spark, tmp_path):
    at = datetime(2021, 3, 4, 5, 6, 7, 89)
    data = [(i, t, at if i % 2 else datetime(2021, 3, 4)) for i, t in enumerate(ROUGH)]
    df = spark.createDataFrame(data, "id int, t string, at timestamp_ntz").repartition(3)
    export(df, str(tmp_path / "t"))
    raw = b"".join(p.read_bytes() for p in (tmp_path / "t").rglob("part-*.csv"))
    assert b"\0" not in raw and b"\r" not in raw
    body = [x for x in raw.decode().split("\n")[:-1] if not x.startswith("id\t")]
    escaped = {i: "NULL" if t is None else t.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n").replace("\r", "\\r").replace("\0", "\\0") for i, t, _ in data}
    times = {i: "2021-03-04 05:06:07.000089" if i % 2 else "2021-03-04 00:00:00" for i, _, _ in data}
    assert sorted(body) == sorted(f"{i}\t{escaped[i]}\t{times[i]}" for i, _, _ in data)
    export(df, str(tmp_path / "e"), "excerpt")
    assert rows(read_excerpt(spark, str(tmp_path / "e"), df.schema)) == sorted(data, key=repr)


def test_broken_dumps_are_errors(spark, tmp_path):
    (tmp_path / "short.csv").write_text("1,2021-01-01 00:00:00\n2\n")
    (tmp_path / "word.csv").write_text("1,soon\n")
    (tmp_path / "zero.csv").write_text("1,0000-00-00 00:00:00\n2,2021-01-01 00:00:00.5\n")
    for name in ("short", "word"):
        with pytest.raises(Exception, match="(?i)malformed|soon"):
            read_excerpt(spark, str(tmp_path / f"{name}.csv"), "id bigint, at timestamp_ntz").collect()
    found = read_excerpt(spark, str(tmp_path / "zero.csv"), "id bigint, at timestamp_ntz")
    assert rows(found) == [(1, None), (2, datetime(2021, 1, 1, 0, 0, 0, 500000))]


def test_export_all_goes_on_after_an_error(spark, tmp_path):
    def broken():
        raise OSError("no such table")

    dest = str(tmp_path / "all")
    tables = {"a": spark.range(2), "b": broken, "c": lambda: spark.range(3)}
    first = export_all(tables, dest)
    assert (first.done, first.skipped, first.errors) == (["a", "c"], [], {"b": "no such table"})
    second = export_all({"a": spark.range(9), "d": spark.range(1)}, dest)
    assert (second.done, second.skipped) == (["d"], ["a"])
    assert export_all({"a": spark.range(9)}, dest, overwrite=True).done == ["a"]
    assert len(lines(tmp_path / "all" / "a")) >= 10


def test_tsv_export(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'a "q"\tb\nc \\ d', None, datetime(2019, 1, 2, 3, 4, 5))], "id int, t string, n string, at timestamp_ntz"
    ).coalesce(1)
    export(df, str(tmp_path / "t"))
    text = "\n".join(lines(tmp_path / "t"))
    assert text == 'id\tt\tn\tat\n1\ta "q"\\tb\\nc \\\\ d\tNULL\t2019-01-02 03:04:05'
    export(df, str(tmp_path / "t"), sanitize=True)
    assert 'a "q"        b c' in "\n".join(lines(tmp_path / "t"))
    with pytest.raises(ValueError):
        export(df, str(tmp_path / "t"), "xlsx")


def test_excerpt_round_trip(spark, tmp_path):
    data = [(1, 'x,"y"\nz \\ w'), (2, None), (3, ""), (None, " lead ")]
    df = spark.createDataFrame(data, "id bigint, t string")
    export(df, str(tmp_path / "e"), "excerpt")
    assert rows(read_excerpt(spark, str(tmp_path / "e"), df.schema)) == sorted(data, key=repr)
    (tmp_path / "zero.csv").write_text('1,\\N\n2,"2019-01-02 03:04:05"\n')
    found = read_excerpt(spark, str(tmp_path / "zero.csv"), "id bigint, at timestamp_ntz")
    assert rows(found) == [(1, None), (2, datetime(2019, 1, 2, 3, 4, 5))]


def test_account_batches_keep_every_row(spark, tmp_path):
    data = [(1,)] * 1500 + [(2,)] * 999 + [(3,)] * 4 + [(None,)] * 7
    df = spark.createDataFrame(data, "account_id bigint").repartition(5)
    export_by_account_batches(df, str(tmp_path / "x"))
    found = spark.read.options(sep="\t", header=True).csv(str(tmp_path / "x")).groupBy("batch", "account_id").count()
    assert rows(found) == [("1", "1", 1500), ("shared", "2", 999), ("shared", "3", 4), ("shared", "NULL", 7)]


def test_sequence_batches_lose_no_last_row(spark, tmp_path):
    df = spark.range(1, 100_002).withColumnRenamed("id", "seq_num")
    assert rows(with_seq_batch(df).groupBy("batch").count()) == [(0, 50_000), (1, 50_000), (2, 1)]
    export_by_seq_batches(df, str(tmp_path / "s"))
    found = spark.read.options(sep="\t", header=True).schema("seq_num long, batch long").csv(str(tmp_path / "s"))
    assert rows(found.groupBy("batch").count()) == [(0, 50_000), (1, 50_000), (2, 1)]


def test_since_term_year(spark):
    terms = spark.createDataFrame(
        [(1, "Winter 2016"), (2, "Fall 2019"), (3, "Default Term"), (4, None), (2, "Fall 2019")], "term_id int, term_name string"
    )
    grades = spark.createDataFrame([(1, 0), (2, 1), (2, 2), (3, 3), (4, 4), (None, 5)], "enrollment_term_id int, i int")
    assert rows(rows_since_term_year(grades, terms, 2019)) == [(2, 1), (2, 2)]


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    assert write_table(spark.range(2), path).count() == 2


def test_sanitize_only_touches_text(spark):
    df = spark.createDataFrame([(1, "a\tb")], "n int, t string")
    assert tuple(sanitize_strings(df).first()) == (1, "a        b")
