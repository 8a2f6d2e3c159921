"""Data-quality checks. Each returns its findings as a DataFrame; an empty one means healthy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def volumes(df: DataFrame, key: str) -> DataFrame:
    """(key, size): rows per key, in the form ``shrunken`` compares."""
    return df.groupBy(F.col(key).cast("string").alias("tbl_name")).agg(F.count("*").alias("size"))


def shrunken(sizes: DataFrame, baseline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Compare (tbl_name, size) with the high-water marks (tbl_name, expected).

    Returns the tables that are empty or smaller than their mark, and the new marks: an unknown table sets its own, a
    larger one raises it, one not measured keeps it. A table without a name is a table like any other. Of several marks the
    highest counts, of several sizes their sum.
    """
    # One row per name on either side and in the result; a grouping matches NULL with NULL, which a join does not.
    both = sizes.select("tbl_name", F.col("size").cast("long").alias("size"), F.lit(None).cast("long").alias("expected")).union(
        baseline.select("tbl_name", F.lit(None).cast("long"), F.col("expected").cast("long"))
    )
    measured = both.groupBy("tbl_name").agg(F.sum("size").alias("size"), F.max("expected").alias("expected"))
    mark = F.coalesce("expected", "size")
    findings = measured.where(F.col("size").isNotNull() & ((F.col("size") < mark) | (F.col("size") == 0)))
    return (
        findings.select("tbl_name", "size", mark.alias("expected")),
        measured.select("tbl_name", F.greatest("size", "expected").alias("expected")),
    )


def stale(times: DataFrame, hours: float = 24) -> DataFrame:
    """Of (tbl_name, ts): the tables more than ``hours`` older than the newest, with their last time."""
    last = times.groupBy("tbl_name").agg(F.max("ts").alias("ts"))
    newest = last.agg(F.max("ts"))
    age = F.timestamp_diff("MICROSECOND", F.col("ts"), newest.scalar())
    return last.where(age > int(hours * 3_600_000_000))


def log_errors(lines: DataFrame, marker: str = "ERROR") -> DataFrame:
    """Of (file, file_time, line): the lines of the newest file that contain ``marker``, in exactly that spelling."""
    newest = lines.agg(F.max(F.struct("file_time", "file")).alias("_f")).select("_f.file")
    return lines.where((F.col("file") == newest.scalar()) & F.contains("line", F.lit(marker))).select("file", "line")


def health_findings(
    present: DataFrame, required: list[str], sizes: DataFrame, baseline: DataFrame, lines: DataFrame
) -> DataFrame:
    """(kind, subject, detail) of everything that is wrong, empty when all is well.

    ``missing``: a required table that ``present`` (tbl_name) does not name. ``shrunken``: a table below its mark, see
    ``shrunken``. ``log``: an error line in the newest log, see ``log_errors``.
    """
    names = F.array(*(F.lit(name) for name in required)) if required else F.expr("cast(array() AS array<string>)")
    wanted = present.sparkSession.range(1).select(F.explode(names).alias("subject"))
    missing = wanted.join(present.select(F.col("tbl_name").alias("subject")), "subject", "left_anti")
    smaller = shrunken(sizes, baseline)[0]
    size_text = F.concat_ws(" of ", F.col("size").cast("string"), F.col("expected").cast("string"))
    return (
        missing.select(F.lit("missing").alias("kind"), "subject", F.lit("").alias("detail"))
        .union(smaller.select(F.lit("shrunken"), "tbl_name", size_text))
        .union(log_errors(lines).select(F.lit("log"), F.col("file").cast("string"), "line"))
    )
