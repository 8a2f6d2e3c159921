"""Text and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of all files below ``path``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def split_lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of a text column, with the columns to ``keep``."""
    return df.select(*keep, F.explode(F.split(text, "\n")).alias("line"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, file_time, line) of all log files below ``path``."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_time"),
        F.col("value").alias("line"),
    )


def log_file_lines(df: DataFrame, file: str, file_time: str, body: str) -> DataFrame:
    """The same columns from a table that holds one log text per row."""
    return df.select(
        F.col(file).cast("string").alias("file"),
        F.col(file_time).cast("timestamp_ntz").alias("file_time"),
        F.explode(F.split(body, "\n")).alias("line"),
    )
