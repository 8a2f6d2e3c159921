"""Assignment of keys to batches by volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARED = "shared"


def volume_batches(df: DataFrame, key: str, threshold: int = 1000) -> DataFrame:
    """(key, num_rows, batch): keys with at least ``threshold`` rows are a batch of their own, all others share one.

    One row per key, rather than one array of keys per batch, so no group has to fit into one task. Rows with a NULL key
    belong to the shared batch.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("num_rows"))
    own = (F.col("num_rows") >= threshold) & F.col(key).isNotNull()
    return counts.withColumn("batch", F.when(own, F.col(key).cast("string")).otherwise(SHARED))


def batch_sizes(assignment: DataFrame) -> DataFrame:
    """(batch, num_keys, num_rows), largest first."""
    return (
        assignment.groupBy("batch")
        .agg(F.count("*").alias("num_keys"), F.sum("num_rows").alias("num_rows"))
        .orderBy(F.desc("num_rows"), "batch")
    )
