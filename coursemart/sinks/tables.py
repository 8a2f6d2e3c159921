"""Full-refresh table writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, bucket_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Replace the table at ``path`` and return it as read back.

    With ``bucket_by``, ``path`` is a catalog table name and the rows are bucketed on those columns, so that later joins
    on them need no exchange.
    """
    spark = df.sparkSession
    if bucket_by:
        df.write.mode("overwrite").bucketBy(buckets, *bucket_by).saveAsTable(path)
        return spark.read.table(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
