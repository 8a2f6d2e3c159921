"""Session-level helpers: the shared folder and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir`` (or set on the context already).

    Only a local-mode session without that setting gets a folder of its own; a cluster without it is an error, because a
    machine-local folder would not survive (or even be visible to) the other executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="coursemart-")
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    Later stages neither recompute it nor depend on the executors that made it, and read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
