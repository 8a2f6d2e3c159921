"""Dated copies of tables, kept as partitions of one dataset per table.

Layout: ``<base>/<root>/snapshot_ts=t<yyyymmdd>T<hhmmssffffff>/part-*``, in UTC whatever the session's zone. The current table stays where it is when a snapshot is taken.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemart.functions.calendar import plain_utc, utc_literal
from coursemart.operators.keys import newest_n

SNAPSHOT_TS = "snapshot_ts"
PREFIX = "t"


class SnapshotError(ValueError):
    """A snapshot that was asked for by its time does not exist."""


def _name(at: datetime) -> str:
    """A snapshot's folder value. The letter in front keeps readers from taking it for a time in the session's zone."""
    return f"{PREFIX}{at:%Y%m%dT%H%M%S%f}"


def snapshot(df: DataFrame, base: str, root: str, at: datetime) -> None:
    """Copy the rows of ``df`` into the snapshot of that time."""
    (
        df.withColumn(SNAPSHOT_TS, F.lit(_name(plain_utc(at))))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT_TS)
        .parquet(f"{base}/{root}")
    )


def _with_time(found: DataFrame) -> DataFrame:
    text = F.regexp_replace(SNAPSHOT_TS, rf"^{PREFIX}(.{{4}})(.{{2}})(.{{2}})T(.{{2}})(.{{2}})(.{{2}})(.{{6}})$", "$1-$2-$3 $4:$5:$6.$7")
    return found.withColumn(SNAPSHOT_TS, text.cast("timestamp_ntz"))


def read_snapshots(spark: SparkSession, base: str, root: str) -> DataFrame:
    """All snapshots of one table, with ``snapshot_ts``."""
    return _with_time(spark.read.parquet(f"{base}/{root}"))


def _folders(spark: SparkSession, base: str, root: str) -> list[tuple[datetime, object, object]]:
    """(time, file system, path) of each snapshot, newest first, from the folder listing alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{root}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.listStatus(folder) if files.exists(folder) else ():
        name = status.getPath().getName()
        if name.startswith(f"{SNAPSHOT_TS}={PREFIX}"):
            at = datetime.strptime(name.split("=", 1)[1], f"{PREFIX}%Y%m%dT%H%M%S%f")
            found.append((at, files, status.getPath()))
    return sorted(found, key=lambda x: x[0], reverse=True)


def snapshot_times(spark: SparkSession, base: str, root: str) -> list[datetime]:
    """The times of a table's snapshots, newest first; no data file is opened."""
    return [at for at, _, _ in _folders(spark, base, root)]


def read_latest(spark: SparkSession, base: str, root: str) -> DataFrame:
    """The rows of the newest snapshot, the only one whose files are opened."""
    times = snapshot_times(spark, base, root)
    if not times:
        raise SnapshotError(f"no snapshot of {root}")
    return spark.read.parquet(f"{base}/{root}/{SNAPSHOT_TS}={_name(times[0])}")


def latest(snapshots: DataFrame) -> DataFrame:
    """The rows of the newest snapshot."""
    newest = snapshots.agg(F.max(SNAPSHOT_TS))
    return snapshots.where(F.col(SNAPSHOT_TS) == newest.scalar()).drop(SNAPSHOT_TS)


def asof(snapshots: DataFrame, at: datetime) -> DataFrame:
    """The rows of the snapshot taken exactly ``at``; an error when there is none."""
    rows = snapshots.where(F.col(SNAPSHOT_TS) == utc_literal(at)).drop(SNAPSHOT_TS)
    if rows.isEmpty():
        raise SnapshotError(f"no snapshot of {at}")
    return rows


def restore(snapshots: DataFrame, target: str, at: datetime | None = None) -> bool:
    """Make the newest snapshot (or that of ``at``) the table at ``target``. False, and nothing done, without any."""
    if at is None and snapshots.isEmpty():
        return False
    (latest(snapshots) if at is None else asof(snapshots, at)).write.mode("overwrite").parquet(target)
    return True


def retain(snapshots: DataFrame, n: int = 2, root: str | None = None) -> DataFrame:
    """The rows of the ``n`` newest snapshots (of each root). Rows are matched to the few kept times by a join."""
    name = root or "_root"
    rows = snapshots if root else snapshots.withColumn("_root", F.lit(""))
    kept = newest_n(rows, name, SNAPSHOT_TS, n).drop("rank")
    joined = rows.join(kept, [name, SNAPSHOT_TS], "left_semi")
    return joined.select(*snapshots.columns)


def prune(spark: SparkSession, base: str, root: str, n: int = 2) -> list[datetime]:
    """Delete the folders of all but the ``n`` newest snapshots and return their times, newest first."""
    doomed = _folders(spark, base, root)[n:]
    for _, files, path in doomed:
        files.delete(path, True)
    return [at for at, _, _ in doomed]
