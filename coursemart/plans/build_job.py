"""The build job: write the auxiliary tables and log each one."""

from __future__ import annotations

import logging
from collections.abc import Collection
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from coursemart.jobs.history import append_load_log
from coursemart.jobs.snapshots import prune, snapshot
from coursemart.plans.registry import TABLES, Mart, Settings, conform
from coursemart.sinks.tables import write_table
from coursemart.sources.catalog import CatalogError
from coursemart.sources.raw import LmsSource

log = logging.getLogger(__name__)


@dataclass
class BuildReport:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    built: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    #: Table -> why it could not be built.
    errors: dict[str, str] = field(default_factory=dict)
    #: Tables that were still to be built when an error ended the build.
    todo: list[str] = field(default_factory=list)


class BuildError(RuntimeError):
    """A build that ended early; ``report`` has what was done and what is left."""

    def __init__(self, name: str, report: BuildReport):
        super().__init__(f"{name} was not built; still to do: {', '.join(report.todo)}")
        self.report = report


def _existing(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def build(
    spark: SparkSession,
    source: LmsSource,
    target: str,
    tables: Collection[str] | None = None,
    exclude: Collection[str] = (),
    new_only: bool = False,
    settings: Settings | None = None,
    load_log: str | None = None,
) -> BuildReport:
    """Write auxiliary tables below ``target``, one action each, in registry order.

    ``tables`` limits the build to those named, ``exclude`` leaves some out, ``new_only`` builds only what is not there
    yet. A table reads the tables already written before it; one it needs that was never written is composed into its
    plan. The catalog table is skipped when the source has no catalog. ``load_log`` is the folder of the load log.
    """
    unknown = set(tables or ()) - set(TABLES)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    report = BuildReport()
    mart = Mart(source, settings or Settings(), report.tables)
    names = [n for n, spec in TABLES.items() if (spec.in_build if tables is None else n in tables) and n not in exclude]
    if not ("catalog" in source or "catalog_xml" in source):
        names = [n for n in names if n != "ExploreCourses"]
    for name, spec in TABLES.items():
        path = f"{target.rstrip('/')}/{name}"
        there = _existing(spark, path)
        if name in names and not (new_only and there):
            try:
                rows = conform(spec.builder(mart), spec.columns, mart.settings.cut_text)
                report.tables[name] = write_table(rows, path)
            except CatalogError as error:
                # A response that is no catalog replaces nothing: the former table stays in use.
                report.errors[name] = str(error)
                log.error("%s: %s", name, error)
                if there:
                    report.tables[name] = spark.read.parquet(path)
                continue
            except Exception as error:
                report.errors[name] = str(error)
                report.todo = names[names.index(name) :]
                raise BuildError(name, report) from error
            report.built.append(name)
            if load_log is not None:
                append_load_log(report.tables[name], name, load_log)
            log.info("built %s", name)
        elif there:
            report.tables[name] = spark.read.parquet(path)
            report.skipped.append(name)
    return report


def refresh(
    spark: SparkSession,
    source: LmsSource,
    target: str,
    snapshots: str,
    keep: int = 2,
    at: datetime | None = None,
    **how,
) -> BuildReport:
    """Snapshot the tables that exist below ``target`` under one time, build, and keep the ``keep`` newest snapshots of each.

    Nothing is pruned when the build ends early, so what it replaced can be restored. ``how`` goes to ``build``.
    """
    moment = at or datetime.now(UTC)
    there = [name for name in TABLES if _existing(spark, f"{target.rstrip('/')}/{name}")]
    for name in there:
        snapshot(spark.read.parquet(f"{target.rstrip('/')}/{name}"), snapshots, name, moment)
    report = build(spark, source, target, **how)
    for name in there:
        prune(spark, snapshots, name, keep)
    return report
