from coursemart.plans.registry import TABLES, Mart, Settings, auxiliary_table, sql_table

# Importing the builder modules registers their tables, each after the tables it reads.
from coursemart.plans import people, courses, assignments, discussions, modules, requirements  # noqa: E402,F401,I001
from coursemart.plans.build_job import BuildError, BuildReport, build, refresh

__all__ = ["TABLES", "BuildError", "BuildReport", "Mart", "Settings", "auxiliary_table", "build", "refresh", "sql_table"]
