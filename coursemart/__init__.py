"""Denormalised course-activity tables on Spark.

``operators``  DataFrame-to-DataFrame building blocks (lookup enrichment, per-key winners, batches)
``functions``  column functions (academic calendar, text, names, catalog fields)
``sources``    readers for raw tables, the course catalog, text and log lines
``sinks``      table writes and delimited exports
``plans``      the auxiliary tables, one builder each, and the build job
``jobs``       word frequencies, load log, snapshots, data-quality checks
"""
