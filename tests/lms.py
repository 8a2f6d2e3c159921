"""A tiny learning-management export for table tests: every raw table exists, empty unless rows are given."""

from coursemart.plans import Mart
from coursemart.plans.registry import Settings
from coursemart.sources.raw import RAW_COLUMNS, LmsSource, raw_schema

BIG = 35910000000000000


def source(spark, **tables):
    """``table=[{column: value}, ...]``; columns not given are NULL."""
    frames = {}
    for name in RAW_COLUMNS:
        schema = raw_schema(name)
        data = [tuple(row.get(f.name) for f in schema) for row in tables.get(name, [])]
        frames[name] = spark.createDataFrame(data, schema)
    return LmsSource(frames)


def mart(spark, key_fix=False, **tables):
    return Mart(source(spark, **tables), Settings(key_fix=key_fix))


def records(df, *columns):
    """The chosen columns as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
