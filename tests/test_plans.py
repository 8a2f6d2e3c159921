"""What the physical plans must and must not contain."""

from contextlib import contextmanager

import pytest
from conftest import rows
from lms import mart
from pyspark.sql import functions as F

from coursemart.jobs import latest, log_errors, stale, word_frequency
from coursemart.operators import enrich_left, keep_min_per_key, missing_keys
from coursemart.plans import TABLES


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in TABLES if n not in ("ExploreCourses", "AllUsers")])
def test_tables_need_no_cross_join_and_no_window(spark, name):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(mart(spark).aux(name))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text


def test_jobs_compare_with_scalars_without_a_cross_join(spark):
    times = spark.createDataFrame([], "tbl_name string, ts timestamp_ntz")
    lines = spark.createDataFrame([], "file string, file_time timestamp_ntz, line string")
    snaps = spark.createDataFrame([], "foo int, snapshot_ts timestamp_ntz")
    words = spark.createDataFrame([], "line string")
    for df in (stale(times), log_errors(lines), latest(snaps), word_frequency(words, "line")):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "EvalPython" not in text


SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def hot(spark, n=60_000):
    """A third of the rows share key 0, another tenth have none."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 16).select(key.alias("k"), F.col("id"), F.concat(F.lit("row"), "id").alias("text"))


def test_a_hot_key_is_split_in_enrichment(spark):
    with settings(spark, **SKEWED):
        lookup = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("name"), "id").alias("name"))
        df = enrich_left(hot(spark), lookup, {"k": "k"}, {"name": "name"}, spread_by=["id"])
        counted = rows(df.groupBy(F.col("name").isNull()).count())
        df.collect()
        text = plan(df)
    assert counted == rows(hot(spark).groupBy(F.col("k").isNull()).count())
    assert "SortMergeJoin(skew=true)" in text


def test_a_hot_key_is_split_in_key_comparisons(spark):
    with settings(spark, **SKEWED):
        from coursemart.operators import restrict_to_keys

        df = restrict_to_keys(hot(spark), hot(spark).where("k < 10"), {"k": "k"})
        df.collect()
        text = plan(df)
    assert "SortMergeJoin(skew=true)" in text


def test_rows_without_a_key_do_not_meet_in_one_partition(spark):
    with settings(spark, **SKEWED):
        lookup = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
        nothing = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") < 0, 1).cast("long").alias("k"), "id")
        df = enrich_left(nothing, lookup, {"k": "k"}, {"v": "v"}, spread_by=["id"])
        sizes = rows(df.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("v").isNull())))
    assert len(sizes) == 8 and max(n for _, n in sizes) < 2 * 20_000 / 8


def test_a_hot_key_spreads_by_value_in_keep_min(spark):
    with settings(spark, **SKEWED):
        df = keep_min_per_key(hot(spark).select("k", "id"), ["k"], "id")
        joined = df._jdf.queryExecution().optimizedPlan().toString()
        physical = plan(df)
    assert "Window" not in physical
    assert "Join LeftOuter" in joined
    # The join partitions by value as well as by key.
    assert any("hashpartitioning(id" in line and "k" in line.split("hashpartitioning(id", 1)[1] for line in physical.split("\n"))


def test_present_keys_are_reduced_before_they_are_shuffled(spark):
    text = plan(missing_keys(hot(spark), hot(spark), ["k"]))
    assert "partial_min" in text or "partial" in text


def test_an_unused_lookup_is_pruned(spark):
    text = plan(mart(spark).aux("Modules").select("id"))
    # module_dim and module_fact only: every enrichment that feeds no output column is gone.
    assert text.count("Join") == 1


def test_a_hot_right_side_of_an_outer_join_is_split(spark):
    from coursemart.operators import left_join_large

    with settings(spark, **SKEWED):
        few = spark.range(-10, 100).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
        df = left_join_large(few, hot(spark).withColumnRenamed("id", "i"), ["k"])
        counted = df.groupBy(F.col("text").isNull()).count()
        expected = few.join(hot(spark), "k", "left").groupBy(F.col("text").isNull()).count()
        assert rows(counted) == rows(expected)
        df.collect()
        text = plan(df)
    assert "SortMergeJoin(skew=true)" in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    m = mart(spark)
    for name in ("submission_fact", "submission_dim"):
        m.raw(name).write.parquet(str(tmp_path / name))
        m.source._tables[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(m.aux("AssignmentSubmissions").select("submission_id"))
    assert "PushedFilters: [" in text and "In(enrollment_term_id" in text
    assert "ReadSchema: struct<id:bigint,assignment_id:bigint>" in text
