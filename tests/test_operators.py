import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coursemart.operators import (
    anti_join_append,
    batch_sizes,
    common_keys,
    conditional_counts,
    count_matches_outer,
    count_pairs_by_key,
    dedupe_on_key,
    delete_matching,
    delete_where,
    dense_sequence,
    enrich_left,
    enrich_per_key,
    join_distinct,
    keep_min_per_key,
    latest_per_key,
    left_join_large,
    missing_keys,
    newest_n,
    restrict_to_keys,
    union_sources,
    volume_batches,
    winner_per_key,
)


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- enrichment --------------------------------------------------------------------------------------------------------


def test_enrich_keeps_every_row_and_takes_one_winner(spark):
    people = frame(spark, "id int, name string", (1, "x"), (2, "x"), (None, "x"), (1, "x"))
    lookup = frame(spark, "id int, name string", (1, "b"), (1, "a"), (1, None), (3, "c"), (None, "n"))
    assert rows(enrich_left(people, lookup, {"id": "id"}, {"name": "name"})) == [
        (1, "a"), (1, "a"), (2, None), (None, None),
    ]


def test_enrich_order_beats_value_and_nulls_come_last(spark):
    people = frame(spark, "id int", (1,), (2,))
    lookup = frame(spark, "k int, rank int, v string", (1, 2, "a"), (1, 1, "z"), (2, None, "a"), (2, 9, "q"))
    result = enrich_left(people, lookup, {"id": "k"}, {"v": "v"}, order_by=["rank"])
    assert rows(result) == [(1, "z"), (2, "q")]


def test_enrich_keep_leaves_unmatched_rows_alone(spark):
    courses = frame(spark, "id int, name string", (1, "old"), (2, "old"), (3, "old"))
    lookup = frame(spark, "id int, name string, state string", (1, "new", "ok"), (2, "new", "bad"), (3, None, "ok"))
    kept = enrich_left(
        courses, lookup, {"id": "id"}, {"name": "name"}, unmatched="keep", condition=F.col("state") == "ok"
    )
    # A match whose value is NULL does update; a row whose only match fails the condition does not.
    assert rows(kept) == [(1, "new"), (2, "old"), (3, None)]
    with pytest.raises(ValueError):
        enrich_left(courses, lookup, {"id": "id"}, {"name": "name"}, unmatched="other")


def test_enrich_with_several_keys_and_same_named_columns(spark):
    left = frame(spark, "a int, b int, v int", (1, 1, 0), (1, None, 0), (2, 2, 0))
    lookup = frame(spark, "a int, b int, v int", (1, 1, 5), (1, None, 6), (2, 1, 7))
    result = enrich_left(left, lookup, {"a": "a", "b": "b"}, {"v": "v", "w": "v"})
    assert rows(result) == [(1, 1, 5, 5), (1, None, None, None), (2, 2, None, None)]


def test_enrich_holds_ids_above_2_to_53(spark):
    big = 35910000000088713
    left = frame(spark, "id bigint", (big,), (big + 1,))
    lookup = frame(spark, "id bigint, v string", (big, "a"), (big + 1, "b"))
    assert rows(enrich_left(left, lookup, {"id": "id"}, {"v": "v"})) == [(big, "a"), (big + 1, "b")]


def test_enrich_against_brute_force(spark):
    rng = random.Random(7)
    pick = lambda n: rng.choice([None, *range(n)])
    left = [(i, pick(6), pick(3)) for i in range(300)]
    right = [(pick(6), pick(3), pick(9), pick(4)) for _ in range(200)]
    result = enrich_left(
        frame(spark, "i int, a int, b int", *left), frame(spark, "a int, b int, r int, v int", *right),
        {"a": "a", "b": "b"}, {"v": "v"}, order_by=["r"],
    )
    last = lambda x: (x is None, x or 0)

    def winner(a, b):
        matches = [m for m in right if None not in (a, b) and m[:2] == (a, b)]
        return min(matches, key=lambda m: (last(m[2]), last(m[3])))[3] if matches else None

    assert rows(result) == sorted(((i, a, b, winner(a, b)) for i, a, b in left), key=repr)


def test_enrich_per_key_equals_a_lookup_per_row(spark):
    data = [(i, k, j) for i, (k, j) in enumerate([(1, 1), (1, 1), (1, None), (None, 1), (None, None), (2, 2), (3, 1)])]
    left = frame(spark, "i int, k int, j int", *data)
    by_k = frame(spark, "k int, v string", (1, "b"), (1, "a"), (2, "c"))
    by_j = frame(spark, "j int, w string", (1, "x"))

    def fill(keys):
        return enrich_left(enrich_left(keys, by_k, {"k": "k"}, {"v": "v"}), by_j, {"j": "j"}, {"w": "w"})

    assert rows(enrich_per_key(left, ["k", "j"], fill)) == rows(fill(left))
    assert rows(enrich_per_key(left, ["k", "j"], fill, left.where("i <> 0"))) == rows(fill(left))


def test_join_distinct_fans_out_once_per_distinct_row(spark):
    left = frame(spark, "u int, x int", (1, 0), (2, 0), (None, 0))
    names = frame(spark, "u int, name string", (1, "a"), (1, "a"), (1, None), (3, "c"), (None, "n"))
    assert rows(join_distinct(left, names, "u")) == [(1, 0, "a"), (1, 0, None), (2, 0, None), (None, 0, None)]


# --- keys --------------------------------------------------------------------------------------------------------------


def test_keep_min_keeps_ties_and_nulls(spark):
    data = [(1, "f", 5), (1, "f", 4), (1, "f", 4), (1, "f", None), (None, "f", 9), (None, "f", 8), (1, None, 7), (2, "f", 6)]
    kept = keep_min_per_key(frame(spark, "k int, q string, id int", *data), ["k", "q"], "id")
    assert rows(kept) == sorted(
        [(1, "f", 4), (1, "f", 4), (1, "f", None), (None, "f", 9), (None, "f", 8), (1, None, 7), (2, "f", 6)], key=repr
    )


def test_keep_min_against_theta_self_join(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), rng.choice([None, *range(8)]), i) for i in range(400)]
    expected = [
        t for t in data
        if not any(
            None not in (t[0], t[1], t[2], u[2]) and t[:2] == u[:2] and t[2] > u[2] for u in data
        )
    ]
    kept = keep_min_per_key(frame(spark, "a int, b int, id int, i int", *data), ["a", "b"], "id")
    assert rows(kept) == sorted(expected, key=repr)


def test_dedupe_and_latest(spark):
    log = frame(spark, "t string, at int, n int", ("a", 1, 9), ("a", 2, 8), ("a", 2, 7), ("b", None, 1), ("b", 5, 2))
    assert rows(dedupe_on_key(log, ["t"], ["at"])) == [("a", 1, 9), ("b", 5, 2)]
    assert rows(latest_per_key(log, "t", "at")) == [("a", 2, 8), ("b", 5, 2)]


def test_dense_sequence_numbers_every_row_once_in_order(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, *range(50)]), i) for i in range(2000)]
    numbered = dense_sequence(frame(spark, "v int, i int", *data).repartition(7), ["v"]).collect()
    assert sorted(r["seq_num"] for r in numbered) == list(range(1, 2001))
    by_number = sorted(numbered, key=lambda r: r["seq_num"])
    expected = sorted(data, key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    assert [(r["v"], r["i"]) for r in by_number] == expected


def test_dense_sequence_with_copies_and_no_rows(spark):
    copies = frame(spark, "v int", *[(1,)] * 500)
    assert sorted(r["n"] for r in dense_sequence(copies, ["v"], "n", start=0).collect()) == list(range(500))
    assert dense_sequence(copies.where("v = 2"), ["v"]).count() == 0


def test_dense_sequence_splits_hot_keys_and_writes_nothing(spark, tmp_path):
    from coursemart.operators import keys
    from coursemart.session import shared_dir

    rng = random.Random(3)
    # A third of the rows are one copy, another share has a NULL order key with differing rest columns.
    data = [(7, "hot")] * 1500 + [(None, f"n{rng.randrange(300)}") for _ in range(1000)]
    data += [(rng.randrange(100), rng.choice(["a", None, "b"])) for _ in range(2000)]
    before = sorted(p.name for p in Path(shared_dir(spark)).rglob("*"))
    old = keys.COPY_CHUNK
    keys.COPY_CHUNK = 64
    try:
        numbered = dense_sequence(frame(spark, "v int, s string", *data).repartition(5), ["v"], buckets=9)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        got = sorted(numbered.collect(), key=lambda r: r["seq_num"])
    finally:
        keys.COPY_CHUNK = old
    assert [r["seq_num"] for r in got] == list(range(1, len(data) + 1))
    expected = sorted(data, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or ""))
    assert [(r["v"], r["s"]) for r in got] == expected
    assert "Write" not in plan
    assert sorted(p.name for p in Path(shared_dir(spark)).rglob("*")) == before
    assert len(keys._boundaries(frame(spark, "v int", *[(1,)] * 3000).groupBy("v").agg(F.count("*").alias("_n"))
               .select("v", F.lit(0).cast("long").alias("_c"), F.col("_n").alias("_len")), ["v"], 8, 3000)) == 1


def test_newest_n_counts_a_snapshot_once(spark):
    snaps = frame(spark, "root string, at int", ("T", 1), ("T", 2), ("T", 2), ("T", 3), ("C", 1))
    assert rows(newest_n(snaps, "root", "at", 2)) == [("C", 1, 1), ("T", 2, 2), ("T", 3, 1)]


# --- rows --------------------------------------------------------------------------------------------------------------


def test_deletes_keep_null_and_unmatched_rows(spark):
    t = frame(spark, "id int, state string", (1, "x"), (2, None), (3, "y"))
    assert rows(delete_where(t, F.col("state") == "x")) == [(2, None), (3, "y")]
    lookup = frame(spark, "k int, s string", (1, "bad"), (1, "ok"), (2, "ok"), (None, "bad"))
    left = frame(spark, "k int", (1,), (2,), (3,), (None,))
    assert rows(delete_matching(left, lookup, {"k": "k"}, F.col("s") != "ok")) == [(2,), (3,), (None,)]


def test_anti_join_append_fills_the_rest_with_null(spark):
    have = frame(spark, "course int, a int, q int", (1, 10, 7))
    quizzes = frame(spark, "id int, course int", (7, 1), (8, 2), (9, None))
    result = anti_join_append(have, quizzes, {"course": "course"}, {"course": "course", "q": "id"})
    assert rows(result) == [(1, 10, 7), (2, None, 8), (None, None, 9)]


def test_left_join_large_keeps_unmatched_rows(spark):
    left = frame(spark, "k int, a int", (1, 1), (2, 2), (None, 3), (1, 4))
    right = frame(spark, "k int, b int", (1, 10), (1, 11), (3, 12), (None, 13))
    assert rows(left_join_large(left, right, ["k"])) == rows(left.join(right, "k", "left"))


def test_key_comparisons(spark):
    expected = frame(spark, "t string", ("Terms",), ("Modules",), ("Modules",))
    present = frame(spark, "t string", ("Terms",), ("Table1",), ("Terms",))
    assert rows(missing_keys(expected, present, ["t"])) == [("Modules",)]
    assert rows(common_keys(expected, present, ["t"])) == [("Terms",)]
    many = frame(spark, "t string, n int", ("Terms", 1), ("Terms", 2), (None, 3))
    assert rows(restrict_to_keys(many, present, {"t": "t"})) == [("Terms", 1), ("Terms", 2)]


def test_union_sources_runs_the_query_per_source(spark):
    sources = {
        "CourseraA": frame(spark, "u int", (1,), (1,), (2,)),
        "my_coursera_b": frame(spark, "u int", (1,)),
        "other": frame(spark, "u int", (9,)),
    }
    plain = union_sources(sources, "%coursera%", {"user_id": F.col("u")}, where=F.col("u") < 2)
    assert rows(plain) == [(1,), (1,), (1,)]
    grouped = union_sources(
        sources, "%coursera%", {"user_id": F.col("u"), "n": F.count("*")}, group_by=[F.col("u")]
    )
    assert rows(grouped) == [(1, 1), (1, 2), (2, 1)]
    with pytest.raises(ValueError):
        union_sources(sources, "none", {"u": F.col("u")})


# --- counts and batches ------------------------------------------------------------------------------------------------


def test_outer_counts(spark):
    courses = frame(spark, "course int", (1,), (2,), (3,), (3,), (None,))
    enrolled = frame(spark, "course int", (1,), (1,), (3,), (None,))
    assert rows(count_matches_outer(courses, enrolled, "course")) == [(1, 2), (2, 1), (3, 2)]
    assert rows(count_matches_outer(courses, enrolled, "course", exact=True)) == [(1, 2), (2, 0), (3, 1)]
    assert rows(count_pairs_by_key(courses, "course", enrolled, "course")) == [(1, 2), (3, 2)]


def test_conditional_counts_are_null_when_nothing_counts(spark):
    progress = frame(spark, "m int, s string", (1, "started"), (1, "started"), (1, "locked"), (2, "completed"))
    counts = conditional_counts(progress, "m", {"a": F.col("s") == "started", "b": F.col("s") == "completed"})
    assert rows(counts) == [(1, 2, None), (2, None, 1)]


def test_volume_batches(spark):
    data = [(1,)] * 1200 + [(2,)] * 1000 + [(3,)] * 999 + [(4,)] * 5 + [(None,)] * 2000
    assignment = volume_batches(frame(spark, "account_id int", *data), "account_id")
    assert rows(assignment) == [
        (1, 1200, "1"), (2, 1000, "2"), (3, 999, "shared"), (4, 5, "shared"), (None, 2000, "shared"),
    ]
    assert [tuple(r) for r in batch_sizes(assignment).collect()] == [("shared", 3, 3004), ("1", 1, 1200), ("2", 1, 1000)]


def test_least_rows_in_two_steps_with_ties_nulls_and_a_hot_key(spark):
    data = [("a", 1, "z"), ("a", 1, "b"), ("a", 2, "a"), ("a", None, "0"), ("b", None, "y"), ("b", None, "x"), (None, 3, "n"),
            (None, 1, "m"), ("c", 5, None), ("c", 5, "q")] + [("h", i % 7, f"t{i}") for i in range(3000)]
    log = frame(spark, "t string, at int, s string", *data).repartition(5)
    plain = {}
    for t, at, s in data:
        key = (at is None, at if at is not None else 0, s is None, s or "")
        if t not in plain or key < plain[t][0]:
            plain[t] = (key, (t, at, s))
    assert rows(dedupe_on_key(log, ["t"], ["at"])) == sorted((v[1] for v in plain.values()), key=repr)
    plan = dedupe_on_key(log, ["t"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan.split("Union")[0]


def test_winner_per_key_by_order_then_value(spark):
    lookup = frame(spark, "k int, id int, v string", (1, 2, "b"), (1, 1, "z"), (1, 1, "y"), (2, None, "a"), (2, None, "0"), (None, 1, "n"))
    assert rows(winner_per_key(lookup, ["k"], ["v"], ["id"])) == [(1, "y"), (2, "0")]
