"""Mutations and the two apply modes: scenarios, split invariance, hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import apply, mutate

EVENT = (
    "_op string, _order struct<total_order:bigint,data_collection_order:bigint,step:int>, "
    "id int, v string"
)


def events(spark, *rows):
    return spark.createDataFrame([(op, (i, 0, 1), k, v) for i, (op, k, v) in enumerate(rows)], EVENT)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, v string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCENARIOS = [
    ([], [("INSERT", 1, "a"), ("UPDATE", 1, "b")], [(1, "b")], [(1, "b")]),
    ([], [("INSERT", 1, "a"), ("DELETE", 1, "a")], [], []),
    ([(1, "o")], [("DELETE", 1, "o"), ("INSERT", 1, "a")], [(1, "a")], []),
    ([], [("UPDATE", 1, "b"), ("UPDATE", 1, "c")], [(1, "c")], [(1, "c")]),
    ([], [("INSERT", 1, "a"), ("INSERT", 1, "a")], [(1, "a")], [(1, "a"), (1, "a")]),
    ([], [("UPDATE", 9, "z")], [(9, "z")], [(9, "z")]),
    ([], [("SNAPSHOT", 1, "s"), ("UPDATE", 1, "t")], [(1, "t")], [(1, "t")]),
    ([(1, "o")], [("DELETE", None, "o")], [(1, "o")], [(1, "o")]),
    ([(1, "o")], [("UPDATE", None, "u")], [(1, "o"), (None, "u")], [(1, "o"), (None, "u")]),
    ([(1, "o"), (1, "p")], [("UPDATE", 1, "u")], [(1, "u")], [(1, "u"), (1, "u")]),
    ([(1, "o")], [("UPDATE", 1, None)], [(1, None)], [(1, None)]),
]


@pytest.mark.parametrize("before, batch, ordered, grouped", SCENARIOS)
def test_scenarios(spark, before, batch, ordered, grouped):
    t, e = table(spark, *before), events(spark, *batch)
    assert rows_of(apply.apply_ordered(t, e, ["id"])) == sorted(ordered, key=repr)
    assert rows_of(apply.apply_grouped(t, e, ["id"])) == sorted(grouped, key=repr)


def brute(batch):
    state = {}
    for _, op, k, v in sorted(batch):
        if op == "DELETE":
            state.pop(k, None)
        else:
            state[k] = v
    return sorted(state.items(), key=repr)


def test_ordered_apply_does_not_depend_on_the_split(spark):
    rng = random.Random(7)
    ops = ["INSERT", "UPDATE", "DELETE", "SNAPSHOT"]
    # one key holds a third of all changes
    feed = [(n, rng.choice(ops), 0 if n % 3 == 0 else rng.randrange(12), f"v{n}") for n in range(240)]
    rng.shuffle(feed)
    for cuts in (1, 4):
        size = -(-len(feed) // cuts)
        state = None
        for start in range(0, len(feed), size):
            part = [(op, (n, 0, 1), k, v) for n, op, k, v in feed[start : start + size]]
            changes = apply.latest_changes(spark.createDataFrame(part, EVENT), ["id"])
            state = apply.merge_changes(state, changes, ["id"], broadcast_keys=cuts == 4)
            state = spark.createDataFrame(state.collect(), state.schema)
        assert rows_of(apply.live(state)) == brute(feed)
    whole = spark.createDataFrame([(op, (n, 0, 1), k, v) for n, op, k, v in feed], EVENT)
    assert rows_of(apply.apply_ordered(None, whole, ["id"])) == brute(feed)


def test_ordered_state_ignores_late_and_repeated_events(spark):
    late = spark.createDataFrame([("UPDATE", (1, 0, 1), 1, "old")], EVENT)
    new = spark.createDataFrame([("DELETE", (2, 0, 1), 1, "x"), ("UPDATE", (2, 1, 1), 2, "y")], EVENT)
    state = apply.merge_changes(None, apply.latest_changes(new, ["id"]), ["id"])
    for batch in (late, new):
        state = apply.apply_ordered(state, batch, ["id"])
    assert rows_of(apply.live(state)) == [(2, "y")]


def test_grouped_matches_three_steps(spark):
    rng = random.Random(3)
    t = [(rng.randrange(20), f"t{i}") for i in range(30)] + [(5, f"hot{i}") for i in range(20)]
    batch = [(rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), rng.randrange(25), f"e{i}") for i in range(40)]
    want = t + [(k, v) for op, k, v in batch if op == "INSERT"]
    last = {k: v for op, k, v in batch if op == "UPDATE"}
    have = {k for k, _ in want}
    want = [(k, last.get(k, v)) for k, v in want] + [(k, v) for k, v in last.items() if k not in have]
    gone = {k for op, k, _ in batch if op == "DELETE"}
    want = sorted(((k, v) for k, v in want if k not in gone), key=repr)
    assert rows_of(apply.apply_grouped(table(spark, *t), events(spark, *batch), ["id"])) == want


@pytest.mark.parametrize("unique", [False, True])
def test_upsert(spark, unique):
    t = table(spark, (1, "a"), (2, "b"), (None, "n"))
    s = events(spark, ("U", 2, "x"), ("U", 2, "y"), ("U", 3, "z"), ("U", None, "m"), ("U", None, "k"))
    got = rows_of(mutate.upsert(t, s, "id", ["_order"], unique_target=unique))
    assert got == sorted([(1, "a"), (2, "y"), (3, "z"), (None, "n"), (None, "k")], key=repr)
    with pytest.raises(ValueError):
        mutate.upsert(t, s, None, ["_order"])


def test_upsert_keeps_the_number_of_duplicate_rows(spark):
    t = table(spark, (1, "a"), (1, "b"), (2, "c"))
    s = events(spark, ("U", 1, "x"))
    assert rows_of(mutate.upsert(t, s, ["id"], ["_order"])) == [(1, "x"), (1, "x"), (2, "c")]
    assert rows_of(mutate.upsert(None, s, ["id"], ["_order"])) == [("U", (0, 0, 1), 1, "x")]


def test_delete(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d")], "x int, y int, v string")
    keys = spark.createDataFrame([(1, 2), (2, 1), (2, 1), (None, 1)], "x int, y int")
    assert rows_of(mutate.delete(t, keys, ["x", "y"])) == sorted([(1, 1, "a"), (None, 1, "d")], key=repr)
    for bad in ((None, "x"), (t, None)):
        with pytest.raises(ValueError):
            mutate.delete(bad[0], keys, bad[1])


def test_delete_by_timestamp_key(spark):
    t = spark.sql("select timestamp'2024-01-01 00:00:00' as at, 1 as v union all select timestamp'2024-01-02', 2")
    assert rows_of(mutate.delete(t, t.where("v = 1"), "at").select("v")) == [(2,)]


def test_duplicates_report_and_null_keys(spark):
    s = events(spark, ("U", 1, "a"), ("U", 1, "b"), ("U", None, "c"), ("U", None, "d"))
    assert tuple(mutate.duplicate_report(s, "id").first()) == (4, 2, 2)
    assert rows_of(mutate.last_wins(s, "id", ["_order"]).select("id", "v")) == sorted([(1, "b"), (None, "d")], key=repr)


def test_order_may_be_an_expression(spark):
    s = events(spark, ("U", 1, "a"), ("U", 1, "b"))
    earliest = mutate.last_wins(s, "id", [-F.col("_order.total_order")])
    assert rows_of(earliest.select("v")) == [("a",)]


def test_conform(spark):
    t = spark.createDataFrame([(1, 2, "x")], "a bigint, b int, c string")
    s = spark.createDataFrame([("7", "drop")], "A string, z string")
    out = mutate.append(t, s)
    assert out.schema["b"].dataType.simpleString() == "int"
    assert rows_of(out) == sorted([(1, 2, "x"), (7, None, None)], key=repr)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(3000).select(
        F.lit("UPDATE").alias("_op"),
        F.struct(F.col("id").alias("total_order"), F.lit(0).cast("long").alias("data_collection_order"),
                 F.lit(1).alias("step")).alias("_order"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("id"),
        F.col("id").cast("string").alias("v"),
    )
    reduced = apply.latest_changes(hot, ["id"])
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert reduced.where("id = 0").first()["v"] == "2997" and reduced.count() == 2001
