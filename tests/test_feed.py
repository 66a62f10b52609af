"""Extraction, routing and record assembly."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.catalog.spec import TableSpec
from rowtide.operators import apply, extract
from rowtide.operators.decode import decode_feed, decode_latest
from rowtide.sources import feed as feeds

SPEC = TableSpec.parse("warehouse", "w_id", "w_id int32!, w_ytd float32!")
SHAPE = feeds.EVENT
I100, I200 = bytes.fromhex("42C80000"), bytes.fromhex("43480000")


def key(n):
    return n.to_bytes(4, "big", signed=True)


def event(op, before, after, order=1, table="warehouse", sub=0):
    return (op, before, after, ("db", "bench", table), (str(order), order, sub))


def make(spark, *events):
    return spark.createDataFrame(list(events), SHAPE)


def test_update_takes_the_after_image(spark):
    feed = make(spark, event("UPDATE", [key(1), I100], [key(1), I200]))
    wide = extract.extract_images(feed).first()
    assert [bytes(c) for c in wide["_cols"]] == [key(1), I100, key(1), I200]
    rows, rejects = decode_feed(feed, SPEC)
    assert [(r["w_id"], r["w_ytd"]) for r in rows.collect()] == [(1, 200.0)]
    assert rejects.isEmpty()


def test_operations_and_drops(spark):
    a, b = [key(1), I100], [key(2), I200]
    feed = make(
        spark,
        event("insert", [], a),
        event("3", [], b),
        event("2", a, []),
        event(None, None, a),
        event("UPDATE", [], a),
        event("UPDATE", a, None),
        event("DELETE", [], a),
        event("INSERT", a, []),
        event("TRUNCATE", a, a),
    )
    kept = sorted(r["_op"] for r in extract.extract_images(feed).collect())
    assert kept == ["DELETE", "INSERT", "INSERT", "SNAPSHOT"]
    direct = sorted(r["_op"] for r in extract.record_images(feed, SPEC).collect())
    assert direct == kept
    reasons = sorted(r["reason"] for r in extract.dropped_events(feed).collect())
    assert reasons == ["empty_after", "empty_after", "empty_before", "empty_before", "unknown_op"]


@pytest.mark.parametrize("before, after", [(1, 2), (2, 1), (3, 2), (2, 3), (1, 1), (3, 3)])
def test_shortcut_image_equals_the_joined_one(spark, before, after):
    cells = [key(n) for n in range(6)]
    feed = make(spark, event("UPDATE", cells[:before], cells[3 : 3 + after]))
    slow = extract.extract_images(feed).select(
        extract.after_image(F.col("_cols"), F.col("_op"), 2).alias("image")
    )
    fast = extract.record_images(feed, SPEC)
    # cells beyond the table's width are never looked at
    assert slow.first()[0] == fast.first()["_image"][:2]


def test_update_with_only_one_image_is_rejected_whole(spark):
    feed = make(spark, event("UPDATE", [key(1)], [I200]))
    rows, rejects = decode_feed(feed, SPEC)
    assert rows.isEmpty() and rejects.first()["reject_reason"] == "missing"


def test_key_change_becomes_delete_and_set(spark):
    feed = make(
        spark,
        event("UPDATE", [key(1), I100], [key(2), I100], 5),
        event("UPDATE", [key(3), I100], [key(3), I200], 6),
    )
    rows, _ = decode_feed(feed, SPEC, split_key_changes=True)
    got = sorted((r["_order"]["total_order"], r["_order"]["step"], r["_op"], r["w_id"]) for r in rows.collect())
    assert got == [(5, 0, "DELETE", 1), (5, 1, "UPDATE", 2), (6, 1, "UPDATE", 3)]


def test_reducing_before_decoding_gives_the_same_rows(spark):
    rng = random.Random(5)
    image = [[key(k), I100 if k % 2 else I200] for k in range(9)]
    batch = [event("INSERT", [], [b"\0", I100], 500)]
    for n in range(300):
        k = 0 if n % 3 == 0 else rng.randrange(9)
        op = rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        moved = image[rng.randrange(9)] if rng.random() < 0.2 else image[k]
        batch.append(event(op, image[k], moved, n))
    rng.shuffle(batch)
    feed = make(spark, *batch)
    events, rejects = decode_feed(feed, SPEC, split_key_changes=True)
    latest, same_rejects = decode_latest(feed, SPEC)
    want = apply.latest_changes(events, SPEC.pk).orderBy("w_id").collect()
    assert apply.as_changes(latest).orderBy("w_id").collect() == want
    assert rejects.count() == same_rejects.count() == 1


def test_poll_prunes_directories(spark, tmp_path):
    feed = make(spark, *[event("INSERT", [], [key(n), I100], n) for n in range(8)])
    landed = feed.select(
        "*",
        F.lit("bench").alias("feed_schema"),
        F.when(F.col("txn.total_order") < 4, "warehouse").otherwise("other").alias("feed_table"),
        (F.col("txn.total_order") % 2).cast("int").alias("bucket"),
    )
    feeds.land(landed, str(tmp_path / "feed"))
    stored = feeds.read_feed(spark, str(tmp_path / "feed"))
    assert feeds.poll(stored, "bench", "warehouse").count() == 4
    picked = feeds.poll(stored, "bench", "warehouse", [1])
    assert sorted(r["txn"]["total_order"] for r in picked.collect()) == [1, 3]
    rows, _ = decode_feed(picked, SPEC)
    scans = rows._jdf.queryExecution().executedPlan().collectLeaves().mkString()
    assert "id:string" not in scans.split("ReadSchema:")[1]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "feed_schema" in filters and "feed_table" in filters and "bucket" in filters


def test_decode_prunes_columns_and_keeps_python_out(spark):
    rows, _ = decode_feed(make(spark, event("INSERT", [], [key(1), I100])), SPEC)
    plan = rows.select("w_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "POWER" not in plan.upper() and "Python" not in plan
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
