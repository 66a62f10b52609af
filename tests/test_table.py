"""The stored table: versions, mutations, conflicts, streaming, several tables."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.catalog.spec import TableSpec
from rowtide.operators import audit, scan
from rowtide.plans import jobs
from rowtide.plans.table import KeyedTable, is_retryable
from rowtide.sources import feed as feeds
from rowtide.sources.storage import AlreadyExists, Storage, connect, scratch_dir
from rowtide.streaming.apply import committed, start_apply, start_apply_tables, start_print

SPEC = TableSpec.parse("Acct", "id", "id int32!, v varchar(8)")


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path), SPEC, buckets=4)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, v string")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_missing_table(spark, table):
    assert not table.exists() and table.info() is None and table.ensure_key_layout() == 0
    for call in (table.read, lambda: table.delete(rows(spark, (1, "a")))):
        with pytest.raises(ValueError):
            call()


def test_versions(spark, table):
    table.append(rows(spark, *[(i, "a") for i in range(20)]))
    table.upsert(rows(spark, (1, "b"), (99, "n")))
    table.delete(rows(spark, (2, ""), (77, "")))
    table.overwrite(rows(spark, (5, "only")))
    assert content(table.read()) == [(5, "only")]
    assert table.read(1).count() == 20
    second = dict(content(table.read(2)))
    assert second[1] == "b" and second[99] == "n" and len(second) == 21
    third = dict(content(table.read(3)))
    assert 2 not in third and len(third) == 20
    assert table.info() == {"name": "Acct", "schema": "struct<id:int,v:string>", "record_count": 1, "version": 4}
    with pytest.raises(ValueError):
        table.read(9)
    assert table.path.endswith("/acct")
    hits = table.query("id < 3 and v = 'a'", ["id"], "id desc", 5, version=1)
    assert [r["id"] for r in hits.collect()] == [2, 1, 0]


def test_a_batch_writes_only_its_own_rows(spark, table):
    table.append(rows(spark, *[(i, "a") for i in range(40)]))
    first = next(iter(table.version().parts))
    table.upsert(rows(spark, (3, "b")))
    table.delete(rows(spark, (4, "")))
    parts = table.version().parts
    assert len(parts[first].buckets) == 4 and [(p.kind, p.rows) for n, p in parts.items() if n != first] == [("run", 1)] * 2
    assert table.count() == 39 and dict(content(table.read()))[3] == "b"


def test_all_null_column_keeps_its_type(spark, tmp_path):
    spec = TableSpec.parse("o", "id", "id int32!, carrier int32")
    table = KeyedTable(spark, str(tmp_path), spec, buckets=2)
    table.append(spark.createDataFrame([(1,), (2,)], "id int"))
    table.append(spark.createDataFrame([(3, 5)], "id int, carrier int"))
    assert table.read().schema["carrier"].dataType.simpleString() == "int"
    assert content(table.read()) == [(1, None), (2, None), (3, 5)]


def test_empty_results(spark, table):
    table.append(rows(spark, (1, "a")))
    table.delete(rows(spark, (1, "")))
    assert table.read().count() == 0
    table.append(spark.createDataFrame([], "id int, v string"))
    table.upsert(rows(spark, (2, "b")))
    assert content(table.read()) == [(2, "b")]


def test_conflict_is_retried_on_the_newer_version(spark, table, monkeypatch):
    table.append(rows(spark, (1, "a")))
    rival = KeyedTable(spark, table.path.rsplit("/", 1)[0], SPEC, buckets=4)
    create, raced = Storage.create_text, []

    def late(self, path, text):
        if not raced:
            raced.append(path)
            rival.append(rows(spark, (2, "r")))
        return create(self, path, text)

    monkeypatch.setattr(Storage, "create_text", late)
    table.upsert(rows(spark, (1, "b")))
    assert content(table.read()) == [(1, "b"), (2, "r")] and table.version().number == 3


def test_retry_gives_up(spark, table, monkeypatch):
    calls = []

    def refuse(self, path, text):
        calls.append(path)
        raise AlreadyExists(path)

    monkeypatch.setattr(Storage, "create_text", refuse)
    with pytest.raises(AlreadyExists):
        table.append(rows(spark, (1, "a")))
    assert len(calls) == 3
    assert is_retryable(AlreadyExists("x")) and not is_retryable(Exception("conflict, timeout, already exists"))
    with pytest.raises(Exception) as refused:
        spark._jvm.java.net.Socket("127.0.0.1", 1)
    assert is_retryable(refused.value)


def test_layout_run(spark, table):
    for n in range(3):
        table.append(rows(spark, *[(i, str(n)) for i in range(20)]))
    assert len(table.version().parts) == 3
    assert table.ensure_key_layout() == 4 and len(table.version().parts) == 1
    assert table.read().count() == 60 and table.ensure_key_layout() == 0


def test_key_marks(spark, tmp_path):
    spec = TableSpec.parse("d", "d_w_id, d_id", "d_id int32!, d_w_id int32!, x float32")
    table = KeyedTable(spark, str(tmp_path), spec, buckets=2)
    table.append(spark.createDataFrame([(1, 2, 3.0)], "d_id int, d_w_id int, x float"))
    assert {(n, p) for n, _, _, p in audit.key_marks(table.read())} == {("d_w_id", 1), ("d_id", 2)}
    assert audit.has_key_marks(table.read()) and not audit.has_key_marks(spark.range(1))
    assert audit.layout_report(spark, {"d": spec}).first()["computed"] == 12


def image(k, v):
    return [k.to_bytes(4, "big"), v.encode()]


def make_feed(spark, *events, name="acct"):
    data = [
        (op, before, after, ("db", "s", name), (str(n), n, 0), "s", name, n % 2)
        for n, (op, before, after) in enumerate(events)
    ]
    return spark.createDataFrame(data, feeds.FEED)


EVENTS = [
    ("INSERT", [], image(1, "a")),
    ("INSERT", [], image(2, "b")),
    ("UPDATE", image(1, "a"), image(1, "c")),
    ("UPDATE", image(2, "b"), image(3, "b")),
    ("DELETE", image(1, "c"), []),
    ("INSERT", [], [b"\0\0", b"x"]),
    ("SNAPSHOT", [], image(1, "z")),
]


def test_apply_feed_modes(spark, tmp_path):
    ordered = KeyedTable(spark, str(tmp_path / "o"), SPEC, buckets=4)
    rejects = ordered.apply_feed(make_feed(spark, *EVENTS))
    assert content(ordered.read()) == [(1, "z"), (3, "b")]
    assert [(r["reject_field"], r["reject_reason"]) for r in rejects.collect()] == [("id", "malformed")]
    grouped = KeyedTable(spark, str(tmp_path / "g"), SPEC, buckets=4)
    grouped.apply_feed(make_feed(spark, *EVENTS), mode="grouped")
    assert content(grouped.read()) == [(2, "b"), (3, "b")]
    grouped.apply_feed(make_feed(spark, ("INSERT", [], image(7, "q")), ("UPDATE", image(2, "b"), image(2, "w"))), "grouped")
    assert content(grouped.read()) == [(2, "w"), (3, "b"), (7, "q")]
    with pytest.raises(ValueError):
        ordered.apply_feed(make_feed(spark, *EVENTS), mode="other")


def test_replayed_batch_changes_nothing(spark, table):
    feed = make_feed(spark, ("INSERT", [], image(1, "a")))
    for _ in range(2):
        table.apply_feed(feed, "grouped", ("feed", 0))
    assert content(table.read()) == [(1, "a")] and table.version().number == 1
    table.apply_feed(feed, "grouped", ("feed", 1))
    assert table.read().count() == 2


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    path, check = str(tmp_path / "feed"), str(tmp_path / "check")
    table = KeyedTable(spark, str(tmp_path / "db"), SPEC, buckets=4)
    feed = make_feed(spark, *EVENTS)
    for part in (feed.where("txn.total_order >= 4"), feed.where("txn.total_order < 4")):
        feeds.land(part.coalesce(1), path)
        stream = feeds.stream_feed(spark, path, max_files=1)
        start_apply(stream, table, check, rejects_path=str(tmp_path / "rejects")).awaitTermination()
    assert content(table.read()) == [(1, "z"), (3, "b")]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1
    done = table.version().number
    start_apply(feeds.stream_feed(spark, path), table, check).awaitTermination()
    assert table.version().number == done


def test_print_mode(spark, tmp_path):
    feeds.land(make_feed(spark, *EVENTS[:1]), str(tmp_path / "feed"))
    shown = start_print(feeds.stream_feed(spark, str(tmp_path / "feed"), max_bytes=1 << 30))
    shown.awaitTermination()
    assert sum(p["numInputRows"] for p in shown.recentProgress) == 1


def test_several_tables(spark, tmp_path):
    feed = make_feed(spark, *EVENTS).unionByName(make_feed(spark, ("INSERT", [], image(5, "x")), name="other"))
    specs = {"acct": SPEC, "other": TableSpec.parse("other", "id", "id int32!, v varchar(8)"), "bad": TableSpec.parse("bad", "", "id int32")}
    status = jobs.apply_tables(spark, feed, "s", specs, str(tmp_path), table_buckets=2)
    got = {r["table"]: (r["ok"], r["records"]) for r in status.collect()}
    assert got == {"acct": (True, 2), "other": (True, 1), "bad": (False, None)}
    counts = jobs.bucket_counts(feed, "s", ["acct"])
    assert {(r["table"], r["bucket"]): r["events"] for r in counts.collect()} == {("acct", 0): 4, ("acct", 1): 3}


def test_scans(spark):
    people = spark.createDataFrame([(1, "Al", 60), (2, "Bo", 40), (3, "Ab", 70)], "id int, name string, age int")
    hits = scan.scan(people, "age > 50 AND name LIKE 'A%'", ["name"], "age DESC, id", 1)
    assert [r["name"] for r in hits.collect()] == ["Ab"]
    assert tuple(scan.column_ranges(people, ["age"]).first()) == (40, 70)
    assert [tuple(r) for r in scan.value_counts(people, "age").collect()][0] == (70, 1)
    assert scan.distinct_values(people, "age").first()[0] == 3
    assert [r["id"] for r in scan.newest(people, 2, "age", ["id"]).collect()] == [3, 1]


def test_scratch_and_options(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root)
    connect(spark, {"fs.test.a": "1", "fs.test.b": "", "fs.test.c": None})
    conf = spark._jsc.hadoopConfiguration()
    assert conf.get("fs.test.a") == "1" and conf.get("fs.test.b") is None


def _bytes_under(folder):
    files = [f for f in folder.rglob("*.parquet")]
    return len(files), sum(f.stat().st_size for f in files)


def test_ordered_batch_writes_do_not_grow_with_the_table(spark, tmp_path):
    batch = make_feed(spark, *[("UPDATE", image(i, "a"), image(i, "b")) for i in range(40)])
    written = []
    for size in (1_000, 60_000):
        table = KeyedTable(spark, str(tmp_path / str(size)), SPEC, buckets=4)
        table.append(spark.range(size).selectExpr("cast(id as int) AS id", "repeat('v', 8) AS v"))
        before = _bytes_under(tmp_path / str(size))
        table.apply_feed(batch)
        after = _bytes_under(tmp_path / str(size))
        written.append((after[0] - before[0], after[1] - before[1]))
        assert table.read().count() == size and table.read().where("v = 'b'").count() == 40
    assert written[0][0] == written[1][0] and abs(written[0][1] - written[1][1]) < 500


def ordered_feed(spark, first, *events):
    feed = make_feed(spark, *events)
    order = F.col("txn.total_order") + first
    return feed.withColumn("txn", F.struct(F.lit("t").alias("id"), order.alias("total_order"), F.lit(0).cast("long").alias("data_collection_order")))


def test_deltas_fold_and_expire(spark, tmp_path, monkeypatch):
    from rowtide.plans import table as module

    monkeypatch.setattr(module, "FAN", 4)
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=1)
    for n, v in enumerate("abcd"):
        table.apply_feed(ordered_feed(spark, 10 * n, ("INSERT", [], image(1, v)), ("INSERT", [], image(n + 2, v))))
    assert table.version().deltas == [] and len(table.version().parts) == 1
    assert content(table.read()) == [(1, "d"), (2, "a"), (3, "b"), (4, "c"), (5, "d")]
    assert content(table.read(version=2)) == [(1, "b"), (2, "a"), (3, "b")]
    assert table.expire(keep=1) == 4 and table.versions() == [5]
    assert content(table.read()) == [(1, "d"), (2, "a"), (3, "b"), (4, "c"), (5, "d")]
    assert len(list((tmp_path / "acct" / "data").iterdir())) == 1


def applied(rows, step):
    """What a commit does to plain rows, in Python."""
    kind, batch = step
    if kind == "append":
        return rows + batch
    keys = {k for k, _ in batch}
    if kind == "delete":
        return [r for r in rows if r[0] is None or r[0] not in keys]
    new = dict(batch)
    met = {k for k, _ in rows}
    return [(k, new[k]) if k in new and k is not None else (k, v) for k, v in rows] + [
        (k, v) for k, v in batch if k is None or k not in met
    ]


def test_settled_runs_equal_rewritten_rows(spark, tmp_path, monkeypatch):
    """Random commits, merged or not: every version reads as if each commit had rewritten the table."""
    from rowtide.plans import table as module

    monkeypatch.setattr(module, "FAN", 3)
    monkeypatch.setattr(module, "FOLD_AT", 100)
    rng = random.Random(11)
    for attempt in range(3):
        table = KeyedTable(spark, str(tmp_path / str(attempt)), SPEC, buckets=2)
        want, history = [], {}
        for step in range(9):
            kind = rng.choice(["append", "upsert", "upsert", "delete"]) if step else "append"
            keys = rng.sample(range(6), rng.randint(1, 4)) + ([None] if kind == "upsert" and rng.random() < 0.3 else [])
            batch = [(k, f"{step}") for k in keys] * (2 if kind == "append" and rng.random() < 0.4 else 1)
            getattr(table, kind)(rows(spark, *batch))
            want = applied(want, (kind, batch))
            history[max(n for n in table.versions() if table.version(n).operation != "layout")] = sorted(want, key=repr)
        assert content(table.read()) == sorted(want, key=repr) and table.count() == len(want)
        for number in rng.sample(sorted(history), 3):
            assert content(table.read(number)) == history[number]
        assert any(table.version(n).operation == "layout" for n in table.versions())
        table.ensure_key_layout()
        assert content(table.read()) == sorted(want, key=repr) and not table.version().deltas
        assert table.key_ranges()["id"] == (min((k for k, _ in want if k is not None), default=None), max((k for k, _ in want if k is not None), default=None))


def test_merges_cost_the_logarithm_of_the_table():
    """Bytes written again per changed byte, over 200 and 3200 batches of the smallest size."""
    from rowtide.plans.table import FAN, SMALLEST, Part, Version

    for mode, kind in (("ordered", "ordered"), ("keyed", "run")):
        cost = {}
        version, written = Version(0, 4, mode=mode), 0
        for n in range(1, 3201):
            version.parts[f"p{n}"] = Part(kind, [0, 1], 2, n, 1, SMALLEST)
            while due := version.due():
                merged = [version.parts.pop(d) for d in due]
                size = sum(p.bytes for p in merged)
                version.parts[f"m{n}.{size}"] = Part("rows" if not version.parts else kind, [0, 1], 2, max(p.seq for p in merged), 1, size)
                written += size
            assert len(version.parts) < FAN * 6
            cost[n] = written / (n * SMALLEST)
        assert cost[200] < 6 and cost[3200] < 9


def test_written_bytes_of_many_batches(spark, tmp_path):
    """Small batches against a large table: merges leave the table alone until they weigh as much."""
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=2)
    table.append(spark.range(200_000).selectExpr("cast(id as int) AS id", "cast(uuid() as string) AS v"))
    base = next(iter(table.version().parts))
    largest = 0
    for n in range(20):
        before = _bytes_under(tmp_path)[1]
        table.upsert(rows(spark, *[(i * 7919 + n, f"n{n}") for i in range(8)]))
        largest = max(largest, _bytes_under(tmp_path)[1] - before)
    assert base in table.version().parts and len(table.version().parts) < 12
    assert largest * 20 < table.version().parts[base].bytes
    assert table.count() == 200_000 and table.read().where("v like 'n%'").count() == 160


def test_disjoint_writers_write_once_and_merges_yield(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=4)
    table.append(rows(spark, *[(i, "a") for i in range(40)]))
    rival = KeyedTable(spark, str(tmp_path), SPEC, buckets=4)
    create, raced, written = Storage.create_text, [], []
    write = KeyedTable._write_part
    monkeypatch.setattr(KeyedTable, "_write_part", lambda self, *a, **k: written.append(a[2]) or write(self, *a, **k))

    def late(self, path, text):
        if not raced:
            raced.append(path)
            rival.upsert(rows(spark, (1, "r"), (2, "r")))
        return create(self, path, text)

    monkeypatch.setattr(Storage, "create_text", late)
    table.upsert(rows(spark, (2, "b"), (3, "b")))
    assert written == ["run", "run"]  # one write each; the loser came later and counts
    assert dict(content(table.read())) | {1: "r", 2: "b", 3: "b"} == dict(content(table.read()))

    def merged(self, path, text):  # another writer merges first
        monkeypatch.setattr(Storage, "create_text", create)
        rival.ensure_key_layout()
        return create(self, path, text)

    monkeypatch.setattr(Storage, "create_text", merged)
    number = table.version().number
    table.ensure_key_layout()
    assert table.version().number == number + 1 and table.count() == 40 and table.version().deltas == []


def test_watermark_forgets_deletions_and_rejects_late_events(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=2)
    table.apply_feed(ordered_feed(spark, 0, *[("INSERT", [], image(i, "a")) for i in range(50)]))
    table.apply_feed(ordered_feed(spark, 100, *[("DELETE", image(i, "a"), []) for i in range(40)]))
    table.ensure_key_layout()
    assert table._state(table.version()).count() == 50 and table.count() == 10
    table.advance_watermark(200)
    table.advance_watermark(150)
    assert table.version().watermark == 200
    rejects = table.apply_feed(ordered_feed(spark, 199, ("INSERT", [], image(1, "late")), ("INSERT", [], image(2, "new"))))
    assert [r["reject_reason"] for r in rejects.collect()] == ["late"]
    table.ensure_key_layout()
    assert table._state(table.version()).count() == 11 and (2, "new") in content(table.read())


def test_changes_of_two_kinds_do_not_mix(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "o"), SPEC, buckets=2)
    table.append(rows(spark, (1, "a")))
    table.apply_feed(make_feed(spark, *EVENTS[:1]))
    for change in (table.upsert, table.delete):
        with pytest.raises(ValueError):
            change(rows(spark, (1, "b")))
    table.overwrite(rows(spark, (1, "b")))
    table.upsert(rows(spark, (1, "c")))
    with pytest.raises(ValueError):
        table.apply_feed(make_feed(spark, *EVENTS[:1]))
    assert content(table.read()) == [(1, "c")]


def test_null_keys_never_enter_ordered_state(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=2)
    order = F.struct(F.col("n").alias("total_order"), F.lit(0).cast("long").alias("data_collection_order"), F.lit(0).alias("step"))
    for n, v in enumerate("ab"):
        events = spark.createDataFrame([(None, v, "INSERT", n), (1, v, "INSERT", n)], "id int, v string, _op string, n long")
        table.apply_ordered(events.withColumn("_order", order).drop("n"))
    assert content(table.read()) == [(1, "b")]


def test_lookup_opens_few_files(spark, tmp_path, monkeypatch):
    from rowtide.plans import table as module

    monkeypatch.setattr(module, "FILE_BYTES", 40_000)
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=2)
    table.append(spark.range(30_000).selectExpr("cast(id as int) AS id", "cast(uuid() as string) AS v"))
    table.upsert(rows(spark, (5, "five"), (70_000, "new")))
    table.ensure_key_layout()
    everything = table.read().inputFiles()
    found = table.lookup(spark.createDataFrame([(5,), (70_000,), (99_999,), (None,)], "id int"))
    assert content(found) == [(5, "five"), (70_000, "new")]
    assert len(everything) > 8 and len(found.inputFiles()) <= 4
    table.delete(rows(spark, (5, "")))
    assert content(table.query({"id": 70_000})) == [(70_000, "new")] and table.query({"id": 5}).count() == 0
    assert content(table.query({"v": "new"}, ["id"])) == [(70_000,)]


def test_info_and_ranges_open_no_data_file(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=2)
    table.append(rows(spark, (7, "a"), (-2, "b"), (30, "c")))
    table.upsert(rows(spark, (31, "d")))
    table.ensure_key_layout()
    for file in list((tmp_path / "acct" / "data").rglob("*.parquet")):
        file.write_bytes(b"not read")
    assert table.info()["record_count"] == 4 and table.key_ranges() == {"id": (-2, 31)}


def test_stored_key_and_buckets_hold(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=16)
    table.append(rows(spark, *[(i, "a") for i in range(40)]))
    other = KeyedTable(spark, str(tmp_path), SPEC, buckets=3)
    other.upsert(rows(spark, *[(i, "b") for i in range(41)]))
    assert other.read().count() == 41
    wrong = KeyedTable(spark, str(tmp_path), TableSpec.parse("acct", "v", "id int32, v varchar(8)!"), buckets=16)
    with pytest.raises(ValueError):
        wrong.upsert(rows(spark, (1, "b")))
    found = KeyedTable.open(spark, str(tmp_path), "acct")
    assert found.spec.pk == ("id",) and content(found.lookup(spark.createDataFrame([(40,), (99,)], "id int"))) == [(40, "b")]
    plan = found.lookup(spark.createDataFrame([(40,)], "id int")).inputFiles()
    assert len(plan) < len(found.read().inputFiles())


def test_creation_race_with_other_buckets(spark, tmp_path, monkeypatch):
    first, second = (KeyedTable(spark, str(tmp_path), SPEC, buckets=n) for n in (16, 3))
    create, calls = Storage.create_text, []

    def late(self, path, text):
        if not calls:
            calls.append(path)
            monkeypatch.setattr(Storage, "create_text", create)
            second.append(rows(spark, *[(i, "a") for i in range(20)]))
        return create(self, path, text)

    monkeypatch.setattr(Storage, "create_text", late)
    first.append(rows(spark, *[(i, "a") for i in range(20, 40)]))
    assert first.version().buckets == 3
    first.upsert(rows(spark, *[(i, "b") for i in range(41)]))
    assert first.read().count() == 41


def test_order_text(spark):
    people = spark.createDataFrame([(1, None), (2, 40), (3, 70)], "id int, age int")
    for text, ids in (("age DESC NULLS LAST", [3, 2, 1]), ("coalesce(age, 50) DESC, id", [3, 1, 2]), ("id", [1, 2, 3])):
        assert [r["id"] for r in scan.scan(people, order_by=text).collect()] == ids
    with pytest.raises(Exception):
        scan.scan(people, order_by="age sideways").collect()


def test_audit_reads_only_changed_buckets(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path), SPEC, buckets=4)
    with pytest.raises(ValueError):
        table.audit_keys()
    table.append(rows(spark, *[(i, "a") for i in range(40)], (3, "b"), (3, "c"), (8, "b")))
    assert content(table.audit_keys()) == [(3, 3), (8, 2)]
    opened, live = [], KeyedTable._live
    monkeypatch.setattr(KeyedTable, "_live", lambda self, version, **how: opened.append(how["buckets"]) or live(self, version, **how))
    table.upsert(rows(spark, (50, "x")))
    table.delete(rows(spark, (50, "")))
    table.append(rows(spark, (50, "x"), (50, "y")))
    assert content(table.audit_keys()) == [(3, 3), (50, 2), (8, 2)] and [len(b) for b in opened] == [1]
    assert content(table.audit_keys()) == [(3, 3), (50, 2), (8, 2)] and len(opened) == 1
    table.delete(rows(spark, (3, "")))
    assert content(table.audit_keys()) == [(50, 2), (8, 2)]


def test_batches_of_a_number_of_rows(spark, tmp_path):
    path, check = str(tmp_path / "feed"), str(tmp_path / "check")
    events = [("INSERT", [], image(i, "a")) for i in range(50)] + [("UPDATE", image(i, "a"), image(i, "b")) for i in range(25)]
    feeds.land(make_feed(spark, *events).repartition(3), path)
    table, seen = KeyedTable(spark, str(tmp_path / "db"), SPEC, buckets=2), []
    apply_feed = table.apply_feed
    table.apply_feed = lambda feed, *how: seen.append((feed.count(), how[1][1])) or apply_feed(feed, *how)
    start_apply(feeds.stream_feed(spark, path, positions=True), table, check, batch_rows=16).awaitTermination()
    assert sum(n for n, _ in seen) == 75 and all(n <= 16 for n, _ in seen) and len(seen) <= 9
    assert [b for _, b in seen] == [[0, i] for i in range(len(seen))]
    assert table.count() == 50 and table.read().where("v = 'b'").count() == 25


def test_one_stream_for_two_tables_survives_a_kill_between_them(spark, tmp_path):
    path, check, commits = (str(tmp_path / n) for n in ("feed", "check", "commits"))
    feed = make_feed(spark, *EVENTS).unionByName(make_feed(spark, *EVENTS[:2], name="other")).unionByName(make_feed(spark, *EVENTS[:1], name="unlisted"))
    feeds.land(feed, path)
    tables = {n: KeyedTable(spark, str(tmp_path / n), SPEC, buckets=2) for n in ("acct", "other")}
    second = tables["other"].apply_feed

    def killed(*args):
        raise RuntimeError("killed")

    tables["other"].apply_feed = killed

    def run():
        stream = feeds.stream_feed(spark, path)
        start_apply_tables(stream, "s", tables, check, commits, mode="grouped", parallel=1).awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    assert tables["acct"].version().number == 1 and not tables["other"].exists() and committed(spark, commits) == {}
    tables["other"].apply_feed = second
    run()
    assert committed(spark, commits) == {"acct": 1, "other": 1}
    assert content(tables["acct"].read()) == [(2, "b"), (3, "b")] and content(tables["other"].read()) == [(1, "a"), (2, "b")]
    assert spark.read.parquet(f"{tables['acct'].path}/rejects").count() == 1


def test_key_ranges_of_files_are_found_without_sorting_their_rows(spark, tmp_path, monkeypatch):
    from rowtide.plans import table as module

    monkeypatch.setattr(module, "FILE_BYTES", 20_000)
    table = KeyedTable(spark, str(tmp_path), TableSpec.parse("Two", "a, b", "a int32!, b varchar(8)!, v int32"), buckets=3)
    data = spark.sql("SELECT cast(id % 97 AS int) a, cast(id * 31 % 1000 AS string) b, cast(id AS int) v FROM range(3000)")
    table.append(data)
    table.append(data)
    table.ensure_key_layout()
    (name,) = table.version().parts
    target = f"{table.path}/data/rt_part={name}"
    found = table._ranges(name, target)
    assert "SortAggregate" not in found._jdf.queryExecution().toString()
    files = spark.read.parquet(target).groupBy(F.col("_metadata.file_path").alias("file"), "rt_bucket")
    key = F.struct("a", "b")
    want = files.agg(F.min(key).alias("low"), F.max(key).alias("high")).select(F.lit(name), "rt_bucket", "file", "low", "high")
    assert content(found) == content(want) == content(spark.read.parquet(f"{table.path}/files/{name}")) and found.count() > 3


def test_rows_of_a_part_merged_into_several_files_are_counted_once(spark, tmp_path, monkeypatch):
    from rowtide.plans import table as module

    monkeypatch.setattr(module, "FILE_BYTES", 1 << 10)
    table = KeyedTable(spark, str(tmp_path), TableSpec.parse("t", "k", "k int64!, v int64"), buckets=2)
    for i in range(2):
        table.upsert(spark.range(i * 500, 500 + i * 500).select(F.col("id").alias("k"), F.col("id").alias("v")))
    assert table.ensure_key_layout() == 2 and not table.version().deltas
    [part] = table.version().parts
    assert spark.read.parquet(f"{table.path}/files/{part}").count() > 2
    assert table.count() == table.read().count() == 1000


def test_a_table_without_events_in_a_batch_keeps_its_version(spark, tmp_path):
    path, check, commits = (str(tmp_path / n) for n in ("feed", "check", "commits"))
    tables = {n: KeyedTable(spark, str(tmp_path / n), SPEC, buckets=2) for n in ("acct", "other name")}
    for name, events in (("acct", EVENTS[:2]), ("other name", EVENTS[:1]), ("other name", EVENTS[1:2])):
        feeds.land(make_feed(spark, *events, name=name), path)
        stream = feeds.stream_feed(spark, path)
        start_apply_tables(stream, "s", tables, check, commits).awaitTermination()
    assert committed(spark, commits) == {"acct": 1, "other name": 3}
    assert [tables[n].count() for n in tables] == [2, 2]


def test_rejects_are_read_again_only_if_there_are_some(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SPEC, buckets=2)
    feeds.land(make_feed(spark, *EVENTS[:2]), str(tmp_path / "feed"))
    none = table.apply_feed(feeds.read_feed(spark, str(tmp_path / "feed")))
    assert none.count() == 0 and "parquet" not in none._jdf.queryExecution().executedPlan().toString().lower()
    late = table.apply_feed(make_feed(spark, *EVENTS[:2]).withColumn("txn", F.lit(None).cast(feeds.read_feed(spark, str(tmp_path / "feed")).schema["txn"].dataType)))
    assert late.count() == 2 and "reject_reason" in none.columns
