"""The registered queries: each operator over the given tables, with its SQL check.

Change feeds are derived from the tables inside Spark: rows are encoded to wire
bytes, so every query runs the real extract, decode and apply path.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.catalog.spec import FieldSpec, TableSpec
from rowtide.functions import payload, text, wire
from rowtide.functions.encode import encode, integer_bytes
from rowtide.operators import apply, audit, extract, mutate, scan
from rowtide.operators.decode import decode_feed, decode_images, decode_latest
from rowtide.plans import jobs
from rowtide.plans.importer import Importer
from rowtide.plans.table import KeyedTable
from rowtide.sources import feed as feeds
from rowtide.sources import files
from rowtide.sources.storage import Storage, scratch_dir
from rowtide.streaming.apply import committed, start_apply, start_apply_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# --- tables and feeds -------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame) -> DataFrame:
    """Use all cores for encoding: a small file of one row group is otherwise one task.

    Input with as many partitions as there are cores is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _wall_clock(spec: TableSpec) -> TableSpec:
    """The given tables carry timestamps without zone."""
    fields = tuple(replace(f, timezone="-") if f.kind == "timestamp" else f for f in spec.fields)
    return replace(spec, fields=fields)


EVENTS = _wall_clock(
    TableSpec.parse(
        "events", "user_id", "user_id int64!, event_id int64!, ts timestamp(6), value float64"
    )
)
ORDERS = _wall_clock(
    TableSpec.parse(
        "orders",
        "o_orderkey",
        "o_orderkey int64!, o_custkey int64!, o_orderstatus char(1), o_totalprice float64!, "
        "o_orderdate timestamp(6), o_orderpriority varchar(15)",
    )
)
LINEITEM = _wall_clock(
    TableSpec.parse(
        "lineitem",
        "l_orderkey, l_linenumber",
        "l_orderkey int64!, l_partkey int64!, l_suppkey int64!, l_linenumber int32!, "
        "l_quantity float64, l_extendedprice float64, l_discount float64, l_tax float64, "
        "l_returnflag char(1), l_linestatus char(1), l_shipdate timestamp(6)",
    )
)
CUSTOMER = TableSpec.parse(
    "customer",
    "c_custkey",
    "c_custkey int64!, c_name varchar(25), c_nationkey int32, c_acctbal float64, "
    "c_mktsegment varchar(10)",
)
ACCOUNT = TableSpec.parse("account", "id", "id int64!, v float64")

# The operation an event type stands for.
_OPS = {
    "signup": "INSERT",
    "view": "UPDATE",
    "click": "UPDATE",
    "purchase": "SNAPSHOT",
    "error": "DELETE",
}
_OP_SQL = (
    "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'SNAPSHOT' "
    "WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END"
)


def _op() -> Column:
    out = F.lit("UPDATE")
    for kind in ("signup", "purchase", "error"):
        out = F.when(F.col("event_type") == kind, _OPS[kind]).otherwise(out)
    return out


def _events_feed(
    spark: SparkSession, sf_dir: str, op: Column | None = None, order: Column | None = None
) -> DataFrame:
    """One change event per row of ``events``, keyed by user; before images differ in value."""
    image = feeds.row_image(EVENTS)
    return feeds.build_feed(
        _spread(_table(spark, sf_dir, "events")),
        op=_op() if op is None else op,
        before=feeds.row_image(EVENTS, {"value": -F.col("value")}),
        after=image,
        order=F.col("event_id") if order is None else order,
        schema="shop",
        table="events",
        bucket=F.col("user_id") % 4,
    )


def _orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = feeds.row_image(ORDERS)
    return feeds.build_feed(
        _spread(_table(spark, sf_dir, "orders")),
        op=F.lit("SNAPSHOT"),
        before=image,
        after=image,
        order=F.col("o_orderkey"),
        schema="shop",
        table="orders",
        bucket=F.col("o_custkey") % 4,
    )


def _landed(spark: SparkSession, *parts: DataFrame) -> DataFrame:
    path = scratch_dir(spark, "feed")
    for part in parts:
        feeds.land(part, path)
    return feeds.read_feed(spark, path)


def _account_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded events as changes of ``account``."""
    events, _ = decode_feed(_events_feed(spark, sf_dir), EVENTS, split_key_changes=True)
    return events.select("_op", "_order", F.col("user_id").alias("id"), F.col("value").alias("v"))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v")
    )


# --- feed sources -----------------------------------------------------------

_FEED_SQL = f"""
    SELECT event_id AS total_order, {_OP_SQL} AS op, CAST(user_id % 4 AS INTEGER) AS bucket,
           CAST(CASE WHEN event_type IN ('view', 'click', 'error') THEN 4 ELSE 0 END AS INTEGER)
               AS n_before,
           CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 4 END AS INTEGER) AS n_after
    FROM events"""


def _feed_columns(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("txn.total_order").alias("total_order"),
        "op",
        "bucket",
        F.size("before").alias("n_before"),
        F.size("after").alias("n_after"),
    )


@query(_FEED_SQL)
def feed_scan(spark, sf_dir):
    feed = _landed(spark, _events_feed(spark, sf_dir), _orders_feed(spark, sf_dir))
    return _feed_columns(feeds.poll(feed, "shop", "events"))


@query(_FEED_SQL + " WHERE user_id % 4 IN (1, 3)")
def feed_bucket_filter(spark, sf_dir):
    return _feed_columns(feeds.pick_buckets(_landed(spark, _events_feed(spark, sf_dir)), [1, 3]))


@query(
    """SELECT o_orderkey AS total_order, 'orders' AS routed_table,
              CAST(o_custkey % 4 AS INTEGER) AS bucket
       FROM orders"""
)
def feed_route(spark, sf_dir):
    feed = _landed(spark, _events_feed(spark, sf_dir), _orders_feed(spark, sf_dir))
    return feeds.route(feed, "shop", "orders").select(
        F.col("txn.total_order").alias("total_order"),
        F.col("source.table").alias("routed_table"),
        "bucket",
    )


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN props END AS decoded,
              CASE WHEN event_type = 'error' THEN props END AS unchanged,
              FALSE AS broken
       FROM events"""
)
def hex_payload(spark, sf_dir):
    sent = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.concat(F.lit("0x"), F.hex(F.col("props")))
    )
    rows = _table(spark, sf_dir, "events").select("event_id", sent.alias("result"))
    return payload.decode_payloads(rows, "result").select(
        "event_id",
        F.col("result_bytes").cast("string").alias("decoded"),
        F.col("result_text").alias("unchanged"),
        F.col("result_broken").alias("broken"),
    )


# --- extraction and record assembly -----------------------------------------


@query(
    f"""SELECT event_id AS total_order, {_OP_SQL} AS op,
               CAST(CASE WHEN event_type IN ('view', 'click') THEN 8 ELSE 4 END AS INTEGER)
                   AS n_cols,
               lpad(lower(to_hex(user_id)), 16, '0') AS key_hex
        FROM events"""
)
def extract_images(spark, sf_dir):
    return extract.extract_images(_events_feed(spark, sf_dir)).select(
        F.col("txn.total_order").alias("total_order"),
        F.col("_op").alias("op"),
        F.size("_cols").alias("n_cols"),
        F.lower(F.hex(F.get("_cols", F.lit(0)))).alias("key_hex"),
    )


def _with_gaps(feed: DataFrame) -> DataFrame:
    """Unknown operations for snapshots; images missing for odd order numbers."""
    odd = F.col("txn.total_order") % 2 == 1
    nothing = F.array().cast("array<binary>")
    return feed.select(
        F.when(F.col("op") == "SNAPSHOT", "MERGE").otherwise(F.col("op")).alias("op"),
        F.when(odd & (F.col("op") == "DELETE"), nothing).otherwise(F.col("before")).alias("before"),
        F.when(odd & (F.col("op") != "DELETE"), nothing).otherwise(F.col("after")).alias("after"),
        "source",
        "txn",
    )


@query(
    """SELECT reason, count(*) AS events FROM (
           SELECT CASE WHEN event_type = 'purchase' THEN 'unknown_op'
                       WHEN event_id % 2 = 1 AND event_type = 'error' THEN 'empty_before'
                       WHEN event_id % 2 = 1 THEN 'empty_after' END AS reason
           FROM events) WHERE reason IS NOT NULL GROUP BY reason"""
)
def extract_dropped(spark, sf_dir):
    dropped = extract.dropped_events(_with_gaps(_events_feed(spark, sf_dir)))
    return dropped.groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


@query(
    """SELECT CASE WHEN event_type IN ('signup', 'purchase') THEN 'append'
                   WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op_group,
              count(*) AS events
       FROM events GROUP BY 1"""
)
def op_split_counts(spark, sf_dir):
    images = extract.extract_images(_events_feed(spark, sf_dir))
    return images.groupBy(extract.op_group(F.col("_op")).alias("op_group")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query("SELECT event_id, user_id, value FROM events WHERE event_type IN ('view', 'click')")
def update_after_image(spark, sf_dir):
    images = extract.extract_images(_events_feed(spark, sf_dir)).where("_op = 'UPDATE'")
    picked = extract.after_image(F.col("_cols"), F.col("_op"), len(EVENTS.fields))
    decoded = decode_images(images.select(picked.alias("_image")), EVENTS)
    return decoded.select("event_id", "user_id", "value")


@query(
    """SELECT event_id,
              CASE event_type WHEN 'view' THEN 'UPDATE' WHEN 'error' THEN 'DELETE'
                   ELSE 'INSERT' END AS parsed_op,
              CASE event_type WHEN 'view' THEN 'UPDATE' WHEN 'error' THEN 'DELETE'
                   WHEN 'signup' THEN 'INSERT' WHEN 'purchase' THEN 'INSERT' END AS feed_op
       FROM events"""
)
def op_normalize(spark, sf_dir):
    # mixed case, wire number, unset, unknown
    spelled = (
        F.when(F.col("event_type") == "view", "Update")
        .when(F.col("event_type") == "error", "2")
        .when(F.col("event_type") == "signup", "insert")
        .when(F.col("event_type") == "click", "truncate")
    )
    return _table(spark, sf_dir, "events").select(
        "event_id",
        feeds.operation(spelled, unknown="INSERT").alias("parsed_op"),
        feeds.operation(spelled).alias("feed_op"),
    )


@query(
    f"""SELECT event_id, {_OP_SQL} AS op,
               CAST(CASE WHEN event_type IN ('view', 'click') THEN 8 ELSE 4 END AS INTEGER)
                   AS expected,
               CAST(CASE event_type WHEN 'view' THEN 8 WHEN 'click' THEN 7 WHEN 'signup' THEN 3
                    WHEN 'purchase' THEN 4 ELSE 5 END AS INTEGER) AS received,
               event_type IN ('view', 'purchase') AS agrees,
               CASE event_type WHEN 'error' THEN -value WHEN 'view' THEN value
                    WHEN 'purchase' THEN value END AS value
        FROM events"""
)
def arity_check(spark, sf_dir):
    # clicks and signups lose their last column, errors get one too many
    rows = _table(spark, sf_dir, "events")
    kind = F.col("event_type")
    image = feeds.row_image(EVENTS)
    after = F.when(kind.isin("click", "signup"), F.slice(image, 1, 3)).otherwise(image)
    before = feeds.row_image(EVENTS, {"value": -F.col("value")})
    before = F.when(kind == "error", F.concat(before, F.array(F.lit(b"x")))).otherwise(before)
    feed = feeds.build_feed(
        rows,
        op=_op(),
        before=before,
        after=after,
        order=F.col("event_id"),
        schema="shop",
        table="events",
        bucket=F.col("user_id") % 4,
    )
    width = len(EVENTS.fields)
    images = extract.extract_images(feed)
    seen = extract.arity(F.col("_cols"), F.col("_op"), width)
    picked = extract.after_image(F.col("_cols"), F.col("_op"), width)
    decoded = decode_images(
        images.select(
            F.col("txn.total_order").alias("order"),
            F.col("_op").alias("op"),
            seen.alias("seen"),
            picked.alias("_image"),
        ),
        EVENTS,
    )
    return decoded.select(
        F.col("order").alias("event_id"), "op", "seen.expected", "seen.received", "seen.agrees", "value"
    )


@query(
    """SELECT reject_field, reject_reason, count(*) AS events FROM (
           SELECT CASE event_type WHEN 'signup' THEN 'user_id' WHEN 'error' THEN 'user_id'
                       WHEN 'purchase' THEN 'event_id' END AS reject_field,
                  CASE event_type WHEN 'signup' THEN 'empty' WHEN 'error' THEN 'malformed'
                       WHEN 'purchase' THEN 'missing' END AS reject_reason
           FROM events) WHERE reject_field IS NOT NULL GROUP BY ALL"""
)
def decode_rejects(spark, sf_dir):
    # an empty key, a key cut to three bytes, an image cut after the key
    feed = _events_feed(spark, sf_dir)
    tail = F.slice("after", 2, 3)
    broken = feed.select(
        "op",
        F.when(
            F.col("op") == "DELETE",
            F.concat(
                F.array(F.substring(F.get("before", F.lit(0)), 1, 3)), F.slice("before", 2, 3)
            ),
        )
        .otherwise(F.col("before"))
        .alias("before"),
        F.when(F.col("op") == "INSERT", F.concat(F.array(F.lit(b"")), tail))
        .when(F.col("op") == "SNAPSHOT", F.slice("after", 1, 1))
        .otherwise(F.col("after"))
        .alias("after"),
        "source",
        "txn",
    )
    _, rejects = decode_feed(broken, EVENTS)
    return rejects.groupBy("reject_field", "reject_reason").agg(F.count(F.lit(1)).alias("events"))


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
    "FROM orders"
)
def decode_roundtrip_orders(spark, sf_dir):
    rows, _ = decode_feed(_orders_feed(spark, sf_dir), ORDERS)
    return rows.drop("_op", "_order")


# --- column decoders --------------------------------------------------------


def _decoded(rows: DataFrame, keep: list[str], cells: dict[str, tuple[FieldSpec, Column]]) -> DataFrame:
    """Decode the given byte columns next to the kept ones."""
    spec = TableSpec("cells", tuple(replace(f, name=n) for n, (f, _) in cells.items()))
    images = _spread(rows).select(*keep, F.array(*[data for _, data in cells.values()]).alias("_image"))
    return decode_images(images, spec)


def _field(type_: str, **how) -> FieldSpec:
    return FieldSpec("x", type_, **how)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              l_linenumber - 4 AS i8, CAST(300 - l_suppkey AS INTEGER) AS i16,
              CAST(-7 * l_partkey AS INTEGER) AS i32, -1 - l_orderkey AS i64,
              CAST(250 - l_linenumber AS INTEGER) AS u8, CAST(65000 - l_suppkey % 1000 AS INTEGER) AS u16,
              4294967295 - l_partkey AS u32,
              CAST(CAST(18446744073709551615 AS HUGEINT) - l_orderkey AS VARCHAR) AS u64
       FROM lineitem"""
)
def decode_ints(spark, sf_dir):
    # suppliers' numbers grow with the table: what does not fit into one int16 cell goes on in a second one
    c, half = F.col, 1 << 15
    short = 300 - c("l_suppkey")
    number = {
        "i8": ("int8", c("l_linenumber") - 4, 1),
        "i16": ("int16", short % half, 2),
        "i16_high": ("int16", (short - short % half) / half, 2),
        "i32": ("int32", -7 * c("l_partkey"), 4),
        "i64": ("int64", -1 - c("l_orderkey"), 8),
        "u8": ("uint8", 250 - c("l_linenumber"), 1),
        "u16": ("uint16", 65000 - c("l_suppkey") % 1000, 2),
        "u32": ("uint32", F.lit(4294967295) - c("l_partkey"), 4),
        "u64": ("uint64", -1 - c("l_orderkey"), 8),  # its upper half as a negative number
    }
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    cells = {n: (_field(t), integer_bytes(x, w, signed=not t.startswith("u"))) for n, (t, x, w) in number.items()}
    out = _decoded(_table(spark, sf_dir, "lineitem"), keep, cells)
    return out.select(
        *keep,
        c("i8").cast("int").alias("i8"),
        (c("i16_high").cast("int") * half + c("i16")).alias("i16"),
        c("i32").cast("int").alias("i32"),
        "i64",
        *[c(n).cast("int").alias(n) for n in ("u8", "u16")],
        "u32",
        c("u64").cast("string").alias("u64"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS f64,
              -l_quantity / 1e300 AS tiny, CAST(CAST(-l_discount AS FLOAT) AS DOUBLE) AS f32
       FROM lineitem"""
)
def decode_floats(spark, sf_dir):
    double, single = _field("float64"), _field("float32")
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = _decoded(
        _table(spark, sf_dir, "lineitem"),
        keep,
        {
            "f64": (double, encode(double, F.col("l_extendedprice"))),
            "tiny": (double, encode(double, -F.col("l_quantity") / 1e300)),
            "f32": (single, encode(single, -F.col("l_discount"))),
        },
    )
    return out.select(*keep, "f64", "tiny", F.col("f32").cast("double").alias("f32"))


@query(
    """SELECT doc_id, text AS whole,
              left(text, (SELECT max(i) FROM range(0, 21) t(i) WHERE strlen(left(text, i)) <= 20))
                  AS cut,
              text AS terminated, text AS repaired,
              'é' || source AS latin, 'é' || source AS western
       FROM documents"""
)
def decode_strings(spark, sf_dir):
    data = F.col("text").cast("binary")
    bad = F.concat(F.lit(b"\xff"), data, F.lit(b"\xc3"))  # two stray bytes around the text
    sized = F.concat(data, F.lit(b"\0tail"))
    single = F.encode(F.concat(F.lit("é"), F.col("source")), "ISO-8859-1")
    return _decoded(
        _table(spark, sf_dir, "documents"),
        ["doc_id"],
        {
            "whole": (_field("string"), data),
            "cut": (_field("char", size=20), data),
            "terminated": (_field("varchar"), sized),
            "repaired": (_field("varchar"), bad),
            "latin": (_field("varchar", charset="latin-1"), single),
            # a charset Spark does not know: through Arrow
            "western": (_field("varchar", charset="cp1252"), single),
        },
    )


@query(
    """SELECT page_id, lower(hex(encode(url))) AS whole, lower(hex(encode(left(url, 16)))) AS cut
       FROM pages"""
)
def decode_hex(spark, sf_dir):
    data = F.col("url").cast("binary")
    return _decoded(
        _table(spark, sf_dir, "pages"),
        ["page_id"],
        {"whole": (_field("bytes"), data), "cut": (_field("varbinary", size=16), data)},
    )


@query(
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
              CAST(CAST(o_orderdate AS DATE) - 20000 AS VARCHAR) AS early,
              CAST(NULL AS VARCHAR) AS beyond
       FROM orders"""
)
def decode_dates(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    kind = _field("date")
    out = _decoded(
        _table(spark, sf_dir, "orders"),
        ["o_orderkey"],
        {
            "day": (kind, encode(kind, day)),
            "early": (kind, encode(kind, F.date_sub(day, 20000))),
            "beyond": (kind, integer_bytes(F.lit(2932897), 4)),
        },
    )
    return out.select(
        "o_orderkey", *[F.col(n).cast("string").alias(n) for n in ("day", "early", "beyond")]
    )


@query(
    """SELECT event_id, (epoch_us(ts) // 1000 % 86400000) * 1000 AS time_of_day, CAST(NULL AS BIGINT) AS beyond
       FROM events"""
)
def decode_times(spark, sf_dir):
    millis = F.floor(wire.micros_from_ntz(F.col("ts")) / 1000).cast("bigint")
    kind = _field("time")
    return _decoded(
        _table(spark, sf_dir, "events"),
        ["event_id"],
        {
            "time_of_day": (kind, integer_bytes(millis % 86_400_000, 4)),
            "beyond": (kind, integer_bytes(F.lit(86_400_000), 4)),
        },
    )


@query(
    """SELECT event_id, ts AS us, date_trunc('millisecond', ts) AS ms,
              date_trunc('second', ts) AS s, epoch_us(ts) AS utc_us,
              epoch_us(ts) - epoch_us(ts) % 1000 AS utc_default,
              ts - INTERVAL 60 YEAR AS old
       FROM events"""
)
def decode_timestamps(spark, sf_dir):
    micros = wire.micros_from_ntz(F.col("ts"))
    data = integer_bytes(micros, 8)
    old = wire.micros_from_ntz(F.col("ts") - F.expr("INTERVAL 60 YEAR"))
    out = _decoded(
        _table(spark, sf_dir, "events"),
        ["event_id"],
        {
            "us": (_field("timestamp", precision=6, timezone="-"), data),
            "ms": (_field("timestamp", precision=3, timezone="-"), data),
            "s": (_field("timestamp", precision=0, timezone="-"), data),
            "utc_us": (_field("timestamp_with_tz", precision=9), data),
            "utc_default": (_field("timestamp", timezone="America/New_York"), data),
            "old": (_field("timestamp", precision=6, timezone="-"), integer_bytes(old, 8)),
        },
    )
    return out.select(
        "event_id",
        "us",
        "ms",
        "s",
        F.unix_micros("utc_us").alias("utc_us"),
        F.unix_micros("utc_default").alias("utc_default"),
        "old",
    )


@query(
    """SELECT o_orderkey,
              CAST(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(38, 10)) AS VARCHAR)
                  AS from_text,
              65 - (cents + 1) * 256 AS hundredths,
              CAST(CAST(65 - (o_orderkey + 1) * 256 AS DECIMAL(38, 10)) AS VARCHAR) AS wide,
              CAST(NULL AS VARCHAR) AS refused
       FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) * 100 AS BIGINT) AS cents
             FROM orders)"""
)
def decode_decimals(spark, sf_dir):
    # the last byte is a letter, so the raw bytes can never read as decimal text
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    raw = 65 - (cents + 1) * 256
    wide = F.concat(F.lit(b"\xff\xff\xff\xff"), integer_bytes(65 - (F.col("o_orderkey") + 1) * 256, 8))
    out = _decoded(
        _table(spark, sf_dir, "orders"),
        ["o_orderkey"],
        {
            "from_text": (
                _field("decimal", precision=12, scale=2),
                F.col("o_totalprice").cast("decimal(12,2)").cast("string").cast("binary"),
            ),
            "hundredths": (_field("decimal", precision=18, scale=2), integer_bytes(raw, 8)),
            "wide": (_field("decimal", size=12), wide),
            "refused": (
                _field("decimal"),
                F.get(F.array(*[F.lit(t) for t in (b"NaN", b"1_0e2", b"-12e_1_", b"_-2")]), (F.col("o_orderkey") % 4).cast("int")),
            ),
        },
    )
    return out.select(
        "o_orderkey",
        (F.col("hundredths") * 100).cast("bigint").alias("hundredths"),
        *[F.col(n).cast("string").alias(n) for n in ("from_text", "wide", "refused")],
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'N' THEN FALSE END AS flag,
              l_linenumber <> 4 AS centred
       FROM lineitem"""
)
def decode_booleans(spark, sf_dir):
    flag = F.col("l_returnflag")
    data = F.when(flag == "A", F.lit(b"\x7f")).when(flag == "N", F.lit(b"\0")).otherwise(F.lit(b""))
    kind = _field("boolean")
    return _decoded(
        _table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        {
            "flag": (kind, data),
            "centred": (kind, integer_bytes(F.col("l_linenumber") - 4, 1)),
        },
    )


# --- delimited files --------------------------------------------------------


def _write_lines(
    spark: SparkSession, folder: str, line: Column, rows: DataFrame, extension: str, spread: bool = True
) -> None:
    """Write one raw text line per row under the given file extension."""
    (
        (_spread(rows) if spread else rows)
        .select(line.alias("line"))
        .write.option("sep", "\x01")
        .option("quote", "")
        .option("extension", extension)
        .csv(folder)
    )


def _plain_cells(spec: TableSpec, rows: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.columns]


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
              o_orderpriority || '|"' || o_orderstatus || '"' AS o_orderpriority
       FROM orders WHERE o_orderstatus <> 'P'"""
)
def load_tbl(spark, sf_dir):
    """Trailing delimiter, quoted delimiter, quote and line break; short rows are skipped."""
    orders = _table(spark, sf_dir, "orders")
    *head, last = _plain_cells(ORDERS, orders)
    tricky = F.concat(
        F.lit('"'), last, F.lit('|""'), F.col("o_orderstatus"), F.lit('"""')
    )
    short = F.concat_ws("|", *head[:3])
    full = F.concat(F.concat_ws("|", *head, tricky), F.lit("|"))
    root = scratch_dir(spark, "tbl")
    line = F.when(F.col("o_orderstatus") == "P", short).otherwise(full)
    _write_lines(spark, f"{root}/orders", line, orders, "tbl")
    return files.load_table(spark, root, "ORDERS", ORDERS)


_LINEITEM_SQL = "SELECT " + ", ".join(LINEITEM.columns) + " FROM lineitem"


@query(_LINEITEM_SQL)
def load_csv(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    root = scratch_dir(spark, "csv")
    _write_lines(spark, root, F.concat_ws(",", *_plain_cells(LINEITEM, lineitem)), lineitem, "csv")
    found = [(e.path, e.length) for e in Storage(spark).list(root) if e.name.endswith(".csv")]
    return files.typed(files.read_delimited(spark, found, len(LINEITEM.fields), ","), LINEITEM)


def _csv_source(spark: SparkSession, sf_dir: str, specs: dict[str, TableSpec]) -> str:
    """A directory of partitioned CSV tables."""
    root = scratch_dir(spark, "source")
    for name, spec in specs.items():
        rows = _table(spark, sf_dir, name)
        _write_lines(spark, f"{root}/{name}", F.concat_ws(",", *_plain_cells(spec, rows)), rows, "csv")
    return root


@query("SELECT " + ", ".join(CUSTOMER.columns) + " FROM customer")
def load_csv_parts(spark, sf_dir):
    root = _csv_source(spark, sf_dir, {"customer": CUSTOMER})
    return files.load_table(spark, root, "customer", CUSTOMER)


@query(
    """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE props END AS props
       FROM events"""
)
def text_blank_null(spark, sf_dir):
    raw = (
        F.when(F.col("event_type") == "view", F.lit(" \t "))
        .when(F.col("event_type") == "click", F.lit(""))
        .otherwise(F.concat(F.lit("  "), F.col("props"), F.lit("\t")))
    )
    return _table(spark, sf_dir, "events").select("event_id", text.cell(raw).alias("props"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              -l_partkey AS whole, CAST(NULL AS INTEGER) AS fraction,
              CAST(NULL AS VARCHAR) AS big_fraction, CAST(l_partkey AS VARCHAR) AS big,
              l_extendedprice AS amount,
              CASE l_returnflag WHEN 'A' THEN CAST('inf' AS DOUBLE) WHEN 'R' THEN NULL
                   ELSE l_tax END AS special
       FROM lineitem"""
)
def text_cast_numeric(spark, sf_dir):
    flag = F.col("l_returnflag")
    special = (
        F.when(flag == "A", F.lit("inf")).when(flag == "R", F.lit("1.0d")).otherwise(F.col("l_tax").cast("string"))
    )
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        text.value(_field("int64"), text.trimmed(F.concat(F.lit(" -"), F.col("l_partkey")))).alias("whole"),
        text.value(_field("int32"), F.col("l_quantity").cast("string")).alias("fraction"),
        text.value(_field("uint64"), F.when(flag == "A", F.lit("1e3")).otherwise(F.col("l_quantity").cast("string")))
        .cast("string")
        .alias("big_fraction"),
        text.value(_field("uint64"), F.col("l_partkey").cast("string")).cast("string").alias("big"),
        text.value(_field("float64"), F.col("l_extendedprice").cast("string")).alias("amount"),
        text.value(_field("float64"), special).alias("special"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_returnflag = 'N' THEN l_linenumber <> 3 END AS flag
       FROM lineitem"""
)
def text_cast_bool(spark, sf_dir):
    odd = F.array(*[F.lit(t) for t in ("1.5", "0.4", "1e2", "true")])
    raw = F.when(F.col("l_returnflag") != "N", F.get(odd, F.col("l_linenumber") % 4)).otherwise(
        (F.col("l_linenumber") - 3).cast("string")
    )
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        text.value(_field("boolean"), raw).alias("flag"),
    )


def _moment_text() -> Column:
    """Three accepted spellings, and two that are not."""
    day, kind = F.col("ts"), F.col("event_type")
    return (
        F.when(kind == "signup", F.date_format(day, "yyyy-M-d"))
        .when(kind == "view", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "click", F.date_format(day, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "purchase", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(day, "yyyy"))
    )


@query(
    """SELECT event_id, CASE WHEN event_type IN ('signup', 'view', 'click')
                  THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day
       FROM events"""
)
def text_cast_date(spark, sf_dir):
    return _table(spark, sf_dir, "events").select(
        "event_id", text.value(_field("date"), _moment_text()).cast("string").alias("day")
    )


@query(
    """SELECT event_id, CASE event_type WHEN 'signup' THEN date_trunc('day', ts)
                             WHEN 'view' THEN date_trunc('second', ts)
                             WHEN 'click' THEN ts END AS moment
       FROM events"""
)
def text_cast_ts(spark, sf_dir):
    kind = _field("timestamp", precision=6, timezone="-")
    return _table(spark, sf_dir, "events").select(
        "event_id", text.value(kind, _moment_text()).alias("moment")
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE CAST(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(38, 10)) AS VARCHAR)
              END AS price
       FROM orders"""
)
def text_cast_decimal(spark, sf_dir):
    raw = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    raw = F.when(F.col("o_orderstatus") == "P", F.concat(raw, F.lit("x"))).otherwise(raw)
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", text.value(_field("decimal"), raw).cast("string").alias("price")
    )


@query(
    """SELECT 'customer' AS "table", count(*) AS records FROM customer
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'orders', count(*) FROM orders"""
)
def import_summary(spark, sf_dir):
    specs = {"customer": CUSTOMER, "lineitem": LINEITEM, "orders": ORDERS}
    source = _csv_source(spark, sf_dir, specs)
    importer = Importer(spark, source, specs, scratch_dir(spark, "tables"), buckets=4)
    return importer.summary(importer.import_all())


@query(
    f"""SELECT {", ".join(CUSTOMER.columns)}, (SELECT count(*) FROM customer) AS imported,
               (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0) AS rejected
        FROM customer"""
)
def import_upsert(spark, sf_dir):
    """Each key twice in its file, the last line not the greater one, and lines without a readable key."""
    root, tables = scratch_dir(spark, "source"), scratch_dir(spark, "tables")
    rows = _table(spark, sf_dir, "customer")
    line = F.concat_ws(",", *_plain_cells(CUSTOMER, rows))
    older = F.concat_ws(",", F.col("c_custkey"), F.lit("~ name"), F.lit(99), F.lit("1e300"), F.lit("~"))
    refused = F.when(F.col("c_custkey") % 10 == 0, F.lit("x,name,1,1.0,y"))
    rows = rows.select(F.explode(F.array_compact(F.array(older, refused, line))).alias("line"))
    _write_lines(spark, f"{root}/customer", F.col("line"), rows, "csv", spread=False)
    importer = Importer(spark, root, {"customer": CUSTOMER}, tables, buckets=4)
    imported = importer.import_table("customer", "upsert")
    table = importer.table("customer")
    rejected = spark.read.parquet(f"{table.path}/rejects").count()
    counts = {"imported": imported, "rejected": rejected}
    return table.read().withColumns({k: F.lit(n).cast("long") for k, n in counts.items()})


# --- mutations --------------------------------------------------------------

_ADDED_SQL = "SELECT user_id AS id, value AS v FROM events WHERE event_type IN ('signup', 'purchase')"


@query(f"SELECT c_custkey AS id, c_acctbal AS v FROM customer UNION ALL {_ADDED_SQL}")
def cdc_append(spark, sf_dir):
    added = _account_events(spark, sf_dir).where("_op in ('INSERT', 'SNAPSHOT')")
    return mutate.append(_accounts(spark, sf_dir), added.drop("_op", "_order"))


@query("SELECT " + ", ".join(ORDERS.columns) + " FROM orders WHERE o_orderstatus = 'F'")
def table_overwrite(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ORDERS, buckets=4)
    table.append(orders)
    table.overwrite(orders.where("o_orderstatus = 'F'"))
    return table.read()


_LAST_UPDATE_SQL = """
    SELECT user_id AS id, value AS v FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
        FROM events WHERE event_type IN ('view', 'click')) WHERE rn = 1"""


@query(
    f"""WITH s AS ({_LAST_UPDATE_SQL})
        SELECT t.c_custkey AS id, CASE WHEN s.id IS NULL THEN t.c_acctbal ELSE s.v END AS v
        FROM customer t LEFT JOIN s ON t.c_custkey = s.id
        UNION ALL
        SELECT id, v FROM s WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = s.id)"""
)
def cdc_upsert(spark, sf_dir):
    updates = _account_events(spark, sf_dir).where("_op = 'UPDATE'")
    return mutate.upsert(_accounts(spark, sf_dir), updates, "id", ["_order"])


@query(_LAST_UPDATE_SQL)
def dedupe_last_wins(spark, sf_dir):
    updates = _account_events(spark, sf_dir).where("_op = 'UPDATE'")
    return mutate.last_wins(updates, "id", ["_order"]).select("id", "v")


@query(
    """SELECT count(*) AS source_records, count(DISTINCT user_id) AS deduped_records,
              count(*) - count(DISTINCT user_id) AS dropped_duplicates
       FROM events WHERE event_type IN ('view', 'click')"""
)
def dedupe_report(spark, sf_dir):
    updates = _account_events(spark, sf_dir).where("_op = 'UPDATE'")
    return mutate.duplicate_report(updates, "id")


@query(
    """SELECT c_custkey AS id, c_acctbal AS v FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND user_id = c_custkey)"""
)
def cdc_delete(spark, sf_dir):
    deletes = _account_events(spark, sf_dir).where("_op = 'DELETE'")
    return mutate.delete(_accounts(spark, sf_dir), deletes, "id")


@query(
    """SELECT * FROM lineitem t WHERE NOT EXISTS (
           SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
           AND r.l_orderkey = t.l_orderkey AND r.l_linenumber = t.l_linenumber)"""
)
def cdc_delete_composite(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    returned = lineitem.where("l_returnflag = 'R'")
    return mutate.delete(lineitem, returned, ["l_orderkey", "l_linenumber"])


@query(
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
       UNION ALL
       SELECT user_id, NULL, NULL, value, NULL FROM events WHERE event_type = 'signup'"""
)
def write_schema_enforce(spark, sf_dir):
    """Narrow and extra columns in the source: types follow the table, missing cells are NULL."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), CUSTOMER, buckets=4)
    table.append(_table(spark, sf_dir, "customer"))
    signups = _table(spark, sf_dir, "events").where("event_type = 'signup'")
    table.append(
        signups.select(
            "event_type",
            F.lit(None).alias("c_nationkey"),
            F.col("value").alias("c_acctbal"),
            F.col("user_id").cast("int").alias("c_custkey"),
        )
    )
    return table.read()


# --- CDC apply --------------------------------------------------------------

_ORDERED_SQL = """
    SELECT user_id, event_id, ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'"""


@query(_ORDERED_SQL)
def cdc_apply_ordered(spark, sf_dir):
    latest, _ = decode_latest(_events_feed(spark, sf_dir), EVENTS)
    return apply.live(apply.as_changes(latest))


@query(
    f"""WITH grown AS (SELECT c_custkey AS id, c_acctbal AS v FROM customer UNION ALL {_ADDED_SQL}),
             s AS ({_LAST_UPDATE_SQL}),
             merged AS (
                 SELECT g.id, CASE WHEN s.id IS NULL THEN g.v ELSE s.v END AS v
                 FROM grown g LEFT JOIN s ON g.id = s.id
                 UNION ALL
                 SELECT id, v FROM s WHERE NOT EXISTS (SELECT 1 FROM grown WHERE grown.id = s.id))
        SELECT id, v FROM merged
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND user_id = merged.id)"""
)
def cdc_apply_grouped(spark, sf_dir):
    return apply.apply_grouped(
        _accounts(spark, sf_dir), _account_events(spark, sf_dir), ACCOUNT.pk
    )


@query(_ORDERED_SQL)
def stream_apply(spark, sf_dir):
    """The landed feed applied in two micro-batches equals the batch result."""
    path = scratch_dir(spark, "feed")
    feeds.land(_events_feed(spark, sf_dir), path)
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=4)
    half = -(-len(spark.read.parquet(path).inputFiles()) // 2)
    events = feeds.route(feeds.stream_feed(spark, path, max_files=half), "shop", "events")
    start_apply(events, table, scratch_dir(spark, "checkpoint")).awaitTermination()
    return table.read()


@query(f"SELECT *, TRUE AS within FROM ({_ORDERED_SQL})")
def stream_row_batches(spark, sf_dir):
    """The landed feed committed in versions of at most a quarter of its events."""
    path = scratch_dir(spark, "feed")
    events = _events_feed(spark, sf_dir)
    feeds.land(events, path)
    size = max(1, -(-events.count() // 4))
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=4)
    stream = feeds.route(feeds.stream_feed(spark, path, positions=True), "shop", "events")
    start_apply(stream, table, scratch_dir(spark, "checkpoint"), batch_rows=size).awaitTermination()
    parts = [table.version(n) for n in table.versions()]
    most = max(sum(p.rows for p in v.parts.values() if p.seq == v.number) for v in parts if v.operation == "apply_ordered")
    return table.read().withColumn("within", F.lit(len(parts) >= 4 and most <= size))


@query(
    f"""SELECT 'events' AS "table", count(*) AS records FROM ({_ORDERED_SQL})
        UNION ALL SELECT 'orders', count(*) FROM orders"""
)
def stream_tables(spark, sf_dir):
    """One stream for two tables, read as of the last batch that reached both."""
    path, commits, root = (scratch_dir(spark, n) for n in ("feed", "commits", "tables"))
    feeds.land(_events_feed(spark, sf_dir), path)
    feeds.land(_orders_feed(spark, sf_dir), path)
    tables = {n: KeyedTable(spark, root, spec, buckets=4) for n, spec in (("events", EVENTS), ("orders", ORDERS))}
    stream = feeds.stream_feed(spark, path, max_files=4)
    start_apply_tables(stream, "shop", tables, scratch_dir(spark, "checkpoint"), commits).awaitTermination()
    rows = [(name, tables[name].count(version)) for name, version in committed(spark, commits).items()]
    return spark.createDataFrame(rows, "`table` string, records long")


@query(_ORDERED_SQL)
def stream_new_checkpoint(spark, sf_dir):
    """Half the feed, then the other half under the same name from a new checkpoint."""
    feed = _events_feed(spark, sf_dir)
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=4)
    for part in range(2):
        path = scratch_dir(spark, "feed")
        feeds.land(feed.where(F.col("txn.total_order") % 2 == part), path)
        events = feeds.route(feeds.stream_feed(spark, path), "shop", "events")
        start_apply(events, table, scratch_dir(spark, "checkpoint"), name="events").awaitTermination()
    return table.read()


@query(f"SELECT *, CAST(3 AS INTEGER) AS deltas FROM ({_ORDERED_SQL})")
def table_delta_apply(spark, sf_dir):
    """Three batches, the second one late; each is a delta part, resolved by the read."""
    feed = _events_feed(spark, sf_dir)
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=4)
    for part in (0, 2, 1):
        table.apply_feed(feed.where(F.col("txn.total_order") % 3 == part))
    return table.read().withColumn("deltas", F.lit(len(table.version().deltas)))


@query(
    """SELECT user_id, event_id, ts, value,
              (SELECT count(*) FROM events WHERE event_type = 'view') AS rejected
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
             FROM events WHERE event_type <> 'view')
       WHERE rn = 1 AND event_type <> 'error'"""
)
def apply_without_order(spark, sf_dir):
    """Events without an order number are rejected; the others are applied."""
    feed = _events_feed(spark, sf_dir, order=F.when(F.col("event_type") != "view", F.col("event_id")))
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=4)
    rejected = table.apply_feed(feed).where("reject_reason = 'no_order'").count()
    return table.read().withColumn("rejected", F.lit(rejected).cast("long"))


@query(
    """SELECT user_id + CASE WHEN user_id % 2 = 0 THEN 1000000 ELSE 0 END AS user_id, event_id, ts, value
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
       WHERE rn = 1"""
)
def key_move_rejected(spark, sf_dir):
    """Every user moves to another key. Even ones do, with a superfluous column at
    the end; the new image of odd ones is broken, so they stay where they are."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=4)
    table.apply_feed(_events_feed(spark, sf_dir, F.lit("INSERT")))
    image = feeds.row_image(EVENTS)
    moved = feeds.row_image(EVENTS, {"user_id": F.col("user_id") + 1_000_000})
    broken = F.array(F.get(moved, F.lit(0)), F.lit(b"\0"), F.get(moved, F.lit(2)), F.get(moved, F.lit(3)))
    after = F.when(F.col("user_id") % 2 == 0, F.concat(moved, F.array(F.lit(b"more")))).otherwise(broken)
    feed = feeds.build_feed(
        _table(spark, sf_dir, "events"),
        op=F.lit("UPDATE"),
        before=image,
        after=after,
        order=F.col("event_id") + 10**12,
        schema="shop",
        table="events",
        bucket=F.col("user_id") % 4,
    )
    table.apply_feed(feed)
    return table.read()


# --- scans ------------------------------------------------------------------


@query("SELECT * FROM orders WHERE o_totalprice > 250000 AND o_orderpriority LIKE '1%'")
def scan_filter(spark, sf_dir):
    return scan.scan(
        _table(spark, sf_dir, "orders"), where="o_totalprice > 250000 AND o_orderpriority LIKE '1%'"
    )


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def scan_limit(spark, sf_dir):
    return scan.scan(_table(spark, sf_dir, "orders"), order_by="o_orderkey", limit=100)


@query("SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def scan_project(spark, sf_dir):
    return scan.scan(
        _table(spark, sf_dir, "customer"),
        where=F.col("c_mktsegment") == "BUILDING",
        columns=["c_name", "c_acctbal"],
    )


@query(
    f"SELECT * FROM ({_ORDERED_SQL}) ORDER BY ts DESC, user_id LIMIT 10"
)
def topk_fresh(spark, sf_dir):
    """The flagship: feed to table to the freshest rows."""
    return scan.newest(cdc_apply_ordered(spark, sf_dir), 10, "ts", ["user_id"])


@query(
    """SELECT 'orders' AS name, count(*) AS record_count, CAST(2 AS INTEGER) AS version FROM (
           SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders)"""
)
def table_info(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ORDERS, buckets=4)
    table.append(orders)
    table.append(orders)
    told = table.info()
    return spark.createDataFrame(
        [(told["name"], told["record_count"], told["version"])], "name string, record_count long, version int"
    )


@query(
    """SELECT min(o_orderkey) AS o_orderkey_min, max(o_orderkey) AS o_orderkey_max,
              min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
              min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max
       FROM orders"""
)
def column_ranges(spark, sf_dir):
    return scan.column_ranges(
        _table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice", "o_orderdate"]
    )


@query("SELECT o_orderdate, count(*) AS records FROM orders GROUP BY 1")
def freshness_groups(spark, sf_dir):
    return scan.value_counts(_table(spark, sf_dir, "orders"), "o_orderdate")


@query("SELECT count(DISTINCT l_shipdate) AS distinct_values FROM lineitem")
def freshness_distinct(spark, sf_dir):
    return scan.distinct_values(_table(spark, sf_dir, "lineitem"), "l_shipdate")


_CUSTOMER_ZERO = ", ".join("0.0::DOUBLE AS c_acctbal" if c == "c_acctbal" else c for c in CUSTOMER.columns)


@query(
    f"""SELECT {", ".join(CUSTOMER.columns)}, CAST(1 AS INTEGER) AS version FROM customer
        UNION ALL SELECT {_CUSTOMER_ZERO}, 2 FROM customer
        UNION ALL SELECT {_CUSTOMER_ZERO}, 3 FROM customer WHERE c_mktsegment <> 'BUILDING'"""
)
def table_version(spark, sf_dir):
    """All versions read back after an append, an upsert and a delete."""
    customer = _table(spark, sf_dir, "customer")
    table = KeyedTable(spark, scratch_dir(spark, "tables"), CUSTOMER, buckets=4)
    table.append(customer)
    table.upsert(customer.withColumn("c_acctbal", F.lit(0.0)))
    table.delete(customer.where("c_mktsegment = 'BUILDING'"))
    versions = [table.read(version=v).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return versions[0].unionByName(versions[1]).unionByName(versions[2])


@query(
    f"""SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN -1.0 ELSE c_acctbal END AS c_acctbal,
               c_mktsegment, CAST(2 AS INTEGER) AS changes
        FROM customer WHERE c_custkey % 11 <> 0
        UNION ALL
        SELECT c_custkey + 10000000, c_name, c_nationkey, -1.0, c_mktsegment, 2 FROM customer
        WHERE c_custkey % 7 = 0 AND (c_custkey + 10000000) % 11 <> 0"""
)
def table_upsert_delta(spark, sf_dir):
    """Scattered keys upserted, then others deleted: two parts with the changed rows only, settled by the read."""
    customer = _table(spark, sf_dir, "customer")
    table = KeyedTable(spark, scratch_dir(spark, "tables"), CUSTOMER, buckets=4)
    table.append(customer)
    changed = customer.where("c_custkey % 7 = 0").withColumn("c_acctbal", F.lit(-1.0))
    moved = changed.withColumn("c_custkey", (F.col("c_custkey") + 10_000_000).cast("int"))
    table.upsert(changed.unionByName(moved))
    table.delete(customer.unionByName(moved).where("c_custkey % 11 = 0"))
    parts = [p for p in table.version().parts.values() if p.kind == "run"]
    return table.read().withColumn("changes", F.lit(len(parts)))


@query(
    """SELECT *, CAST(1 AS INTEGER) AS changes FROM lineitem t WHERE NOT EXISTS (
           SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
           AND r.l_orderkey = t.l_orderkey AND r.l_linenumber = t.l_linenumber)"""
)
def table_delete_delta(spark, sf_dir):
    """A delete by a composite key writes the keys, not the buckets."""
    lineitem = _table(spark, sf_dir, "lineitem")
    table = KeyedTable(spark, scratch_dir(spark, "tables"), LINEITEM, buckets=4)
    table.append(lineitem)
    table.delete(lineitem.where("l_returnflag = 'R'"))
    return table.read().withColumn("changes", F.lit(len(table.version().deltas)))


@query(
    f"""WITH grown AS (SELECT c_custkey AS id, c_acctbal AS v FROM customer UNION ALL {_ADDED_SQL}),
             s AS ({_LAST_UPDATE_SQL}),
             merged AS (
                 SELECT g.id, CASE WHEN s.id IS NULL THEN g.v ELSE s.v END AS v
                 FROM grown g LEFT JOIN s ON g.id = s.id
                 UNION ALL
                 SELECT id, v FROM s WHERE NOT EXISTS (SELECT 1 FROM grown WHERE grown.id = s.id))
        SELECT id, v FROM merged
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'error' AND user_id = merged.id)"""
)
def table_grouped_delta(spark, sf_dir):
    """A grouped batch as one part with what it does to each key."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ACCOUNT, buckets=4)
    table.append(_accounts(spark, sf_dir))
    table.apply_grouped(_account_events(spark, sf_dir))
    return table.read()


@query(f"SELECT *, TRUE AS few_parts FROM ({_ORDERED_SQL})")
def table_tiered_merge(spark, sf_dir):
    """Twenty ordered batches; parts of one size have been merged into parts of the next."""
    feed = _events_feed(spark, sf_dir)
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=2)
    for part in range(20):
        table.apply_feed(feed.where(F.col("txn.total_order") % 20 == part))
    return table.read().withColumn("few_parts", F.lit(len(table.version().parts) < 20))


@query(
    """SELECT user_id, max(event_id) AS event_id, TRUE AS forgotten, (SELECT count(*) FROM events) AS late
       FROM events WHERE user_id % 2 = 1 GROUP BY user_id"""
)
def table_watermark(spark, sf_dir):
    """All users arrive, even ones are deleted, the watermark passes: the deletions are
    forgotten by the next merge, and the feed brought again is rejected as late."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), EVENTS, buckets=2)
    feed = _events_feed(spark, sf_dir, F.lit("INSERT"))
    table.apply_feed(feed)
    image, later = feeds.row_image(EVENTS), 10**12
    table.apply_feed(
        feeds.build_feed(
            _table(spark, sf_dir, "events").where("user_id % 2 = 0"), op=F.lit("DELETE"), before=image, after=image,
            order=F.col("event_id") + later, schema="shop", table="events", bucket=F.col("user_id") % 4,
        )
    )
    table.advance_watermark(2 * later)
    late = table.apply_feed(feed).where("reject_reason = 'late'").count()
    table.ensure_key_layout()
    left = sum(p.rows for p in table.version().parts.values())
    stored = spark.read.parquet(f"{table.path}/data/rt_part={next(iter(table.version().parts))}").count()
    return table.read().select(
        "user_id", "event_id", F.lit(stored == left).alias("forgotten"), F.lit(late).cast("long").alias("late")
    )


# --- keys and layout --------------------------------------------------------


@query(
    """SELECT 'l_linenumber' AS field, 'int' AS type, 2 AS position, count(*) AS records FROM lineitem
       UNION ALL
       SELECT 'l_orderkey', 'bigint', 1, count(*) FROM lineitem"""
)
def pk_metadata_report(spark, sf_dir):
    """The marks the table was stored with, read by somebody who does not know its schema."""
    root = scratch_dir(spark, "tables")
    KeyedTable(spark, root, LINEITEM, buckets=4).append(_table(spark, sf_dir, "lineitem"))
    rows = KeyedTable.open(spark, root, "lineitem").read()
    report = audit.pk_metadata_report(spark, rows)
    return report.select("field", "type", "position", F.lit(rows.count()).cast("bigint").alias("records"))


@query(
    """SELECT count(*) AS records, count(*) - count(u) AS user_id_nulls,
              count(*) - count(event_id) AS event_id_nulls
       FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS u FROM events)"""
)
def pk_null_audit(spark, sf_dir):
    key = F.when(F.col("event_type") != "error", F.col("user_id"))
    rows = _table(spark, sf_dir, "events").select("event_id", key.alias("user_id"))
    return audit.pk_null_audit(rows, ["user_id", "event_id"])


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS records FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1"""
)
def pk_dup_audit(spark, sf_dir):
    return audit.pk_dup_audit(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    f"SELECT {', '.join(ORDERS.columns)}, CAST(2 AS INTEGER) AS parts_before, CAST(1 AS INTEGER) AS parts "
    "FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)"
)
def ensure_key_layout(spark, sf_dir):
    """Two appends leave every bucket in two parts; the layout run merges them by key."""
    orders = _table(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ORDERS, buckets=4)
    table.append(orders)
    table.append(orders)
    before = len(table.version().parts)
    table.ensure_key_layout()
    after = len(table.version().parts)
    return table.read().withColumns({"parts_before": F.lit(before), "parts": F.lit(after)})


@query(f"SELECT {', '.join(ORDERS.columns)} FROM orders WHERE o_orderkey IN (SELECT 7 * l_partkey FROM lineitem)")
def key_lookup(spark, sf_dir):
    """Rows by key, from the buckets the keys hash to."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ORDERS, buckets=4)
    table.append(_table(spark, sf_dir, "orders"))
    return table.lookup(_table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 7).alias("o_orderkey")))


@query(
    f"""SELECT {', '.join(ORDERS.columns)}, TRUE AS fewer_files FROM orders
        WHERE o_orderkey IN (SELECT 997 * s_suppkey FROM supplier WHERE s_suppkey <= 5)"""
)
def key_lookup_files(spark, sf_dir):
    """Scattered keys in a merged table: only files whose key range holds one are opened."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ORDERS, buckets=16)
    orders = _table(spark, sf_dir, "orders")
    table.append(orders.where("o_orderkey % 2 = 0"))
    table.append(orders.where("o_orderkey % 2 = 1"))
    table.ensure_key_layout()
    keys = _table(spark, sf_dir, "supplier").where("s_suppkey <= 5").select((F.col("s_suppkey") * 997).alias("o_orderkey"))
    found = table.lookup(keys)
    fewer = len(found.inputFiles()) < len(table.read().inputFiles())
    return found.withColumn("fewer_files", F.lit(fewer))


@query("SELECT min(o_orderkey) AS low, max(o_orderkey) AS high, count(*) AS records FROM orders")
def table_key_ranges(spark, sf_dir):
    """Key range and row count out of the version's statistics."""
    table = KeyedTable(spark, scratch_dir(spark, "tables"), ORDERS, buckets=4)
    table.append(_table(spark, sf_dir, "orders"))
    low, high = table.key_ranges()["o_orderkey"]
    return spark.createDataFrame([(low, high, table.count())], "low long, high long, records long")


@query(
    """SELECT l_orderkey, count(*) AS records FROM lineitem
       WHERE l_linenumber = 1 OR l_orderkey % 3 = 0 GROUP BY 1 HAVING count(*) > 1"""
)
def pk_incremental_audit(spark, sf_dir):
    """Repeated keys after a second load; the audit reads again only buckets that have changed."""
    lineitem = _table(spark, sf_dir, "lineitem")
    spec = TableSpec.infer("lines", lineitem.select("l_orderkey", "l_linenumber").schema, ["l_orderkey"])
    table = KeyedTable(spark, scratch_dir(spark, "tables"), spec, buckets=8)
    table.append(lineitem.where("l_linenumber = 1").select("l_orderkey", "l_linenumber"))
    table.audit_keys()
    table.append(lineitem.where("l_linenumber > 1 AND l_orderkey % 3 = 0").select("l_orderkey", "l_linenumber"))
    return table.audit_keys()


# --- several tables ---------------------------------------------------------


@query(
    """SELECT 'events' AS "table", CAST(user_id % 4 AS INTEGER) AS bucket, count(*) AS events
       FROM events GROUP BY 2
       UNION ALL
       SELECT 'orders', CAST(o_custkey % 4 AS INTEGER), count(*) FROM orders GROUP BY 2"""
)
def multi_table_counts(spark, sf_dir):
    feed = _landed(spark, _events_feed(spark, sf_dir), _orders_feed(spark, sf_dir))
    return jobs.bucket_counts(feed, "shop", ["events", "orders"])


@query(
    f"""SELECT 'events' AS "table", TRUE AS ok, count(*) AS records,
               (SELECT count(*) FROM events WHERE event_type = 'view') AS rejects
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
              FROM events WHERE event_type <> 'view')
        WHERE rn = 1 AND event_type <> 'error'
        UNION ALL SELECT 'orders', TRUE, count(*), 0 FROM orders
        UNION ALL SELECT 'unlisted', FALSE, NULL, NULL"""
)
def multi_table_status(spark, sf_dir):
    order = F.when(F.col("event_type") != "view", F.col("event_id"))
    feed = _landed(spark, _events_feed(spark, sf_dir, order=order), _orders_feed(spark, sf_dir))
    return jobs.apply_tables(
        spark,
        feed,
        "shop",
        {"events": EVENTS, "orders": ORDERS},
        scratch_dir(spark, "tables"),
        tables=["events", "orders", "unlisted"],
        table_buckets=4,
    ).drop("message")
