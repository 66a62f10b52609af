"""The landed change feed: its schema, batch and streaming readers, routing.

A feed directory holds Parquet files partitioned by ``feed_schema``,
``feed_table`` and ``bucket``, so routing and bucket selection prune
directories instead of reading them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.catalog.spec import TableSpec
from rowtide.functions.encode import encode

# Wire numbers of the operations; an unset operation is INSERT.
OPERATIONS = {"0": "INSERT", "1": "UPDATE", "2": "DELETE", "3": "SNAPSHOT"}

EVENT = (
    "op string, before array<binary>, after array<binary>, "
    "source struct<db: string, schema: string, table: string>, "
    "txn struct<id: string, total_order: bigint, data_collection_order: bigint>"
)
FEED = EVENT + ", feed_schema string, feed_table string, bucket int"


def operation(op: Column, unknown: str | None = None) -> Column:
    """Operation name from text in any case or a wire number; unset is INSERT.

    Anything else becomes ``unknown``: NULL on the feed (the event is dropped),
    ``"INSERT"`` where a caller names the operation of a record in text.
    """
    text = F.upper(op.cast("string"))
    out = F.when(op.isNull(), "INSERT")
    for number, name in OPERATIONS.items():
        out = out.when((text == name) | (text == number), name)
    return out.otherwise(F.lit(unknown).cast("string"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEED).parquet(path)


def stream_feed(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    positions: bool = False,
) -> DataFrame:
    """Streaming reader; the file or byte limit bounds the size of a micro-batch.

    ``positions`` adds ``_file`` and ``_row``, by which ``start_apply`` cuts batches of a
    number of rows.
    """
    reader = spark.readStream.schema(FEED)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    feed = reader.parquet(path)
    if not positions:
        return feed
    return feed.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def slices(batch: DataFrame, size: int) -> list[DataFrame]:
    """A batch with positions cut into parts of at most ``size`` rows, the same ones whenever it is cut.

    The driver sees the number of rows per file and run of ``size`` places in it.
    """
    run = F.floor(F.col("_row") / size)
    counts = batch.groupBy("_file", run.alias("_run")).count().orderBy("_file", "_run").collect()
    groups: list[list[tuple]] = []
    room = 0
    for file, at, n in counts:
        if n > room:
            groups.append([])
            room = size
        groups[-1].append((file, at))
        room -= n
    spark = batch.sparkSession
    return [
        batch.withColumn("_run", run)
        .join(spark.createDataFrame(own, "_file string, _run long"), ["_file", "_run"], "left_semi")
        .drop("_run")
        for own in groups
    ]


def route(feed: DataFrame, schema: str | None = None, table: str | None = None) -> DataFrame:
    """Events of one schema and table, by partition directory."""
    if schema is not None:
        feed = feed.where(F.col("feed_schema") == schema)
    if table is not None:
        feed = feed.where(F.col("feed_table") == table)
    return feed


def pick_buckets(feed: DataFrame, buckets: Iterable[int] | None = None) -> DataFrame:
    """Events of the given buckets; none given means all."""
    wanted = list(buckets or [])
    return feed.where(F.col("bucket").isin(wanted)) if wanted else feed


def poll(
    feed: DataFrame, schema: str, table: str, buckets: Iterable[int] | None = None
) -> DataFrame:
    """Events of one table, optionally of some buckets."""
    return pick_buckets(route(feed, schema, table), buckets)


def land(feed: DataFrame, path: str, mode: str = "append") -> None:
    """Write events as a feed directory, without a shuffle."""
    feed.write.mode(mode).partitionBy("feed_schema", "feed_table", "bucket").parquet(path)


def row_image(spec: TableSpec, columns: dict[str, Column] | None = None) -> Column:
    """One byte string per field, from typed columns (same-named by default)."""
    columns = columns or {}
    return F.array(*[encode(f, columns.get(f.name, F.col(f.name))) for f in spec.fields])


def build_feed(
    rows: DataFrame,
    *,
    op: Column,
    before: Column,
    after: Column,
    order: Column,
    schema: str,
    table: str,
    bucket: Column,
    sub_order: Column | None = None,
) -> DataFrame:
    """Change events from typed rows: images are emptied where the operation has none."""
    nothing = F.array().cast("array<binary>")
    name = operation(op)
    sub = F.lit(0) if sub_order is None else sub_order
    return rows.select(
        op.alias("op"),
        F.when(name.isin("UPDATE", "DELETE"), before).otherwise(nothing).alias("before"),
        F.when(name == "DELETE", nothing).otherwise(after).alias("after"),
        F.struct(
            F.lit("db").alias("db"), F.lit(schema).alias("schema"), F.lit(table).alias("table")
        ).alias("source"),
        F.struct(
            order.cast("string").alias("id"),
            order.cast("bigint").alias("total_order"),
            sub.cast("bigint").alias("data_collection_order"),
        ).alias("txn"),
        F.lit(schema).alias("feed_schema"),
        F.lit(table).alias("feed_table"),
        bucket.cast("int").alias("bucket"),
    )
