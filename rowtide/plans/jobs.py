"""Apply a landed feed to every table of a schema set."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.catalog.benchmarks import SCHEMA_SETS
from rowtide.catalog.spec import TableSpec
from rowtide.plans.table import KeyedTable
from rowtide.sources.feed import poll, route

STATUS = "table string, ok boolean, records bigint, rejects bigint, message string"


def bucket_counts(feed: DataFrame, schema: str, tables: Iterable[str] | None = None) -> DataFrame:
    """Events per (table, bucket)."""
    events = route(feed, schema)
    if tables is not None:
        events = events.where(F.col("feed_table").isin(list(tables)))
    return events.groupBy(F.col("feed_table").alias("table"), "bucket").agg(
        F.count(F.lit(1)).alias("events")
    )


def apply_tables(
    spark: SparkSession,
    feed: DataFrame,
    schema: str,
    specs: dict[str, TableSpec] | str,
    root: str,
    *,
    tables: Iterable[str] | None = None,
    buckets: Iterable[int] | None = None,
    mode: str = "ordered",
    table_buckets: int = 16,
    parallel: int = 4,
) -> DataFrame:
    """Apply each table's events; one table's failure does not stop the others.

    ``specs`` is a schema set or its name. All feed buckets of a table are read
    by one job; ``parallel`` only lets small tables share the cluster. Rejects
    are written below the table, one folder per run, and counted in the status.
    """
    specs = SCHEMA_SETS[specs] if isinstance(specs, str) else specs
    wanted = list(tables) if tables is not None else list(specs)

    def run(name: str) -> tuple[str, bool, int | None, int | None, str]:
        try:
            table = KeyedTable(spark, root, specs[name], table_buckets)
            rejects, seen = table.apply_feed(poll(feed, schema, name, buckets), mode), Observation()
            rejects.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{table.path}/rejects/run={uuid.uuid4().hex}")
            return name, True, table.count(), seen.get["n"], "ok"
        except Exception as err:
            lines = str(err).splitlines() or [""]
            return name, False, None, None, f"{type(err).__name__}: {lines[0]}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return spark.createDataFrame(list(pool.map(run, wanted)), STATUS)
