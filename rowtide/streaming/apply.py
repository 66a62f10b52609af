"""Continuous apply: every micro-batch of a landed feed becomes a table version.

The batch number is stored in the version it produced, together with the
query's own id from its checkpoint, so a batch replayed after a failure changes
nothing, and a feed started on a new checkpoint is read from its start. A
micro-batch follows the reader's file or byte limit and may be committed in parts of a
number of rows; the flush interval is the trigger, and the next batch is only
admitted once the previous one is committed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rowtide.plans.table import KeyedTable
from rowtide.sources import feed as feeds
from rowtide.sources.storage import AlreadyExists, Storage


def start_apply(
    feed: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    mode: str = "ordered",
    rejects_path: str | None = None,
    every: str | None = None,
    name: str | None = None,
    batch_rows: int | None = None,
) -> StreamingQuery:
    """Start applying a streaming feed to a table.

    With ``batch_rows`` a micro-batch is committed in versions of at most so many
    events each; the feed must carry positions. Keep the number until a batch that
    was under way has been finished.

    ``every`` is a processing-time interval such as ``"30 seconds"``; without it
    the query works off what is there and stops. ``name`` is a label for this feed
    in the table's versions and defaults to the checkpoint location. Rejects are
    written per query and batch, below the table unless ``rejects_path`` says
    where; a replay overwrites its own.
    """
    rejected = rejects_path or f"{table.path}/rejects"
    storage, label = Storage(table.spark), name or checkpoint

    def flush(batch: DataFrame, number: int) -> None:
        query = json.loads(storage.read_text(f"{checkpoint}/metadata"))["id"]
        target = f"{rejected}/query={query}/batch={number}"
        if batch_rows is None:
            table.apply_feed(batch, mode, (f"{label}#{query}", number)).write.mode("overwrite").parquet(target)
            return
        batch = batch.persist()
        try:
            for i, part in enumerate(feeds.slices(batch, batch_rows)):
                rejects = table.apply_feed(part, mode, (f"{label}#{query}", [number, i]))
                rejects.write.mode("overwrite").parquet(f"{target}/part={i}")
        finally:
            batch.unpersist()

    return _start(feed, flush, checkpoint, every)


def _start(feed: DataFrame, flush, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = feed.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def start_apply_tables(
    feed: DataFrame,
    schema: str,
    tables: Mapping[str, KeyedTable],
    checkpoint: str,
    commits: str,
    *,
    mode: str = "ordered",
    every: str | None = None,
    name: str | None = None,
    parallel: int = 4,
) -> StreamingQuery:
    """One stream for many tables: each micro-batch is read once and routed.

    It is kept for that only if several tables have events in it; those of one are read
    directly. A table without events in a batch stays at its version.
    ``tables`` by their name in the feed. Every table keeps the batch it has last
    applied, so a batch replayed after a failure between two tables reaches each
    of them once. When all have it, their versions are recorded below
    ``commits``; ``committed`` reads them as one state of the whole schema.
    """
    storage, label = Storage(feed.sparkSession), name or checkpoint

    def flush(batch: DataFrame, number: int) -> None:
        query = json.loads(storage.read_text(f"{checkpoint}/metadata"))["id"]
        batch = batch.where(F.col("feed_table").isin(list(tables)))
        busy = {source for source in tables if not feeds.route(batch, schema, source).isEmpty()}
        if len(busy) > 1:
            batch = batch.persist()

        def one(item: tuple[str, KeyedTable]) -> tuple[str, int]:
            source, table = item
            current = table.version()
            if source not in busy and current is not None:
                return source, current.number
            done = (f"{label}#{query}", number)
            rejects = table.apply_feed(feeds.route(batch, schema, source), mode, done)
            rejects.write.mode("overwrite").parquet(f"{table.path}/rejects/query={query}/batch={number}")
            return source, table.version().number

        try:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                versions = dict(pool.map(one, tables.items()))
            storage.create_text(f"{commits}/query={query}/{number:010d}.json", json.dumps(versions))
        except AlreadyExists:
            pass  # recorded before the failure that brought the batch back
        finally:
            if len(busy) > 1:
                batch.unpersist()

    return _start(feed, flush, checkpoint, every)


def committed(spark: SparkSession, commits: str) -> dict[str, int]:
    """The tables' versions after the last batch that reached all of them; empty before the first."""
    storage = Storage(spark)
    if not storage.exists(commits):
        return {}
    records = [e.path for folder in storage.list(commits) for e in storage.list(folder.path) if e.name.endswith(".json")]
    found = [json.loads(storage.read_text(path)) for path in records]
    return max(found, key=lambda versions: sorted(versions.values()), default={})


def start_print(feed: DataFrame, rows: int = 20) -> StreamingQuery:
    """Dry run: show the events instead of storing them."""
    return (
        feed.writeStream.format("console").option("numRows", rows).trigger(availableNow=True).start()
    )
