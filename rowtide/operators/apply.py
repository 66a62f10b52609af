"""Apply decoded change events to a table.

Two modes. *Ordered* keeps, per key, the event latest in change order: the
result is the same however the feed is split into batches. *Grouped* runs a
batch as append, then upsert, then delete.

Events are rows with ``_op``, ``_order`` and the table's columns, as
``decode_feed`` returns them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.mutate import append, conform, last_wins, matched_keys

ORDER = T.StructType(
    [
        T.StructField("total_order", T.LongType()),
        T.StructField("data_collection_order", T.LongType()),
        T.StructField("step", T.IntegerType()),
    ]
)
# Columns a stored table keeps next to its own, for change order and deletions.
STATE = ("_order", "_deleted")


def as_state(rows: DataFrame) -> DataFrame:
    """Plain rows as table state: older than any event, not deleted."""
    if "_deleted" in rows.columns:
        return rows
    return rows.select(
        "*", F.lit(None).cast(ORDER).alias("_order"), F.lit(False).alias("_deleted")
    )


def live(state: DataFrame) -> DataFrame:
    """The table a state stands for."""
    return state.where(~F.col("_deleted")).drop(*STATE)


def _no_null(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(f"`{k}`").isNotNull()
    return present


def latest_changes(events: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One state row per key: the last event; a deletion becomes a tombstone."""
    usable = events.where((F.col("_op") != "DELETE") | _no_null(pk))
    return as_changes(last_wins(usable, pk, ["_order"]))


def as_changes(latest: DataFrame) -> DataFrame:
    """Events already reduced to one per key, as state rows."""
    return latest.select(
        *[c for c in latest.columns if c not in ("_op", "_order")],
        F.col("_order").cast(ORDER).alias("_order"),
        (F.col("_op") == "DELETE").alias("_deleted"),
    )


def merge_changes(
    state: DataFrame | None,
    changes: DataFrame,
    pk: Sequence[str],
    broadcast_keys: bool = False,
) -> DataFrame:
    """New state from ``latest_changes``; a change older than what is stored is ignored.

    State rows are kept in place and matched against the keys of the changes
    only. ``broadcast_keys`` is for callers that measured those keys.
    """
    if state is None:
        return changes
    keys = list(pk)
    changes = conform(changes, state.schema)
    arriving = changes.select(*keys, F.col("_order").alias("_arriving"))
    if broadcast_keys:
        arriving = F.broadcast(arriving)
    outdated = F.col("_order").isNull() | (F.col("_order") < F.col("_arriving"))
    kept = (
        state.join(arriving, keys, "left")
        .where(F.col("_arriving").isNull() | ~outdated)
        .select(*state.columns)
    )
    stale = (
        state.select(*keys, "_order")
        .join(arriving, keys, "inner")
        .where(~outdated)
        .select(*keys)
        .distinct()
    )
    fresh = changes.join(stale, keys, "left_anti").select(*state.columns)
    return kept.unionByName(fresh)


def apply_ordered(
    target: DataFrame | None, events: DataFrame, pk: Sequence[str]
) -> DataFrame:
    """The table after a batch, in change order.

    ``target`` may be a plain table or carry the ``STATE`` columns; with them
    late events of earlier batches are recognised. Returns the same form.
    """
    changes = latest_changes(events, pk)
    if target is None:
        return live(changes)
    if "_deleted" in target.columns:
        return merge_changes(target, changes, pk)
    changes = conform(changes, as_state(target).schema)
    kept = target.join(changes.select(*pk), list(pk), "left_anti").select(*target.columns)
    return kept.unionByName(live(changes))


def apply_grouped(
    target: DataFrame | None, events: DataFrame, pk: Sequence[str]
) -> DataFrame:
    """The table after a batch run as append, keyed upsert, keyed delete.

    What a batch does to a key is folded into one action per key, so the table
    is joined once, and keys appended by the batch need not be looked up in it.
    """
    keys = list(pk)
    plain = events.drop("_op", "_order")
    is_op = F.col("_op")
    added = events.where(is_op.isin("INSERT", "SNAPSHOT")).drop("_op", "_order")
    grown = append(target, added)

    content = [c for c in plain.columns if c in grown.columns]
    update = F.struct("_order", *[F.col(f"`{c}`") for c in content])
    actions = (
        events.groupBy(*[F.col(f"`{k}`").alias(f"_k_{k}") for k in keys])
        .agg(
            F.max(F.when(is_op == "UPDATE", update)).alias("_new"),
            F.max((is_op == "DELETE") & _no_null(keys)).alias("_gone"),
            F.max(is_op.isin("INSERT", "SNAPSHOT") & _no_null(keys)).alias("_added"),
        )
        .where(F.col("_new").isNotNull() | F.col("_gone"))
    )
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"`{k}`") == F.col(f"_k_{k}"))
    changed = (
        grown.join(actions, same, "left")
        .where(F.col("_gone").isNull() | ~F.col("_gone"))
        .select(
            *[
                (
                    F.when(F.col("_new").isNotNull(), F.col("_new").getField(f.name).cast(f.dataType))
                    .otherwise(F.col(f"`{f.name}`"))
                    if f.name in content
                    else F.when(F.col("_new").isNull(), F.col(f"`{f.name}`"))
                ).alias(f.name)
                for f in grown.schema.fields
            ]
        )
    )
    absent = F.col("_new").isNotNull() & ~F.col("_gone") & ~F.col("_added")
    upserts = actions.where(absent).select(
        *[F.col("_new").getField(c).alias(c) for c in content]
    )
    missing = upserts
    if target is not None:
        missing = upserts.join(matched_keys(target, upserts, keys), keys, "left_anti")
    return changed.unionByName(conform(missing, grown.schema))
