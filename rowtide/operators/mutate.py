"""Append, keyed upsert and keyed delete as functions of two DataFrames.

``target`` is the table, ``source`` the incoming batch. Key equality is SQL
equality: a NULL key never matches, so it is inserted by an upsert and deletes
nothing. The join strategy is left to Spark: the source side of every join is
unique on the key, so it can be broadcast when its size allows, and when not,
adaptive execution can split a hot key on the target side.

A merge refers to its source more than once. Write or persist a source that is
costly to derive; ``KeyedTable`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_columns(pk: str | Sequence[str] | None, action: str) -> list[str]:
    if not pk:
        raise ValueError(f"a primary key is needed for {action}")
    return [pk] if isinstance(pk, str) else list(pk)


def conform(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in the target's order and types; missing ones are NULL, extra ones go."""
    present = {c.lower() for c in source.columns}
    return source.select(
        *[
            (
                F.col(f"`{f.name}`").cast(f.dataType)
                if f.name.lower() in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )


def append(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """All rows of both, without a key check."""
    return source if target is None else target.unionByName(conform(source, target.schema))


def last_wins(
    source: DataFrame, pk: str | Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """One row per key, the last by ``order``; NULL keys count as equal.

    Ties are broken by the row itself, so the result does not depend on how the
    input is split. Each task reduces its keys before the shuffle, so a key with
    most of the changes arrives as one row per task.
    """
    keys = key_columns(pk, "deduplication")
    ranks = [
        F.col(f"`{o}`") if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order)
    ]
    ranked = [o for o in order if isinstance(o, str)]
    rest = [c for c in source.columns if c not in keys and c not in ranked]
    best = F.max(F.struct(*ranks, *[F.col(f"`{c}`") for c in rest])).alias("_best")
    picked = source.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best)
    return picked.select(
        *[
            F.col(f"`{c}`") if c in keys else F.col("_best").getField(c).alias(c)
            for c in source.columns
        ]
    )


def duplicate_report(source: DataFrame, pk: str | Sequence[str]) -> DataFrame:
    """Source rows, rows left after deduplication, rows dropped."""
    keys = key_columns(pk, "deduplication")
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("source_records"),
        F.count(F.lit(1)).alias("deduped_records"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("dropped_duplicates"),
    )


def matched_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``source`` present in ``target``; reads only the target's key columns."""
    hits = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    return hits.distinct()


def replace_or_insert(
    target: DataFrame, source: DataFrame, pk: Sequence[str], unique_target: bool = False
) -> DataFrame:
    """Merge a key-unique source: matched rows take its columns, the others are inserted.

    Every matching target row is replaced, so a key the target holds twice stays
    twice. A target known to be unique on its key takes the cheaper route of
    dropping matched rows and adding the source.
    """
    keys = list(pk)
    source = conform(source, target.schema)
    if unique_target:
        return target.join(source.select(*keys), keys, "left_anti").select(
            *target.columns
        ).unionByName(source)
    new = source.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("_new"),
    )
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    replaced = target.join(new, same, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new").getField(c))
            .otherwise(F.col(f"`{c}`"))
            .alias(c)
            for c in target.columns
        ]
    )
    inserted = source.join(matched_keys(target, source, keys), keys, "left_anti")
    return replaced.unionByName(inserted.select(*target.columns))


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    pk: str | Sequence[str] | None,
    order: Sequence[Column | str],
    unique_target: bool = False,
) -> DataFrame:
    """Deduplicate the source, last one wins, then merge it into the target."""
    keys = key_columns(pk, "upsert")
    shape = [c for c in source.columns if target is None or c in target.columns]
    latest = last_wins(source, keys, order).select(*shape)
    if target is None:
        return latest
    return replace_or_insert(target, latest, keys, unique_target)


def delete(target: DataFrame | None, keys_of: DataFrame, pk: str | Sequence[str] | None) -> DataFrame:
    """Target rows whose key is not among ``keys_of``."""
    keys = key_columns(pk, "delete")
    if target is None:
        raise ValueError("cannot delete from a table that does not exist")
    doomed = keys_of.select(*keys).distinct()
    return target.join(doomed, keys, "left_anti").select(*target.columns)
