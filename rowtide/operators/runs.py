"""Runs: what a sequence of commits adds to a keyed table, settled when it is read.

A run holds plain rows and at most one change per key. The change applies to all
rows of older runs with that key, the rows of the run itself come after it:

    UPSERT  older rows with the key take the values; without any, one row is added
    UPDATE  older rows with the key take the values
    DELETE  older rows with the key go

Runs settle in any grouping: neighbouring ones merge into one run with the same
effect on whatever lies below, and all of them into plain rows. NULL keys match
nothing, so changes never have one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.mutate import conform

ROW, UPSERT, UPDATE, DELETE = range(4)
KIND, SEQ = "_kind", "_seq"


def with_key(pk: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in pk:
        present = present & F.col(f"`{k}`").isNotNull()
    return present


def plain(rows: DataFrame) -> DataFrame:
    return rows.withColumn(KIND, F.lit(ROW))


def upserts(rows: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Key-unique rows as a run; those with a NULL key are added."""
    return rows.withColumn(KIND, F.when(with_key(pk), UPSERT).otherwise(ROW))


def deletes(keys: DataFrame, pk: Sequence[str]) -> DataFrame:
    return keys.select(*[F.col(f"`{k}`") for k in pk]).dropna().distinct().withColumn(KIND, F.lit(DELETE))


def settle(rows: DataFrame, changes: DataFrame, pk: Sequence[str], complete: bool) -> DataFrame:
    """Merge runs, given as their plain rows and their changes with ``SEQ``, the run's place.

    ``complete``: nothing lies below, and the result is plain rows only. Changes
    are reduced to one row per key before the rows are matched; a key has at most
    one change per run, so what is gathered per key is as small as the number of runs.
    """
    names = [c for c in rows.columns if c not in (KIND, SEQ)]
    values = [c for c in names if c not in pk]
    keys = [f"_k_{k}" for k in pk]
    kind, seq = F.col(KIND), F.col(SEQ)
    acts = changes.groupBy(*[F.col(f"`{k}`").alias(a) for k, a in zip(pk, keys)]).agg(
        F.coalesce(F.max(F.when(kind == DELETE, seq)), F.lit(-1).cast("long")).alias("_gone"),
        F.collect_list(F.when(kind == UPSERT, seq)).alias("_ups"),
        F.max(F.when(kind != DELETE, F.struct(seq, *[F.col(f"`{c}`") for c in values]))).alias("_new"),
    )
    acts = acts.select(
        *keys, "_gone", F.when(F.col("_new")[SEQ] > F.col("_gone"), F.col("_new")).alias("_new"),
        F.array_min(F.filter("_ups", lambda s: s > F.col("_gone"))).alias("_first"),
    )
    same = F.lit(True)
    for k, a in zip(pk, keys):
        same = same & (F.col(f"`{k}`") == F.col(a))

    overwritten = F.col("_new").isNotNull() & (seq < F.col("_new")[SEQ])
    kept = rows.join(acts, same, "left").where(F.col("_gone").isNull() | (seq >= F.col("_gone")))
    kept = kept.select(
        *[
            (F.when(overwritten, F.col("_new")[c]).otherwise(F.col(f"`{c}`")) if c in values else F.col(f"`{c}`")).alias(c)
            for c in names
        ],
        F.lit(ROW).alias(KIND),
    )
    adding = acts.where(F.col("_first").isNotNull())
    met = rows.join(adding.select(*keys, "_gone", "_first"), same).where((seq >= F.col("_gone")) & (seq < F.col("_first")))
    added = adding.join(met.select(*keys).distinct(), keys, "left_anti")

    def made(acts: DataFrame, kind: int | Column) -> DataFrame:
        cells = [F.col(a).alias(k) for k, a in zip(pk, keys)] + [F.col("_new")[c].alias(c) for c in values]
        return acts.select(*cells, (F.lit(kind) if isinstance(kind, int) else kind).alias(KIND)).select(*names, KIND)

    if complete:
        out = kept.unionByName(made(added, ROW))
    else:
        gone = acts.where("_gone >= 0").withColumn("_new", F.lit(None).cast(acts.schema["_new"].dataType))
        on_older = F.col("_gone") < 0
        fresh = added.select(*keys, F.lit(True).alias("_adds"))
        changed = acts.where(on_older).join(fresh, keys, "left")
        out = (
            kept.unionByName(made(gone, DELETE))
            .unionByName(made(added.where("_gone >= 0"), ROW))
            .unionByName(made(changed, F.when(F.col("_adds"), UPSERT).otherwise(UPDATE)))
        )
    return conform(out, rows.drop(SEQ).schema)


def grouped(events: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One run for a batch of events taken as append, then keyed upsert, then keyed delete.

    Per key the update with the greatest order counts.
    """
    op = F.col("_op")
    content = [c for c in events.columns if c not in ("_op", "_order", *pk)]
    added = plain(events.where(op.isin("INSERT", "SNAPSHOT")).drop("_op", "_order")).withColumn(SEQ, F.lit(1).cast("long"))
    last = events.where(op == "UPDATE").groupBy(*[F.col(f"`{k}`") for k in pk]).agg(
        F.max(F.struct("_order", *[F.col(f"`{c}`") for c in content])).alias("_new")
    )
    names = [c for c in events.columns if c not in ("_op", "_order")]
    updated = last.select(*[F.col(f"`{c}`") if c in pk else F.col("_new")[c].alias(c) for c in names])
    updated = upserts(updated, pk).withColumn(SEQ, F.lit(2).cast("long"))
    gone = deletes(events.where(op == "DELETE"), pk).withColumn(SEQ, F.lit(3).cast("long"))
    rows = added.unionByName(updated.where(F.col(KIND) == ROW))
    changes = updated.where(F.col(KIND) != ROW).unionByName(gone, allowMissingColumns=True)
    return settle(rows, changes, pk, complete=False)
