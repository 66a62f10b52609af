"""Pick the row image of each change event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.catalog.spec import TableSpec
from rowtide.sources.feed import operation


def _filled(image: str) -> Column:
    return F.coalesce(F.size(F.col(image)), F.lit(0)) > 0


def drop_reason(feed: DataFrame) -> Column:
    """Why an event carries no usable image; NULL when it does."""
    name = operation(feed["op"])
    return (
        F.when(name.isNull(), "unknown_op")
        .when(name.isin("UPDATE", "DELETE") & ~_filled("before"), "empty_before")
        .when((name != "DELETE") & ~_filled("after"), "empty_after")
    )


def extract_images(feed: DataFrame) -> DataFrame:
    """Add ``_op`` and ``_cols``; events without the image they need are dropped.

    INSERT and SNAPSHOT give the after image, DELETE the before image, UPDATE
    the before image followed by the after image.
    """
    name = operation(feed["op"])
    cols = (
        F.when(name == "UPDATE", F.concat("before", "after"))
        .when(name == "DELETE", F.col("before"))
        .otherwise(F.col("after"))
    )
    kept = feed.where(drop_reason(feed).isNull())
    return kept.select("*", name.alias("_op"), cols.alias("_cols"))


def dropped_events(feed: DataFrame) -> DataFrame:
    """Events ``extract_images`` leaves out, with the reason."""
    return feed.select("*", drop_reason(feed).alias("reason")).where("reason is not null")


def op_group(op: Column) -> Column:
    """The three apply groups: insert and snapshot share one."""
    return (
        F.when(op.isin("INSERT", "SNAPSHOT"), "append")
        .when(op == "UPDATE", "upsert")
        .when(op == "DELETE", "delete")
    )


def after_image(cols: Column, op: Column, width: int) -> Column:
    """The image to decode from extracted columns: UPDATE skips the first ``width``."""
    return F.when(op == "UPDATE", F.slice(cols, width + 1, width)).otherwise(
        F.slice(cols, 1, width)
    )


def arity(cols: Column, op: Column, width: int) -> Column:
    """Struct ``(expected, received, agrees)`` for extracted columns."""
    expected = F.when(op == "UPDATE", 2 * width).otherwise(width)
    received = F.size(cols)
    return F.struct(
        expected.alias("expected"), received.alias("received"), (expected == received).alias("agrees")
    )


def record_images(feed: DataFrame, spec: TableSpec, split_key_changes: bool = False) -> DataFrame:
    """Usable events as ``_op``, ``_order``, ``_image`` (the image to decode).

    The image equals ``after_image(extract_images(..))``, but before and after
    are only joined when the before image has an unexpected width. With
    ``split_key_changes`` an UPDATE that changes key bytes becomes a delete of
    the old key (step 0) and a set of the new one (step 1) at the same order;
    the delete then carries the after image as ``_paired``, so that both halves
    can be decided together. An event without order numbers has none in ``_order``.

    One ``inline`` yields zero, one or two records per event. Nothing is pushed
    below it, so operation and image are worked out once per event however
    often the decode refers to them.
    """
    width = len(spec.fields)
    text = F.upper("op")
    usual = F.size("before") == width
    after = F.when(usual, F.col("after")).otherwise(
        F.slice(F.concat("before", "after"), width + 1, width)
    )

    def record(step: int, name: Column, image: Column, paired: Column | None = None) -> Column:
        fields = [name.alias("_op"), image.alias("_image"), F.lit(step).cast("int").alias("_step")]
        if split_key_changes:
            none = F.lit(None).cast("array<binary>")
            fields.append((none if paired is None else paired).alias("_paired"))
        return F.struct(*fields)

    update = F.array(record(1, F.lit("UPDATE"), after))
    if split_key_changes and spec.pk:
        moved = F.lit(False)
        for spot in [spec.columns.index(k) for k in spec.pk]:
            old, new = F.get("before", F.lit(spot)), F.get(after, F.lit(spot))
            moved = moved | ~old.eqNullSafe(new)
        update = F.when(
            (F.size("before") >= width) & (F.size(after) >= width) & moved,
            F.array(record(0, F.lit("DELETE"), F.col("before"), after), record(1, F.lit("UPDATE"), after)),
        ).otherwise(update)
    # Operation names, their wire numbers; an unset operation is INSERT.
    records = (
        F.when(
            F.col("op").isNull() | text.isin("INSERT", "0", "SNAPSHOT", "3"),
            F.when(
                _filled("after"),
                F.array(
                    record(
                        1,
                        F.when(text.isin("SNAPSHOT", "3"), "SNAPSHOT").otherwise("INSERT"),
                        F.col("after"),
                    )
                ),
            ),
        )
        .when(text.isin("UPDATE", "1"), F.when(_filled("before") & _filled("after"), update))
        .when(
            text.isin("DELETE", "2"),
            F.when(_filled("before"), F.array(record(1, F.lit("DELETE"), F.col("before")))),
        )
    )
    # the order fields are taken out first, so the transaction id is never read
    ordered = feed.select(
        "op",
        "before",
        "after",
        F.col("txn.total_order").alias("_total"),
        F.col("txn.data_collection_order").alias("_within"),
    )
    listed = ordered.select("_total", "_within", F.inline(records))
    order = F.struct(
        F.col("_total").alias("total_order"),
        F.coalesce("_within", F.lit(0)).alias("data_collection_order"),
        F.col("_step").alias("step"),
    )
    paired = ["_paired"] if split_key_changes else []
    return listed.select("_op", order.alias("_order"), "_image", *paired)
