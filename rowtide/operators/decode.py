"""Decode row images into typed columns, splitting off rows that break the spec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowtide.catalog.spec import FieldSpec, TableSpec
from rowtide.functions import wire
from rowtide.operators.extract import record_images
from rowtide.operators.mutate import last_wins

ENVELOPE = ("_op", "_order")


def _cell(position: int) -> Column:
    return F.get("_image", F.lit(position))


def _must_decode(spec: TableSpec) -> list[tuple[int, FieldSpec]]:
    return [(i, f) for i, f in enumerate(spec.fields) if not f.nullable]


def _broken(spec: TableSpec, position: int, field: FieldSpec) -> Column:
    """A required column without a value. A DELETE only needs its key columns."""
    broken = ~F.coalesce(wire.is_sound(field, _cell(position)), F.lit(False))
    return broken if field.name in spec.pk else broken & (F.col("_op") != "DELETE")


def _acceptable(spec: TableSpec, image: str = "_image") -> Column:
    """No required column is broken; NULL, like FALSE, means some is."""
    keys, others = F.lit(True), F.lit(True)
    for position, field in _must_decode(spec):
        sound = wire.is_sound(field, F.get(F.col(image), F.lit(position)))
        if field.name in spec.pk:
            keys = keys & sound
        else:
            others = others & sound
    return keys & ((F.col("_op") == "DELETE" if image == "_image" else F.lit(False)) | others)


def _project(rows: DataFrame, spec: TableSpec, keep: list[str], **how) -> DataFrame:
    """Decode over the stages of each column; a column not asked for is pruned at every stage."""
    first = {}
    for i, f in enumerate(spec.fields):
        form = wire.first_stage(f, _cell(i))
        if form is not None:
            first[i] = form.alias(f"_stage_{i}")
    rows = rows.select(*keep, "_image", *first.values())
    if any(f.kind in ("decimal", "varchar") for f in spec.fields):
        second = [
            wire.second_stage(spec.fields[i], _cell(i), F.col(f"_stage_{i}")).alias(f"_stage_{i}")
            for i in first
        ]
        rows = rows.select(*keep, "_image", *second)
    shape = spec.struct(**how)
    return rows.select(
        *keep,
        *[
            wire.value(f, _cell(i), F.col(f"_stage_{i}") if i in first else None, **how).alias(
                f.name, metadata=shape[f.name].metadata
            )
            for i, f in enumerate(spec.fields)
        ],
    )


def decode_images(rows: DataFrame, spec: TableSpec, **how) -> DataFrame:
    """Decode ``_image`` leniently: whatever does not decode is NULL.

    Keeps the other columns of ``rows``. ``binary_as`` ("hex" or "raw") and
    ``time_as`` ("micros" or "time") choose the stored form of those kinds.
    """
    return _project(rows, spec, [c for c in rows.columns if c != "_image"], **how)


def decode_records(rows: DataFrame, spec: TableSpec, **how) -> tuple[DataFrame, DataFrame]:
    """Split ``_op, _order, _image`` rows into decoded rows and rejects.

    The test for a reject looks at byte lengths and ranges, so the filter runs
    below the decode and only accepted rows are decoded. Rejects keep their
    image and name the first offending column and the reason: ``missing`` (no
    such column on the wire), ``empty`` (NULL on the wire) or ``malformed``.
    """
    good = _acceptable(spec)
    kept = rows.where(good & _whole(rows, spec))
    accepted = _project(kept, spec, [c for c in rows.columns if c not in ("_image", "_paired")], **how)
    return accepted, _rejected(rows, spec, good)


def _whole(rows: DataFrame, spec: TableSpec) -> Column:
    """The delete half of a key change only counts if the set half is acceptable."""
    if "_paired" not in rows.columns:
        return F.lit(True)
    return F.col("_paired").isNull() | F.coalesce(_acceptable(spec, "_paired"), F.lit(False))


def _bad(good: Column, misplaced: Column | None = None) -> Column:
    bad = ~F.coalesce(good, F.lit(False))
    return bad if misplaced is None else bad | misplaced.isNotNull()


def _rejected(rows: DataFrame, spec: TableSpec, good: Column, misplaced: Column | None = None) -> DataFrame:
    at, why = F.lit(None).cast("string"), F.lit(None).cast("string")
    for position, field in reversed(_must_decode(spec)):
        broken = _broken(spec, position, field)
        size = F.octet_length(_cell(position))
        reason = F.when(size.isNull(), "missing").when(size == 0, "empty").otherwise("malformed")
        at, why = F.when(broken, field.name).otherwise(at), F.when(broken, reason).otherwise(why)
    if misplaced is not None:
        why = F.coalesce(why, misplaced)
    return rows.where(_bad(good, misplaced)).drop("_paired").select("*", at.alias("reject_field"), why.alias("reject_reason"))


def decode_latest(
    feed: DataFrame, spec: TableSpec, since: int | None = None, **how
) -> tuple[DataFrame, DataFrame]:
    """Last event per key, decoded, and the rejects of the whole feed.

    Events without a ``total_order`` have no place in change order: they are
    rejected as ``no_order``, those with one below ``since`` as ``late``. Else the same rows as the last by order of
    ``decode_feed(.., split_key_changes=True)``, but only keys are decoded before the reduction; images are decoded once they
    have won, so a key changed a million times costs one decode.
    """
    return latest_events(feed, spec, since, **how), misfits(feed, spec, since)


def _misplaced(since: int | None) -> Column:
    place = F.col("_order.total_order")
    misplaced = F.when(place.isNull(), "no_order")
    return misplaced if since is None else misplaced.when(place < since, "late")


def misfits(feed: DataFrame, spec: TableSpec, since: int | None = None) -> DataFrame:
    """The rejects of ``decode_latest``."""
    return _rejected(record_images(feed, spec, split_key_changes=True), spec, _acceptable(spec), _misplaced(since))


def latest_events(
    feed: DataFrame, spec: TableSpec, since: int | None = None, refused: Observation | None = None, **how
) -> DataFrame:
    """The rows of ``decode_latest``. ``refused`` counts the rejects, as ``refused``, while they are computed."""
    images = record_images(feed, spec, split_key_changes=True)
    good, misplaced = _acceptable(spec), _misplaced(since)
    keys = [(i, f) for i, f in enumerate(spec.fields) if f.name in spec.pk]
    told = images if refused is None else images.observe(refused, F.count_if(_bad(good, misplaced)).alias("refused"))
    keyed = told.where(good & misplaced.isNull() & _whole(images, spec)).select(
        "_op", "_order", "_image", *[wire.value(f, _cell(i)).alias(f"_key_{i}") for i, f in keys]
    )
    latest = last_wins(keyed, [f"_key_{i}" for i, _ in keys], ["_order"])
    return _project(latest, spec, list(ENVELOPE), **how)


def decode_feed(
    feed: DataFrame, spec: TableSpec, split_key_changes: bool = False, **how
) -> tuple[DataFrame, DataFrame]:
    """Change events to ``(accepted rows, rejects)``; see ``decode_records``."""
    images = record_images(feed, spec, split_key_changes)
    return decode_records(images, spec, **how)
