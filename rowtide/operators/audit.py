"""Key and layout checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.catalog.spec import PK_FLAG, PK_POSITION, TableSpec


def key_marks(table: DataFrame) -> list[tuple[str, str, bool, int]]:
    """(field, type, nullable, key position) of the columns marked as key."""
    return [
        (f.name, f.dataType.simpleString(), f.nullable, int(f.metadata.get(PK_POSITION, 0)))
        for f in table.schema.fields
        if f.metadata.get(PK_FLAG)
    ]


def has_key_marks(table: DataFrame) -> bool:
    return bool(key_marks(table))


def pk_metadata_report(spark: SparkSession, table: DataFrame) -> DataFrame:
    return spark.createDataFrame(
        key_marks(table), "field string, type string, nullable boolean, position int"
    )


def pk_null_audit(table: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows, and NULLs per key column."""
    return table.agg(
        F.count(F.lit(1)).alias("records"),
        *[F.count_if(F.col(k).isNull()).alias(f"{k}_nulls") for k in pk],
    )


def pk_dup_audit(table: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return table.groupBy(*pk).agg(F.count(F.lit(1)).alias("records")).where("records > 1")


def layout_report(spark: SparkSession, specs: dict[str, TableSpec]) -> DataFrame:
    """Declared record size against the end of the field layout, per spec."""
    rows = [(n, s.record_size, s.layout_end(), s.layout_agrees()) for n, s in specs.items()]
    return spark.createDataFrame(rows, "table string, declared int, computed int, agrees boolean")
