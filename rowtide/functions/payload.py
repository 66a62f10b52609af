"""Result payloads: ``0x`` hex text to bytes, anything else unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _digits(payload: Column) -> Column:
    return F.regexp_replace(F.substring(payload, F.lit(3), F.length(payload)), "[ \\t\\n\\x0b\\f\\r]", "")


def is_hex(payload: Column) -> Column:
    return F.coalesce(F.startswith(payload, F.lit("0x")), F.lit(False))


def hex_bytes(payload: Column) -> Column:
    """Bytes behind ``0x``; NULL for other text and for broken hex."""
    digits = _digits(payload)
    whole = is_hex(payload) & (F.length(digits) % 2 == 0)
    return F.when(whole, F.try_to_binary(digits, F.lit("hex")))


def decode_payloads(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_bytes``, ``<column>_text`` (non-hex results) and ``<column>_broken``."""
    payload = F.col(column)
    data = hex_bytes(payload)
    return df.select(
        "*",
        data.alias(f"{column}_bytes"),
        F.when(~is_hex(payload), payload).alias(f"{column}_text"),
        (is_hex(payload) & data.isNull()).alias(f"{column}_broken"),
    )
