"""Encode typed columns as wire bytes, to land a feed from an existing table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.catalog.spec import WIDTHS, FieldSpec
from rowtide.functions.wire import micros_from_ntz


def integer_bytes(number: Column, width: int, signed: bool | None = None) -> Column:
    """Two's complement big-endian bytes of an integral column.

    A number that the signed or the unsigned kind of this width (None: both) cannot
    hold is an error: it would come back as another one.
    """
    whole = number.cast("bigint")
    digits = F.lpad(F.hex(whole), 16, "0")
    data = F.unhex(F.substring(digits, 17 - 2 * width, 2 * width))
    if width == 8:
        return data
    low = 0 if signed is False else -(1 << 8 * width - 1)
    high = 1 << 8 * width - bool(signed)
    beyond = (whole < low) | (whole >= high)
    told = F.concat(whole.cast("string"), F.lit(f" does not fit into {width} bytes"))
    return F.when(beyond, F.raise_error(told)).otherwise(data)


def float32_bytes(number: Column) -> Column:
    bits = F.reflect(F.lit("java.lang.Float"), F.lit("floatToRawIntBits"), number.cast("float"))
    return integer_bytes(bits.cast("int"), 4)


def float64_bytes(number: Column) -> Column:
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), number.cast("double"))
    return integer_bytes(bits.cast("bigint"), 8)


def encode(field: FieldSpec, column: Column) -> Column:
    """Wire bytes of a column; NULL becomes the empty byte string."""
    kind = field.kind
    if kind == "float32":
        data = float32_bytes(column)
    elif kind == "float64":
        data = float64_bytes(column)
    elif kind == "varchar":
        text = column.cast("string")
        if field.size is not None:
            # fixed-size text is padded with NULs, like a char(n) buffer
            text = F.rpad(text, field.size, "\0")
        data = text.cast("binary")
    elif kind == "bytes":
        data = column
    elif kind == "decimal":
        data = column.cast("string").cast("binary")
    elif kind == "date":
        data = integer_bytes(F.unix_date(column), 4)
    elif kind == "time":
        data = integer_bytes(column / 1000, 4)
    elif kind == "timestamp":
        micros = F.unix_micros(column) if field.zoned else micros_from_ntz(column)
        data = integer_bytes(micros, 8)
    elif kind == "boolean":
        data = integer_bytes(column.cast("int"), 1)
    else:
        data = integer_bytes(column, WIDTHS[kind], signed=not kind.startswith("u"))
    return F.when(column.isNull(), F.lit(b"")).otherwise(data)
