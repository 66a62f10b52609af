"""Typed values from delimited text cells. Whatever does not parse is NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.catalog.spec import FieldSpec
from rowtide.functions.wire import BLANKS, exact_decimal

# Accepted date and timestamp texts; the time part is optional.
MOMENT = (
    r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"(\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,6})?)?$"
)
WHOLE_NUMBER = r"^[+-]?[0-9]+$"
GROUPED_DIGITS = r"^[+-]?[0-9]+(_[0-9]+)+$"
GROUPED_FLOAT = r"^[+-]?[0-9]+(_[0-9]+)*([.]([0-9]+(_[0-9]+)*)?)?([eE][+-]?[0-9]+(_[0-9]+)*)?$"
DAY_TIME = r"^[0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]{1,6})?)?$"


def trimmed(text: Column) -> Column:
    """Cell without surrounding whitespace."""
    return F.btrim(text, F.lit(BLANKS))


def cell(text: Column) -> Column:
    """Trimmed cell; blank is NULL."""
    return F.nullif(trimmed(text), F.lit(""))


def _ungrouped(text: Column, pattern: str) -> Column:
    return F.when(text.rlike(pattern), F.replace(text, F.lit("_"), F.lit("")))


def to_integer(text: Column, kind: T.DataType) -> Column:
    plain = F.when(F.contains(text, F.lit("_")), _ungrouped(text, GROUPED_DIGITS)).otherwise(text)
    if isinstance(kind, T.DecimalType):  # a cast to decimal would round fractions and read exponents
        plain = F.when(plain.rlike(WHOLE_NUMBER), plain)
    return plain.try_cast(kind)


def to_float(text: Column, kind: T.DataType) -> Column:
    """Decimal text, nan and inf; the type suffixes and hex form Java accepts are refused."""
    plain = (
        F.when(~text.rlike("[dDfFxX_]"), text)
        .when(text.rlike("(?i)^[+-]?inf(inity)?$"), text)
        .otherwise(_ungrouped(text, GROUPED_FLOAT))
    )
    return plain.try_cast(kind)


def to_boolean(text: Column) -> Column:
    """Whole numbers only: zero is false, anything else true."""
    return to_integer(text, T.DecimalType(38, 0)) != 0


def to_wall_clock(text: Column) -> Column:
    """Timestamp without zone from ``Y-m-d``, ``Y-m-d H:M:S`` or ``Y-m-d H:M:S.f``."""
    tidy = F.regexp_replace(F.when(text.rlike(MOMENT), text), r"\s+", " ")
    return tidy.try_cast(T.TimestampNTZType())


def to_date(text: Column) -> Column:
    return to_wall_clock(text).cast("date")


def to_timestamp(text: Column, tick: int = 1, zoned: bool = True) -> Column:
    """Timestamp floored to ``tick`` microseconds; zoned text is read as UTC."""
    moment = to_wall_clock(text)
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), moment)
    if tick == 1 and not zoned:
        return moment
    if tick != 1:
        micros = micros - F.pmod(micros, F.lit(tick))
    if zoned:
        return F.timestamp_micros(micros)
    return F.timestamp_add("MICROSECOND", micros, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def to_time_micros(text: Column) -> Column:
    """Time of day text as microseconds."""
    padded = F.concat(F.lit("1970-01-01 "), F.when(text.rlike(DAY_TIME), text))
    return F.timestamp_diff(
        "MICROSECOND",
        F.expr("timestamp_ntz'1970-01-01 00:00:00'"),
        padded.try_cast(T.TimestampNTZType()),
    )


def value(field: FieldSpec, text: Column) -> Column:
    """Typed value of a trimmed cell, in the field's stored type.

    The cell is referred to several times: trim it in a projection of its own.
    """
    kind, target = field.kind, field.spark_type()
    if kind in ("float32", "float64"):
        out = to_float(text, target)
    elif kind == "boolean":
        out = to_boolean(text)
    elif kind == "date":
        out = to_date(text)
    elif kind == "timestamp":
        out = to_timestamp(text, field.tick_micros, field.zoned)
    elif kind == "time":
        out = to_time_micros(text)
    elif kind == "decimal":
        out = exact_decimal(text)
    elif kind in ("varchar", "bytes"):
        out = F.nullif(text, F.lit(""))
    elif kind == "uint64":
        number = to_integer(text, T.DecimalType(20, 0))
        out = F.when(number.between(0, Decimal(2**64 - 1)), number)
    elif kind.startswith("u"):
        number = to_integer(text, T.LongType())
        out = F.when(number.between(0, 2 ** int(kind[4:]) - 1), number)
    else:
        out = to_integer(text, target)
    return out.cast(target)
