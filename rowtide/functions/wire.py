"""Decode one wire column (big-endian bytes) with native expressions.

Every decoder comes as a pair. ``is_sound`` tells from the bytes alone whether
they decode to a value; it is cheap enough to be pushed below the decode.
``value`` is the decoded column, NULL when the bytes are not sound.

Text, float and decimal values use intermediate forms several times, so they
are decoded over one or two ``stages`` that the caller projects one after the
other. Spark then evaluates each form once per value, and the generated code
stays small enough to be compiled.
"""

from __future__ import annotations

import codecs
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.catalog.spec import STORED_DECIMAL, WIDTHS, FieldSpec

# The ranges a decoded value must fall in (day number, millisecond
# of day, epoch microsecond), i.e. 0001-01-01 .. 9999-12-31.
DAY_RANGE = (-719162, 2932896)
MILLI_RANGE = (0, 86_399_999)
MICRO_RANGE = (-62_135_596_800_000_000, 253_402_300_799_999_999)

# Text forms of a decimal column.
NUMERIC_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
REFUSED_TEXT = r"(?i)^[+-]?(s?nan[0-9]*|inf(inity)?)$|^[0-9._e+-]*_[0-9._e+-]*$"

# Whitespace stripped from text cells (Unicode White_Space plus
# the four information separators).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_REPLACEMENT = "\ufffd"
_STAND_IN = "\ufdd0\ufdd1"  # noncharacters, reserved by Unicode for internal use

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


# --- integers ---------------------------------------------------------------


def unsigned(data: Column, width: int) -> Column:
    """First ``width`` bytes as an unsigned number; NULL when there are fewer."""
    digits = F.conv(F.hex(F.substring(data, 1, width)), 16, 10)
    number = digits.cast(T.DecimalType(20, 0) if width == 8 else T.LongType())
    return F.when(F.octet_length(data) >= width, number)


def signed(data: Column, width: int) -> Column:
    """First ``width`` bytes as a two's complement number; NULL when there are fewer."""
    if width == 8:
        number = F.conv(F.hex(F.substring(data, 1, 8)), 16, -10).cast("bigint")
    else:
        spare = 64 - 8 * width
        digits = F.conv(F.hex(F.substring(data, 1, width)), 16, 10)
        number = F.shiftright(F.shiftleft(digits.cast("bigint"), spare), spare)
    return F.when(F.octet_length(data) >= width, number)


# --- floats -----------------------------------------------------------------


def float32_from_bits(bits: Column) -> Column:
    """IEEE 754 single from its bits held in a bigint (0 .. 2^32-1)."""
    exponent = F.shiftright(bits, 23).bitwiseAND(0xFF)
    return _ieee(
        exponent, bits.bitwiseAND(0x7FFFFF), F.shiftright(bits, 31) == 1, 0xFF, 1 << 23, 150
    ).cast("float")


def float64_from_bits(bits: Column) -> Column:
    """IEEE 754 double from its bits held in a signed bigint."""
    exponent = F.shiftright(bits, 52).bitwiseAND(0x7FF)
    return _ieee(exponent, bits.bitwiseAND((1 << 52) - 1), bits < 0, 0x7FF, 1 << 52, 1075)


def _ieee(exponent, mantissa, negative, top, hidden, bias):
    whole = mantissa.cast("double")
    magnitude = (
        F.when(
            exponent == top,
            F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))),
        )
        .when(exponent == 0, whole * F.lit(2.0 ** (1 - bias)))
        .otherwise((whole + float(hidden)) * F.pow(F.lit(2.0), (exponent - bias).cast("double")))
    )
    return magnitude * F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))


# --- text -------------------------------------------------------------------


def repaired_utf8(text: Column) -> Column:
    """Text with undecodable bytes left out; a genuine U+FFFD stays."""
    kept = F.replace(text, F.lit(_REPLACEMENT), F.lit(_STAND_IN))
    dropped = F.replace(F.make_valid_utf8(kept), F.lit(_REPLACEMENT), F.lit(""))
    return F.replace(dropped, F.lit(_STAND_IN), F.lit(_REPLACEMENT))


def lenient_utf8(text: Column) -> Column:
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired_utf8(text))


def text_bytes(data: Column, size: int | None) -> Column:
    """Bytes of a text column: cut at ``size``, or at the first NUL when there is none."""
    if size is not None:
        return F.substring(data, 1, size)
    head = F.substring_index(data.cast("string"), "\0", 1)
    return F.substring(data, F.lit(1), F.octet_length(head))


def string_stage(data: Column, size: int | None, charset: str) -> Column:
    """Undecoded text; NULL when there are no bytes."""
    if codecs.lookup(charset).name != "utf-8":
        text = text_bytes(data, size)
    elif size is not None:
        text = F.substring(data, 1, size).cast("string")
    else:
        text = F.substring_index(data.cast("string"), "\0", 1)
    return F.when(F.octet_length(data) > 0, text)


def strip_nuls(text: Column) -> Column:
    """Text without trailing NULs.

    ``rtrim`` walks a padded char(n) buffer character by character, so it is
    kept for text with NULs inside; plain padding is compared in one piece.
    """
    nul = F.lit("\0")
    head = F.substring_index(text, "\0", 1)
    padding = F.repeat(nul, F.octet_length(text) - F.octet_length(head))
    return (
        F.when(~F.endswith(text, nul), text)
        .when(text == F.concat(head, padding), head)
        .otherwise(F.rtrim(text, nul))
    )


def string(staged: Column, charset: str = "utf-8") -> Column:
    """Decoded text of the second stage. Trailing NULs are stripped, blanks are kept."""
    codec = codecs.lookup(charset).name
    if codec == "utf-8":
        repaired = F.rtrim(repaired_utf8(staged), F.lit("\0"))
        return F.when(F.is_valid_utf8(staged), staged).otherwise(repaired)
    if codec == "iso8859-1":
        text = F.decode(staged, "ISO-8859-1")
    elif codec == "ascii":
        text = F.regexp_replace(F.decode(staged, "ISO-8859-1"), "[^\\x00-\\x7F]", "")
    else:
        text = _foreign_text(codec)(staged)
    return F.rtrim(text, F.lit("\0"))


def _foreign_text(codec: str):
    """Charsets Spark cannot decode go through Arrow batches."""

    def to_text(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode(codec, "ignore"))

    return F.pandas_udf(to_text, T.StringType())


def hex_text(data: Column, size: int | None = None) -> Column:
    """Bytes as lower-case hex, cut at ``size``; empty bytes are NULL."""
    cut = data if size is None else F.substring(data, 1, size)
    return F.when(F.octet_length(data) > 0, F.lower(F.hex(cut)))


# --- dates and times --------------------------------------------------------


def _within(data: Column, width: int, bounds: tuple[int, int]) -> Column:
    """Range check on the bytes: big-endian numbers of one sign order like their bytes."""
    low, high = bounds
    head = F.substring(data, 1, width)
    below = head <= F.lit(high.to_bytes(width, "big"))
    if low < 0:
        below = below | (head >= F.lit(low.to_bytes(width, "big", signed=True)))
    return (F.octet_length(data) >= width) & below


def date(data: Column) -> Column:
    days = signed(data, 4).cast("int")
    return F.when(_within(data, 4, DAY_RANGE), F.date_from_unix_date(days))


def time_micros(data: Column) -> Column:
    """Time of day in microseconds, from milliseconds on the wire."""
    return F.when(_within(data, 4, MILLI_RANGE), signed(data, 4) * 1000)


def micros_to_time(micros: Column) -> Column:
    """TIME value; needs ``spark.sql.timeType.enabled``."""
    minutes = F.floor(micros / 60_000_000)
    seconds = ((micros % 60_000_000) / F.lit(Decimal(1_000_000))).cast("decimal(16,6)")
    return F.make_time(F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"), seconds)


def epoch_micros(data: Column, tick: int = 1) -> Column:
    """Epoch microseconds, floored to ``tick`` microseconds."""
    micros = signed(data, 8)
    if tick != 1:
        micros = micros - F.pmod(micros, F.lit(tick))
    return F.when(_within(data, 8, MICRO_RANGE), micros)


def timestamp(data: Column, tick: int = 1, zoned: bool = True) -> Column:
    """Instant, or wall-clock timestamp when not zoned. Independent of the session zone."""
    micros = epoch_micros(data, tick)
    return F.timestamp_micros(micros) if zoned else ntz_from_micros(micros)


def ntz_from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def micros_from_ntz(moment: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), moment)


# --- decimals and booleans --------------------------------------------------


def decimal_text(data: Column, size: int | None) -> Column:
    """Trimmed text of a decimal column; NULL when empty or shorter than ``size``."""
    cut = data if size is None else F.substring(data, 1, size)
    enough = F.octet_length(data) >= max(size or 1, 1)
    return F.when(enough, F.btrim(lenient_utf8(cut.cast("string")), F.lit(BLANKS)))


def decimal_number(text: Column, data: Column, size: int | None, scale: int | None) -> Column:
    """Numeric text of a decimal column.

    The text itself if it is a number, else the bytes as a signed big-endian
    integer divided by 10^scale. NaN, infinities and grouped digits are refused.
    """
    cut = data if size is None else F.substring(data, 1, size)
    return (
        F.when(text.rlike(NUMERIC_TEXT), text)
        .when(text.isNull() | text.rlike(REFUSED_TEXT), F.lit(None).cast("string"))
        .otherwise(_scaled_integer(cut, scale or 0))
    )


def exact_decimal(number: Column) -> Column:
    """Numeric text as DECIMAL(38,10); NULL when it does not fit without rounding."""
    plain = number.rlike(r"^[+-]?[0-9]*[.]?[0-9]{0,10}0*$")
    return F.when(plain | (_decimals(number) <= 10), number).try_cast(STORED_DECIMAL)


def _decimals(number: Column) -> Column:
    """Digits needed after the point by a number in exponent form; NULL in plain form."""
    power = F.regexp_extract(number, "[eE]([+-]?[0-9]+)$", 1).try_cast("int")
    after_point = F.length(F.regexp_extract(number, "[.]([0-9]*)", 1))
    digits = F.regexp_replace(F.regexp_replace(number, "[eE].*$", ""), "[^0-9]", "")
    significant = F.rtrim(digits, F.lit("0"))
    zeros = F.length(digits) - F.length(significant)
    return F.when(power.isNotNull() & (significant == ""), 0).otherwise(after_point - zeros - power)


def _scaled_integer(raw: Column, scale: int) -> Column:
    """Signed integer of up to 16 bytes with a decimal point ``scale`` digits from the right."""
    fill = F.when(F.substring(F.hex(raw), 1, 1) >= "8", "F").otherwise("0")
    wide = F.lpad(F.hex(raw), 32, fill)
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast(T.DecimalType(20, 0))
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast(T.DecimalType(20, 0))
    shifted = F.try_multiply(high, F.lit(Decimal(2**64)).cast(T.DecimalType(20, 0)))
    whole = F.try_add(shifted, low).try_cast(T.DecimalType(38, 0)).cast("string")
    whole = F.when(F.octet_length(raw) <= 16, whole)
    if scale <= 0:
        return whole
    pattern = rf"^(-?)([0-9]*)([0-9]{{{scale}}})$"
    digits = F.lpad(F.replace(whole, F.lit("-"), F.lit("")), 38 + scale, "0")
    sign = F.when(F.startswith(whole, F.lit("-")), "-").otherwise("")
    return F.regexp_replace(F.concat(sign, digits), pattern, "$1$2.$3")


def boolean(data: Column) -> Column:
    return F.when(F.octet_length(data) > 0, F.substring(data, 1, 1) != F.lit(b"\0"))


# --- dispatch ---------------------------------------------------------------


def first_stage(field: FieldSpec, data: Column) -> Column | None:
    """First intermediate form, for the kinds that have one."""
    if field.kind == "float32":
        return unsigned(data, 4)
    if field.kind == "float64":
        return signed(data, 8)
    if field.kind == "varchar":
        return string_stage(data, field.size, field.charset)
    if field.kind == "decimal":
        return decimal_text(data, field.size)
    return None


def second_stage(field: FieldSpec, data: Column, first: Column) -> Column:
    """Second intermediate form; the first one again where there is no second."""
    if field.kind == "decimal":
        return decimal_number(first, data, field.size, field.scale)
    if field.kind == "varchar" and codecs.lookup(field.charset).name == "utf-8":
        return strip_nuls(first)
    return first


def is_sound(field: FieldSpec, data: Column) -> Column:
    """Whether the bytes decode to a value; NULL when there are no bytes."""
    kind = field.kind
    if kind in ("varchar", "bytes", "boolean"):
        sound = F.octet_length(data) > 0
    elif kind == "date":
        sound = _within(data, 4, DAY_RANGE)
    elif kind == "time":
        sound = _within(data, 4, MILLI_RANGE)
    elif kind == "timestamp":
        sound = _within(data, 8, MICRO_RANGE)
    elif kind == "decimal":
        number = decimal_number(decimal_text(data, field.size), data, field.size, field.scale)
        sound = exact_decimal(number).isNotNull()
    else:
        sound = F.octet_length(data) >= WIDTHS[kind]
    return sound


def value(
    field: FieldSpec,
    data: Column,
    staged: Column | None = None,
    binary_as: str = "hex",
    time_as: str = "micros",
) -> Column:
    """Decoded column in the field's stored type; NULL when the bytes are not sound."""
    kind = field.kind
    if staged is None:
        staged = first_stage(field, data)
        staged = staged if staged is None else second_stage(field, data, staged)
    if kind == "float32":
        out = float32_from_bits(staged)
    elif kind == "float64":
        out = float64_from_bits(staged)
    elif kind == "decimal":
        out = exact_decimal(staged)
    elif kind == "varchar":
        out = string(staged, field.charset)
    elif kind == "bytes":
        if binary_as == "raw":
            cut = data if field.size is None else F.substring(data, 1, field.size)
            out = F.when(F.octet_length(data) > 0, cut)
        else:
            out = hex_text(data, field.size)
    elif kind == "date":
        out = date(data)
    elif kind == "time":
        out = time_micros(data)
        if time_as == "time":
            out = micros_to_time(out)
    elif kind == "timestamp":
        out = timestamp(data, field.tick_micros, field.zoned)
    elif kind == "boolean":
        out = boolean(data)
    elif kind.startswith("u"):
        out = unsigned(data, WIDTHS[kind])
    else:
        out = signed(data, WIDTHS[kind])
    return out.cast(field.spark_type(binary_as, time_as))
