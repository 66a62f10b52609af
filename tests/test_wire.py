import datetime as dt
import math
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide.catalog.spec import FieldSpec, TableSpec
from rowtide.functions import wire
from rowtide.functions.encode import encode
from rowtide.functions.payload import decode_payloads
from rowtide.operators.decode import decode_images, decode_records

NTZ = {"timezone": "-"}
VECTORS = [
    ("int8", {}, "80", -128),
    ("int16", {}, "FED4", -300),
    ("int32", {}, "FFFFFFFF", -1),
    ("int32", {}, "00000001", 1),
    ("int32", {}, "000001", None),
    ("int32", {}, "0000000109", 1),
    ("uint8", {}, "FF", 255),
    ("uint16", {}, "FFFE", 65534),
    ("uint32", {}, "01000000", 16777216),
    ("uint32", {}, "FFFFFFFF", 4294967295),
    ("int64", {}, "FFFFFFFFFFFFFFFE", -2),
    ("int64", {}, "8000000000000000", -(2**63)),
    ("uint64", {}, "FFFFFFFFFFFFFFFF", Decimal(18446744073709551615)),
    ("float32", {}, "3FC00000", 1.5),
    ("float32", {}, "43480000", 200.0),
    ("float32", {}, "42C80000", 100.0),
    ("float64", {}, "3FB999999999999A", 0.1),
    ("float64", {}, "3FB9999999", None),
    ("char", {"size": 10}, "68656C6C6F0000000000", "hello"),
    ("char", {"size": 3}, "68656C6C6F", "hel"),
    ("varchar", {}, "4142004344", "AB"),
    ("varchar", {}, "0041", ""),
    ("varchar", {}, "41FF42C3", "AB"),
    ("varchar", {}, "41FFEFBFBD42", "A�B"),
    ("char", {"size": 4}, "41422020", "AB  "),
    ("char", {"size": 2}, "41C3A9", "A"),
    ("char", {"charset": "latin-1", "size": 3}, "41E942", "AéB"),
    ("char", {"charset": "ascii", "size": 3}, "41E942", "AB"),
    ("char", {"charset": "gbk", "size": 4}, "C4E3BAC3", "你好"),
    ("char", {"charset": "gbk"}, "C4E300BAC3", "你"),
    ("bytes", {"size": 4}, "01020304", "01020304"),
    ("bytes", {"size": 2}, "ABCDEF", "abcd"),
    ("date", {}, "00004A31", dt.date(2022, 1, 1)),
    ("date", {}, "FFFFFFFF", dt.date(1969, 12, 31)),
    ("date", {}, "7FFFFFFF", None),
    ("date", {}, "80000000", None),
    ("date", {}, "FFF506C6", dt.date(1, 1, 1)),
    ("date", {}, "FFF506C5", None),
    ("time", {}, "02AF56FC", 45_045_500_000),
    ("time", {}, "FFFFFFFF", None),
    ("time", {}, "05265C00", None),
    ("timestamp", {"precision": 6, **NTZ}, "0005D480AC986240", dt.datetime(2022, 1, 1, 8, 0, 0, 123456)),
    ("timestamp", {"precision": 3, **NTZ}, "0005D480AC986240", dt.datetime(2022, 1, 1, 8, 0, 0, 123000)),
    ("timestamp", {"precision": 0, **NTZ}, "0005D480AC986240", dt.datetime(2022, 1, 1, 8)),
    ("timestamp", {"precision": 3, **NTZ}, "FFFFFFFFFFFFFFFF", dt.datetime(1969, 12, 31, 23, 59, 59, 999000)),
    ("timestamp", {**NTZ}, "7FFFFFFFFFFFFFFF", None),
    ("decimal", {}, "31322E3334", Decimal("12.34")),
    ("decimal", {}, "2031322E333420", Decimal("12.34")),
    ("decimal", {}, "3165320A", Decimal("100")),
    ("decimal", {"scale": 2}, "00BC614E", Decimal("123456.78")),
    ("decimal", {"scale": 2}, "FF439EB2", Decimal("-123456.78")),
    ("decimal", {"scale": 2}, "FF", Decimal("-0.01")),
    ("decimal", {}, "31", Decimal(1)),
    ("decimal", {"size": 4}, "3132", None),
    ("decimal", {"size": 2}, "31323334", Decimal(12)),
    ("decimal", {}, "4E614E", None),
    ("decimal", {}, "315F303030", None),
    ("decimal", {}, "FF" * 15 + "FE", Decimal(-2)),
    ("decimal", {}, "0001" + "00" * 8, Decimal(2**64)),
    ("decimal", {}, "7F" + "FF" * 15, None),
    ("decimal", {}, "00" * 17, None),
    ("decimal", {}, b"0.12345678901".hex(), None),
    ("decimal", {}, b"10e-11".hex(), Decimal("1e-10")),
    ("decimal", {}, b"1e-11".hex(), None),
    ("decimal", {}, b"-1.25E3".hex(), Decimal(-1250)),
    ("decimal", {}, b"0e-40".hex(), Decimal(0)),
    ("decimal", {}, b"1e40".hex(), None),
    ("decimal", {}, b"0.12345678900".hex(), Decimal("0.123456789")),
    ("boolean", {}, "00", False),
    ("boolean", {}, "01", True),
    ("boolean", {}, "7F00", True),
]


def test_golden_vectors(spark):
    """All vectors in one projection; every kind also gets an empty and a missing column."""
    fields = [FieldSpec(f"f{i}", type_, **how) for i, (type_, how, _, _) in enumerate(VECTORS)]
    full = [bytes.fromhex(h) for _, _, h, _ in VECTORS]
    empty = [b""] * len(VECTORS)
    images = spark.createDataFrame([(0, full), (1, empty), (2, [])], "n int, _image array<binary>")
    got = decode_images(images, TableSpec("v", tuple(fields))).orderBy("n").collect()
    for i, (type_, how, data, want) in enumerate(VECTORS):
        assert got[0][f"f{i}"] == want, (type_, how, data)
    assert set(got[1][1:]) == {None} and set(got[2][1:]) == {None}


def test_is_sound_agrees_with_value(spark):
    for type_, how, data, want in VECTORS:
        if type_ == "decimal" or want is None:
            field = FieldSpec("x", type_, **how)
            row = spark.createDataFrame([(bytes.fromhex(data),)], "b binary")
            assert row.select(wire.is_sound(field, F.col("b"))).first()[0] == (want is not None)


FLOATS = [0.0, -0.0, 1.5, -2.75, 5e-324, -2.2250738585072014e-308, 1.7976931348623157e308,
          2.2250738585072009e-308, 0.1, -1e-300, math.inf, -math.inf, math.nan, math.pi]


def _bits(x, fmt):
    return struct.pack(fmt, x)


@pytest.mark.parametrize("type_, fmt", [("float64", ">d"), ("float32", ">f")])
def test_floats_are_bit_exact(spark, type_, fmt):
    values = FLOATS
    if fmt == ">f":
        values = [0.0, -0.0, 1.5, 2**-149, -(2**-126), 3.4028234663852886e38, math.inf, -math.inf, math.nan,
                  struct.unpack(">f", struct.pack(">f", 0.1))[0]]
    field = FieldSpec("x", type_)
    rows = spark.createDataFrame([(i, [_bits(v, fmt)]) for i, v in enumerate(values)], "n int, _image array<binary>")
    got = [r["x"] for r in decode_images(rows, TableSpec("t", (field,))).orderBy("n").collect()]
    for want, have in zip(values, got):
        assert _bits(have, fmt) == _bits(want, fmt) or (math.isnan(want) and math.isnan(have))
    typed = spark.createDataFrame([(float(v),) for v in values], "x double")
    back = typed.select(encode(field, F.col("x"))).collect()
    for want, have in zip(values, back):
        assert bytes(have[0]) == _bits(want, fmt) or math.isnan(want)


def test_zoned_timestamp_is_the_instant(spark):
    field = FieldSpec("x", "timestamp", precision=6)
    rows = spark.createDataFrame([([bytes.fromhex("0005D480AC986240")],)], "_image array<binary>")
    out = decode_images(rows, TableSpec("t", (field,)))
    assert out.select(F.unix_micros("x")).first()[0] == 1641024000123456


def test_raw_binary_and_time_type(spark):
    spec = TableSpec("t", (FieldSpec("b", "bytes"), FieldSpec("t", "time")))
    rows = spark.createDataFrame([([b"\x01\xff", bytes.fromhex("02AF56FC")],)], "_image array<binary>")
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        row = decode_images(rows, spec, binary_as="raw", time_as="time").first()
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")
    assert bytes(row["b"]) == b"\x01\xff" and row["t"] == dt.time(12, 30, 45, 500000)


def test_rejects_name_field_and_reason(spark):
    spec = TableSpec.parse("t", "id", "id int32!, name char(4)!, note char(4)")
    order = (1, 0, 1)
    rows = [
        ("INSERT", order, [b"\0\0\0\1", b"ab", b""]),
        ("INSERT", order, [b"\0\0\0\2", b""]),
        ("INSERT", order, [b"\0\0\0"]),
        ("INSERT", order, [b"\0\0\0\4"]),
        ("DELETE", order, [b"\0\0\0\5"]),
        ("DELETE", order, [b""]),
    ]
    shape = (
        "_op string, _order struct<total_order:bigint,data_collection_order:bigint,step:int>, "
        "_image array<binary>"
    )
    good, bad = decode_records(spark.createDataFrame(rows, shape), spec)
    assert sorted((r["id"], r["name"], r["note"]) for r in good.collect()) == [(1, "ab", None), (5, None, None)]
    assert sorted((r["reject_field"], r["reject_reason"]) for r in bad.collect()) == [
        ("id", "empty"), ("id", "malformed"), ("name", "empty"), ("name", "missing")]


def test_payloads(spark):
    rows = spark.createDataFrame([("0x48656c6C6f",), ("0x",), ("plain",), ("0xABC",), ("0xZZ",), (None,), ("0xAB CD",)], "r string")
    got = [(None if r[1] is None else bytes(r[1]), r[2], r[3]) for r in decode_payloads(rows, "r").collect()]
    assert got == [(b"Hello", None, False), (b"", None, False), (None, "plain", False), (None, None, True),
                   (None, None, True), (None, None, False), (b"\xab\xcd", None, False)]


def test_numbers_beyond_their_cell(spark, tmp_path):
    from rowtide.plans.queries import QUERIES

    small, large = (spark.range(1).select(F.lit(n).cast("bigint").alias("n")) for n in (-32768, 32768))
    short = FieldSpec("x", "int16")
    assert bytes(small.select(encode(short, F.col("n"))).first()[0]) == b"\x80\x00"
    assert bytes(large.select(encode(FieldSpec("x", "uint16"), F.col("n"))).first()[0]) == b"\x80\x00"
    for rows, kind in ((large, short), (small, FieldSpec("x", "uint16")), (large, FieldSpec("x", "int8"))):
        with pytest.raises(Exception, match="does not fit"):
            rows.select(encode(kind, F.col("n"))).collect()
    # more suppliers than int16 has numbers
    rows = spark.sql("SELECT id l_orderkey, id l_partkey, id * 33069 l_suppkey, 1 l_linenumber FROM range(0, 4)")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.l_suppkey: r.i16 for r in QUERIES["decode_ints"](spark, str(tmp_path)).collect()}
    assert got == {n: 300 - n for n in (0, 33069, 66138, 99207)}
