import json

import pytest
from pyspark.sql import types as T

from rowtide.catalog.benchmarks import CH_BENCHMARK, HYBENCH, SCHEMA_SETS
from rowtide.catalog.spec import FieldSpec, TableSpec, load_specs


def test_yaml_shapes(tmp_path):
    a = {"table_name": "a", "fields": [{"name": "x", "type": "int32"}]}
    b = {"table_name": "b", "pk": "y", "fields": [{"name": "y", "type": "int64", "nullable": False}]}
    shapes = {
        "one.json": b,
        "list.json": [a, b],
        "schemas.json": {"schemas": [a, b]},
        "tables.json": {"tables": {"a": a, "b": b}},
    }
    for name, raw in shapes.items():
        path = tmp_path / name
        path.write_text(json.dumps(raw))
        specs = load_specs(str(path))
        assert specs["b"].pk == ("y",)
        assert ("a" in specs) == (name != "one.json")
    yaml_path = tmp_path / "s.yaml"
    yaml_path.write_text("schemas:\n- table_name: A\n  fields:\n  - {name: x, type: int32}\n")
    assert list(load_specs(str(yaml_path), case_sensitive=False)) == ["a"]


def test_set_without_table_name_is_refused(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps([{"fields": [{"name": "x", "type": "int32"}]}]))
    with pytest.raises(ValueError):
        load_specs(str(path))
    path.write_text(json.dumps({"tables": [{"table_name": "a", "fields": []}]}))
    with pytest.raises(AttributeError):
        load_specs(str(path))


def test_key_metadata_order_and_nullability():
    with pytest.warns(UserWarning):
        spec = TableSpec.parse("d", "D_W_ID, d_id", "d_id int32!, d_w_id int32, d_name char(10)")
    assert spec.pk == ("d_w_id", "d_id") and spec.pk_made_required == ("d_w_id",)
    shape = spec.struct()
    assert shape["d_w_id"].metadata == {"primary_key": True, "primary_key_position": 1}
    assert shape["d_id"].metadata["primary_key_position"] == 2
    assert not shape["d_w_id"].nullable and not shape["d_name"].metadata


@pytest.mark.parametrize(
    "type_, stored",
    [
        ("byte", T.ByteType()),
        ("uint8", T.ShortType()),
        ("uint32", T.LongType()),
        ("uint64", T.DecimalType(20, 0)),
        ("bigint", T.LongType()),
        ("double", T.DoubleType()),
        ("varbinary", T.StringType()),
        ("time", T.LongType()),
        ("decimal", T.DecimalType(38, 10)),
        ("timestamp_with_tz", T.TimestampType()),
    ],
)
def test_stored_types(type_, stored):
    assert FieldSpec("x", type_).spark_type() == stored


def test_timestamp_matrix():
    ticks = {0: 1_000_000, 3: 1_000, 6: 1, 9: 1, None: 1_000, 5: 1_000}
    for precision, tick in ticks.items():
        assert FieldSpec("t", "timestamp", precision=precision).tick_micros == tick
    for zone, stored in ((None, T.TimestampType()), ("UTC", T.TimestampType()), ("-", T.TimestampNTZType())):
        assert FieldSpec("t", "timestamp", timezone=zone).spark_type() == stored


def test_unknown_and_complex_types_are_refused():
    for type_ in ("row", "map", "array", "interval"):
        with pytest.raises(ValueError):
            FieldSpec("x", type_)


def test_layout_checks():
    wrong = {n for n, s in CH_BENCHMARK.items() if not s.layout_agrees()}
    assert wrong == {"history", "order", "orderline", "item", "stock", "nation", "supplier"}
    assert CH_BENCHMARK["stock"].layout_end() == 406
    assert all(s.layout_agrees() for s in HYBENCH.values())
    spec = TableSpec("t", (FieldSpec("a", "int32"), FieldSpec("b", "char", size=3, offset=8), FieldSpec("c", "int8")))
    assert spec.layout() == [("a", 0, 4), ("b", 8, 3), ("c", 11, 1)]


def test_benchmark_sets():
    assert len(CH_BENCHMARK) == 12 and len(HYBENCH) == 8
    assert SCHEMA_SETS["tpch"] is CH_BENCHMARK
    assert CH_BENCHMARK["stock"].pk == ("s_w_id", "s_i_id")
    assert all(s.columns[-1] == "freshness_ts" for s in [*CH_BENCHMARK.values(), *HYBENCH.values()])


def test_infer(spark):
    shape = T.StructType.fromDDL("id bigint, at timestamp_ntz, p decimal(9,2)")
    spec = TableSpec.infer("t", shape, ["id"])
    assert spec.pk == ("id",) and not spec.field("at").zoned and spec.field("p").kind == "decimal"
    with pytest.raises(ValueError):
        TableSpec.infer("t", T.StructType.fromDDL("m map<string,int>"))
