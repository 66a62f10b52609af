"""Declared table schemas and their Spark form.

A spec is driver-side metadata only. It says how many bytes a column takes on
the wire, which columns form the key (in key order), and which Spark type the
decoded value is stored as.
"""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from dataclasses import fields as dataclass_fields

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from rowtide.sources.storage import Storage

# Type names, the aliases the wire decoder accepts, default widths.
ALIASES = {
    "byte": "int8",
    "int": "int32",
    "bigint": "int64",
    "long": "int64",
    "float": "float32",
    "double": "float64",
    "char": "varchar",
    "string": "varchar",
    "binary": "bytes",
    "varbinary": "bytes",
    "timestamp_with_tz": "timestamp",
}
WIDTHS = {
    "int8": 1,
    "uint8": 1,
    "int16": 2,
    "uint16": 2,
    "int32": 4,
    "uint32": 4,
    "float32": 4,
    "int64": 8,
    "uint64": 8,
    "float64": 8,
    "date": 4,
    "time": 4,
    "timestamp": 8,
    "boolean": 1,
}
UNSUPPORTED = ("row", "map", "array")

STORED_DECIMAL = T.DecimalType(38, 10)

# Keys of the primary-key marks kept in StructField.metadata.
PK_FLAG = "primary_key"
PK_POSITION = "primary_key_position"

_PLAIN_TYPES = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "varchar": T.StringType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "decimal": STORED_DECIMAL,
}

_INFERRED = {
    T.ByteType: "int8",
    T.ShortType: "int16",
    T.IntegerType: "int32",
    T.LongType: "int64",
    T.FloatType: "float32",
    T.DoubleType: "float64",
    T.StringType: "varchar",
    T.DateType: "date",
    T.BooleanType: "boolean",
    T.TimestampType: "timestamp",
    T.TimestampNTZType: "timestamp",
}


@dataclass(frozen=True)
class FieldSpec:
    """One column: name, wire type and storage hints."""

    name: str
    type: str
    size: int | None = None
    nullable: bool = True
    precision: int | None = None
    scale: int | None = None
    charset: str = "utf-8"
    timezone: str | None = None
    offset: int | None = None

    def __post_init__(self):
        kind = self.kind
        if kind in UNSUPPORTED:
            raise ValueError(f"column {self.name!r}: type {self.type!r} has no wire form")
        if kind not in WIDTHS and kind not in ("varchar", "bytes", "decimal"):
            raise ValueError(f"column {self.name!r}: unknown type {self.type!r}")

    @property
    def kind(self) -> str:
        """Type name with aliases resolved."""
        lowered = self.type.lower()
        return ALIASES.get(lowered, lowered)

    @property
    def width(self) -> int:
        """Declared size in bytes, else the type's own width, else 0."""
        return self.size if self.size is not None else WIDTHS.get(self.kind, 0)

    @property
    def zoned(self) -> bool:
        """Timestamps are instants unless the zone is switched off with '-'."""
        return self.timezone != "-"

    @property
    def tick_micros(self) -> int:
        """Stored timestamp resolution in microseconds; milliseconds by default."""
        # Precision 0 = s, 3 = ms, 6 = us, 9 = ns (kept as us).
        return {0: 1_000_000, 3: 1_000, 6: 1, 9: 1}.get(self.precision, 1_000)

    def spark_type(self, binary_as: str = "hex", time_as: str = "micros") -> T.DataType:
        if self.kind == "bytes":
            return T.BinaryType() if binary_as == "raw" else T.StringType()
        if self.kind == "time":
            return T.TimeType(6) if time_as == "time" else T.LongType()
        if self.kind == "timestamp":
            return T.TimestampType() if self.zoned else T.TimestampNTZType()
        return _PLAIN_TYPES[self.kind]


@dataclass(frozen=True)
class TableSpec:
    """A table: ordered columns and an ordered primary key."""

    name: str | None
    fields: tuple[FieldSpec, ...]
    pk: tuple[str, ...] = ()
    record_size: int | None = None
    pk_made_required: tuple[str, ...] = field(default=(), compare=False)

    def __post_init__(self):
        known = {f.name.lower(): f for f in self.fields}
        pk = []
        for key in self.pk:
            if key.lower() not in known:
                raise ValueError(f"table {self.name!r}: key column {key!r} is not a field")
            pk.append(known[key.lower()].name)
        object.__setattr__(self, "pk", tuple(pk))
        # A key column cannot be null, whatever the declaration says.
        loose = tuple(k for k in pk if known[k.lower()].nullable)
        if loose:
            warnings.warn(f"table {self.name!r}: key columns {list(loose)} made not null", stacklevel=2)
            object.__setattr__(
                self,
                "fields",
                tuple(replace(f, nullable=False) if f.name in loose else f for f in self.fields),
            )
        object.__setattr__(self, "pk_made_required", loose)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> FieldSpec:
        return next(f for f in self.fields if f.name == name)

    def struct(self, binary_as: str = "hex", time_as: str = "micros") -> T.StructType:
        """Spark schema; key columns carry their flag and 1-based key position."""
        position = {k: i for i, k in enumerate(self.pk, 1)}
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    f.spark_type(binary_as, time_as),
                    f.nullable,
                    {PK_FLAG: True, PK_POSITION: position[f.name]} if f.name in position else None,
                )
                for f in self.fields
            ]
        )

    def layout(self) -> list[tuple[str, int, int]]:
        """(name, offset, size) per column; missing offsets follow the previous column."""
        end, rows = 0, []
        for f in self.fields:
            start = end if f.offset is None else f.offset
            rows.append((f.name, start, f.width))
            end = max(end, start + f.width)
        return rows

    def layout_end(self) -> int:
        return max((start + size for _, start, size in self.layout()), default=0)

    def layout_agrees(self) -> bool | None:
        """Whether the declared record size equals the computed end (None if undeclared)."""
        return None if self.record_size is None else self.record_size == self.layout_end()

    @classmethod
    def from_mapping(cls, raw: Mapping) -> TableSpec:
        """A schema as the files spell it; settings a column does not name keep their defaults."""
        known = {setting.name for setting in dataclass_fields(FieldSpec)}
        columns = (FieldSpec(**{k: v for k, v in column.items() if k in known}) for column in raw.get("fields", ()))
        key = next((raw[name] for name in ("pk", "primary_key") if raw.get(name)), ())
        return cls(raw.get("table_name"), tuple(columns), (key,) if isinstance(key, str) else tuple(key), raw.get("record_size"))

    @classmethod
    def infer(cls, name: str, schema: T.StructType, pk: Iterable[str] = ()) -> TableSpec:
        """Spec of an existing schema, for tables nobody declared."""
        fields = []
        for column in schema.fields:
            kind = column.dataType
            how = {"nullable": column.nullable and column.name not in pk}
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                zone = "-" if isinstance(kind, T.TimestampNTZType) else None
                how |= {"precision": 6, "timezone": zone}
            if isinstance(kind, T.DecimalType):
                type_ = "decimal"
            elif type(kind) in _INFERRED:
                type_ = _INFERRED[type(kind)]
            else:
                raise ValueError(f"column {column.name!r}: {kind.simpleString()} cannot be stored")
            fields.append(FieldSpec(column.name, type_, **how))
        return cls(name, tuple(fields), tuple(pk))

    @classmethod
    def parse(cls, name: str, pk: str, columns: str, record_size: int | None = None) -> TableSpec:
        """Short form: ``"id int32!, name char(10), ts timestamp(6)"``; ``!`` = not null."""
        fields = []
        for item in columns.split(","):
            match = _SHORT_FIELD.fullmatch(item.strip())
            if match is None:
                raise ValueError(f"table {name!r}: cannot read column {item.strip()!r}")
            column, type_, number, required = match.groups()
            sized = ALIASES.get(type_, type_) in ("varchar", "bytes", "decimal")
            fields.append(
                FieldSpec(
                    column,
                    type_,
                    size=int(number) if number and sized else None,
                    precision=int(number) if number and not sized else None,
                    nullable=not required,
                )
            )
        keys = tuple(k.strip() for k in pk.split(",") if k.strip())
        return cls(name, tuple(fields), keys, record_size)


_SHORT_FIELD = re.compile(r"(\w+) (\w+)(?:\((\d+)\))?(!?)")


def _schemas(content: Mapping | list) -> tuple[list[Mapping], bool]:
    """The schemas in the content of a file, and whether it is a set, whose members need names."""
    if isinstance(content, list):
        return content, True
    sets = {"schemas": list, "tables": lambda tables: list(tables.values())}
    name = next((n for n in sets if n in content and "fields" not in content), None)
    return ([content], False) if name is None else (sets[name](content[name]), True)


def load_specs(
    path: str, case_sensitive: bool = True, spark: SparkSession | None = None
) -> dict[str | None, TableSpec]:
    """Read a YAML or JSON schema file into ``{table name: spec}``.

    Accepts one schema with ``fields``, a list of schemas, a ``schemas:`` list
    and a ``tables:`` mapping. With ``case_sensitive=False`` names are lowered.
    Given a session, ``path`` may be on any file system Spark can open.
    """
    if spark is not None:
        text = Storage(spark).read_text(str(path))
    else:
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
    if str(path).endswith(".json"):
        raw = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as err:
            raise ImportError("reading YAML schemas needs PyYAML; JSON works without") from err
        raw = yaml.safe_load(text)

    schemas, named = _schemas(raw)
    specs: dict[str | None, TableSpec] = {}
    for spec in map(TableSpec.from_mapping, schemas):
        if named and spec.name is None:
            raise ValueError("each schema of a set needs a table_name")
        specs[spec.name if case_sensitive or not spec.name else spec.name.lower()] = spec
    return specs
