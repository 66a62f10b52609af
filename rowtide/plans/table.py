"""A keyed table kept as versioned Parquet.

Rows live in hash buckets of the key (partition directories). Every commit adds
one part and rewrites nothing: appended rows, changes applied in order, or a run of
upserts and deletes (``operators.runs``). What it writes does not grow with the
table. Reading settles the parts in the order they were committed. Parts are merged by
size: eight of one size become one of the next, so a changed byte is written
again a number of times that grows with the logarithm of the table.

Each version is one small JSON file: schema, key, buckets, and per part its
buckets, rows, bytes and key range; it names directories, never rows. A version is
committed by creating that file, which fails if another writer was first. A commit
depends on no rows it has not written itself, so the loser publishes the part it has
on top of the newer version; only a merge whose parts are gone is given up.

    <root>/<table>/data/rt_part=<id>/rt_bucket=<n>/*.parquet
    <root>/<table>/files/<id>/*.parquet        key range per file of merged parts
    <root>/<table>/versions/<number>.json
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.catalog.spec import TableSpec
from rowtide.operators import apply, mutate, runs, scan
from rowtide.operators.decode import decode_feed, latest_events, misfits
from rowtide.sources.storage import AlreadyExists, Storage

PART, BUCKET = "rt_part", "rt_bucket"

# Write attempts, and the pause between them in seconds, longer each time.
ATTEMPTS = 3
PAUSE = 0.2
# Failures that pass by themselves. Anything else is raised at once.
TRANSIENT = (
    "java.net.ConnectException",
    "java.net.SocketTimeoutException",
    "org.apache.hadoop.ipc.RetriableException",
    "org.apache.hadoop.ipc.StandbyException",
)
# Parts of one size that are merged into one of the next size, and the bytes of the smallest size.
FAN = 8
SMALLEST = 16 << 10
# Changes as large as the rows below them are merged into these once there are so many parts of them.
FOLD_AT = 4
# Bytes of a file of a merged part. One task sorts them, in some eight times the memory.
FILE_BYTES = 32 << 20
# Key values passed to the reader as a filter; more of them are only matched by a join.
PUSHED_KEYS = 1000

# What a part holds: rows, a run with changes, or changes in change order.
ROWS, RUN, ORDERED = "rows", "run", "ordered"


def is_retryable(err: Exception) -> bool:
    """Was another writer first, or does a Java cause belong to ``TRANSIENT``?"""
    cause = getattr(err, "java_exception", None)
    while cause is not None:
        if cause.getClass().getName() in TRANSIENT:
            return True
        cause = cause.getCause()
    return isinstance(err, AlreadyExists)


@dataclass(frozen=True)
class Part:
    """One commit's rows. ``seq`` is its place among the parts."""

    kind: str
    buckets: list[int]
    written: int  # buckets it was written with
    seq: int
    rows: int  # live ones; of changes, their number
    bytes: int
    low: list[str | None] = field(default_factory=list)  # least and greatest key values, as text
    high: list[str | None] = field(default_factory=list)
    ranged: bool = False  # has key ranges per file


@dataclass
class Version:
    """What one version consists of."""

    number: int
    buckets: int
    parts: dict[str, Part] = field(default_factory=dict)
    batches: dict[str, list[int]] = field(default_factory=dict)
    operation: str = "create"
    # The table's own schema (JSON) and key; versions before the first write have none.
    schema: str | None = None
    key: list[str] | None = None
    # How changes reach the table: "ordered" or "keyed"; None as long as rows were only appended.
    mode: str | None = None
    # Events with a smaller total_order are late; deletions below it are forgotten by merges.
    watermark: int | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Version:
        found = json.loads(text)
        found["parts"] = {name: Part(**part) for name, part in found["parts"].items()}
        return cls(**found)

    @property
    def deltas(self) -> list[str]:
        """Parts that hold changes, to be settled against the others."""
        return [name for name, part in self.parts.items() if part.kind != ROWS]

    def holding(self) -> dict[int, set[str]]:
        """The parts of each bucket."""
        found: dict[int, set[str]] = {}
        for name, part in self.parts.items():
            for b in part.buckets:
                found.setdefault(b, set()).add(name)
        return found

    def crowded(self, parts: int) -> set[int]:
        """Buckets that lie in more than ``parts`` parts, or in one with changes."""
        seen = Counter(b for part in self.parts.values() for b in part.buckets)
        return {b for name in self.deltas for b in self.parts[name].buckets} | {b for b, n in seen.items() if n > parts}

    def sharing(self, buckets: Iterable[int]) -> list[str]:
        """The parts with these buckets, and those that share any bucket with one of them."""
        wanted, found = set(buckets), set()
        while True:
            more = {n for n, p in self.parts.items() if n not in found and wanted.intersection(p.buckets)}
            if not more:
                return [n for n in self.parts if n in found]
            found |= more
            wanted.update(b for n in more for b in self.parts[n].buckets)

    def due(self) -> list[str]:
        """Neighbouring parts that have gathered and should become one; empty if there are none."""
        changes = self.deltas
        line = sorted(self.parts, key=lambda n: self.parts[n].seq)
        below = sum(p.bytes for p in self.parts.values() if p.kind == ROWS)
        if len(changes) >= FOLD_AT and sum(self.parts[n].bytes for n in changes) >= below > 0:
            return line
        if self.mode == "ordered":  # these settle among themselves, whatever rows lie between
            line = [n for n in line if n in changes]
        sizes = [size_class(self.parts[n].bytes) for n in line]
        for size in sorted(set(sizes), reverse=True):
            start = len(sizes)
            while start and sizes[start - 1] <= size:
                start -= 1
            if sizes[start:].count(size) >= FAN and any(n in changes for n in line[start:]):
                return line[start:]
        return []


def size_class(size: int) -> int:
    return max(0, math.floor(math.log(max(1, size) / SMALLEST, FAN)))


class KeyedTable:
    """One stored table of a spec. ``buckets`` is fixed when the table is created.

    Size the buckets for the table: a lookup opens whole buckets of parts not
    merged yet, so about 1 GB each keeps both its reads and the file count
    reasonable.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, buckets: int = 16):
        self.spark = spark
        self.spec = spec
        self.path = f"{root.rstrip('/')}/{(spec.name or 'table').lower()}"
        self._storage = Storage(spark)
        self._buckets = buckets

    @classmethod
    def open(cls, spark: SparkSession, root: str, name: str) -> KeyedTable:
        """An existing table with the schema and key it was stored with."""
        found = cls(spark, root, TableSpec(name, ())).version()
        if found is None or found.schema is None:
            raise ValueError(f"no table {name!r} at {root}")
        schema = T.StructType.fromJson(json.loads(found.schema))
        return cls(spark, root, TableSpec.infer(name, schema, found.key or ()), found.buckets)

    # --- versions -----------------------------------------------------------

    def versions(self) -> list[int]:
        folder = f"{self.path}/versions"
        if not self._storage.exists(folder):
            return []
        names = [e.name for e in self._storage.list(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def version(self, number: int | None = None) -> Version | None:
        known = self.versions()
        if number is None:
            number = known[-1] if known else None
        if number is None:
            return None
        if number not in known:
            raise ValueError(f"{self.path} has no version {number}")
        return Version.from_json(self._storage.read_text(self._version_file(number)))

    def _version_file(self, number: int) -> str:
        return f"{self.path}/versions/{number:010d}.json"

    def _table_schema(self, version: Version | None) -> T.StructType:
        """The stored schema; of a table not written yet, the spec's."""
        if version is None or version.schema is None:
            return self.spec.struct()
        return T.StructType.fromJson(json.loads(version.schema))

    def _check_key(self, version: Version) -> None:
        if version.key is not None and list(self.spec.pk) != version.key:
            raise ValueError(f"{self.path} has the key {version.key}, not {list(self.spec.pk)}")

    def _schema(self, version: Version | None) -> T.StructType:
        own = self._table_schema(version).fields
        return T.StructType(
            [
                *own,
                T.StructField("_order", apply.ORDER),
                T.StructField("_deleted", T.BooleanType()),
                T.StructField(runs.KIND, T.IntegerType()),
            ]
        )

    # --- reading ------------------------------------------------------------

    def _state(
        self,
        version: Version | None,
        parts: Iterable[str] | None = None,
        buckets: Iterable[int] | None = None,
        complete: bool = True,
        narrow: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        files: dict[str, list[str]] | None = None,
    ) -> DataFrame | None:
        """Rows of a version, or of some of its parts and buckets, settled; None when there are none.

        ``narrow`` may keep the rows of some keys only, it runs below everything
        else; ``files`` names the files to read of some parts. Without
        ``complete`` the parts become one part that has the effect of all of them.
        """
        if version is None:
            return None
        names = list(version.parts if parts is None else parts)
        wanted = None if buckets is None else set(buckets)
        key = version.key or list(self.spec.pk)
        kinds = {kind: [n for n in names if version.parts[n].kind == kind] for kind in (ROWS, RUN, ORDERED)}

        def read(names: list[str], condition: Column | None = None) -> DataFrame | None:
            rows = self._scan(version, names, wanted, files or {})
            return None if rows is None else narrow(rows if condition is None else rows.where(condition))

        kind = F.col(runs.KIND)
        last = max([version.parts[n].seq for n in kinds[RUN]], default=-1)
        newer = [n for n in kinds[ROWS] if version.parts[n].seq > last]
        rows = read(newer)
        rows = None if rows is None else rows.drop(runs.SEQ)
        if kinds[RUN]:
            older = [n for n in kinds[ROWS] if n not in newer]
            changes = read(kinds[RUN], kind != runs.ROW)
            plain = _union(read(older), read(kinds[RUN], kind == runs.ROW))
            if changes is not None:
                rows = _union(rows, runs.settle(plain, changes, key, complete))
        changes = read(kinds[ORDERED])
        if changes is None:
            return rows
        latest = mutate.last_wins(changes.drop(runs.SEQ), key, ["_order"])
        return latest if rows is None else apply.merge_changes(rows, latest, key)

    def _scan(
        self, version: Version, names: list[str], wanted: set[int] | None, files: dict[str, list[str]]
    ) -> DataFrame | None:
        data, paths = f"{self.path}/data", []
        for name in names:
            part = version.parts[name]
            picked = part.buckets if wanted is None else [b for b in part.buckets if b in wanted]
            if name in files:
                paths.extend(files[name])
            elif len(picked) == part.written:
                paths.append(f"{data}/{PART}={name}")
            else:
                paths.extend(f"{data}/{PART}={name}/{BUCKET}={b}" for b in picked)
        if not paths:
            return None
        schema = self._schema(version)
        full = self._schema(version).add(PART, T.StringType()).add(BUCKET, T.IntegerType())
        rows = self.spark.read.schema(full).option("basePath", data).parquet(*paths)
        places = F.create_map(*[F.lit(x) for n in names for x in (n, version.parts[n].seq)])
        return rows.select(
            *[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema.fields],
            places[F.col(PART)].cast("long").alias(runs.SEQ),
        )

    def _found(self, version: int | None) -> Version:
        found = self.version(version)
        if found is None:
            raise ValueError(f"no table at {self.path}")
        return found

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the current or of an older version."""
        return self._live(self._found(version))

    def _live(self, version: Version, **how) -> DataFrame:
        state = self._state(version, **how)
        if state is None:
            empty = self.spark.createDataFrame([], self._schema(version))
            state = how.get("narrow", lambda rows: rows)(empty.withColumn(runs.SEQ, F.lit(0).cast("long")))
            state = state.drop(runs.SEQ)
        return apply.live(state).drop(runs.KIND)

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of the given keys.

        Opens the buckets they hash to; of merged parts only the files whose key
        range holds one of them, and there the row groups that statistics and Bloom
        filters of the key columns leave. Keys are matched before parts are settled.
        """
        found = self._found(version)
        self._check_key(found)
        pk = self._pk("lookup")
        shape = self._table_schema(found)
        wanted = keys.select(*[F.col(f"`{k}`").cast(shape[k].dataType) for k in pk]).dropna().distinct()
        wanted = wanted.withColumn(BUCKET, self._bucket_of(found.buckets)).persist()
        try:
            # one row per bucket at most
            buckets = [r[0] for r in wanted.select(BUCKET).distinct().collect()]
            files = self._files_of(found, wanted, buckets)
            few = [tuple(r) for r in wanted.select(*pk).limit(PUSHED_KEYS + 1).collect()]
        finally:
            wanted.unpersist()
        pushed = F.lit(True)
        if len(few) <= PUSHED_KEYS:
            for k, values in zip(pk, zip(*few)):
                pushed = pushed & F.col(f"`{k}`").isin(list(set(values)))

        def narrow(rows: DataFrame) -> DataFrame:
            return rows.where(pushed).join(wanted.select(*pk), pk, "left_semi").select(*rows.columns)

        return self._live(found, buckets=buckets, narrow=narrow, files=files).select(*shape.names)

    def _files_of(self, version: Version, wanted: DataFrame, buckets: list[int]) -> dict[str, list[str]]:
        """Of merged parts the files whose key range holds a wanted key; the driver gets their names."""
        ranged = {n: f"{self.path}/files/{n}" for n, p in version.parts.items() if p.ranged}
        if not ranged:
            return {}
        pk = list(self.spec.pk)
        files = self.spark.read.parquet(*ranged.values()).where(F.col(BUCKET).isin(buckets))
        key = F.struct(*[F.col(f"`{k}`") for k in pk])
        held = wanted.select(F.col(BUCKET).alias("_in"), key.alias("_key"))
        hit = files.join(held, (F.col(BUCKET) == F.col("_in")) & (F.col("_key") >= F.col("low")) & (F.col("_key") <= F.col("high")))
        found: dict[str, list[str]] = {n: [] for n in ranged}
        for row in hit.select("part", "file").distinct().collect():
            found[row["part"]].append(row["file"])
        return found

    def query(
        self,
        where: str | Column | dict | None = None,
        columns: list[str] | None = None,
        order_by: str | list[Column | str] | None = None,
        limit: int | None = None,
        version: int | None = None,
    ) -> DataFrame:
        """Scan with a filter, chosen columns, an order and a limit.

        The filter is SQL text, a column or a dict of column values; a dict with all
        key columns goes the way of ``lookup``.
        """
        if isinstance(where, dict):
            shape = self._table_schema(self._found(version))
            given = self.spark.createDataFrame([tuple(where.values())], T.StructType([shape[c] for c in where]))
            if self.spec.pk and set(self.spec.pk) <= set(where):
                rows = self.lookup(given, version)
            else:
                rows = self.read(version)
            for name, cell in where.items():
                rows = rows.where(F.col(f"`{name}`") == F.lit(cell).cast(shape[name].dataType))
            return scan.scan(rows, None, columns, order_by, limit)
        return scan.scan(self.read(version), where, columns, order_by, limit)

    def count(self, version: int | None = None) -> int:
        """Rows of a version: from its own statistics, or, with changes not merged yet, by their keys."""
        found = self._found(version)
        if not found.deltas:
            return sum(part.rows for part in found.parts.values())
        key = found.key or list(self.spec.pk)
        thin = [*key, "_order", "_deleted", runs.KIND, runs.SEQ]
        return self._live(found, narrow=lambda rows: rows.select(*thin)).count()

    def key_ranges(self, version: int | None = None) -> dict[str, tuple]:
        """Least and greatest value per key column: from the version's statistics if nothing waits to be merged."""
        found = self._found(version)
        pk, shape = self._pk("key ranges"), self._table_schema(found)
        if found.deltas:
            ends = self._live(found, narrow=lambda rows: rows.select(*pk, "_order", "_deleted", runs.KIND, runs.SEQ)).agg(
                *[f(F.col(f"`{k}`")) for k in pk for f in (F.min, F.max)]
            )
        else:
            held = [p for p in found.parts.values() if p.rows]
            texts = self.spark.createDataFrame([(p.low, p.high) for p in held], "low array<string>, high array<string>")
            ends = texts.agg(
                *[f(F.col(c)[i].cast(shape[k].dataType)) for i, k in enumerate(pk) for f, c in ((F.min, "low"), (F.max, "high"))]
            )
        row = ends.first()
        return {k: (row[2 * i], row[2 * i + 1]) for i, k in enumerate(pk)}

    def info(self) -> dict | None:
        """Name, schema, row count and version; None when there is no table."""
        current = self.version()
        if current is None:
            return None
        return {
            "name": self.spec.name,
            "schema": self._table_schema(current).simpleString(),
            "record_count": self.count(current.number),
            "version": current.number,
        }

    # --- writing ------------------------------------------------------------

    def _bucket_of(self, buckets: int) -> Column:
        """The key's bucket; keys are hashed in the spec's types, which are the stored ones."""
        shape = self.spec.struct()
        names = self.spec.pk or tuple(self.spec.columns)
        keys = [F.col(f"`{k}`").cast(shape[k].dataType) for k in names]
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _write_part(self, rows: DataFrame, base: Version, kind: str, seq: int, merged: int | None = None) -> tuple[str, Part]:
        """Write rows as a new part, sorted by key in each file.

        The rebalance groups rows by bucket and lets adaptive execution split a
        bucket that is too large for one task, whatever its keys look like. A
        merged part (of ``merged`` bytes) is dealt by ranges of bucket and key
        instead, so that its files have key ranges of their own.
        """
        name = uuid.uuid4().hex
        target = f"{self.path}/data/{PART}={name}"
        pk = [f"`{k}`" for k in self.spec.pk]
        rows = rows if runs.KIND in rows.columns else runs.plain(rows)
        rows = mutate.conform(apply.as_state(rows), self._schema(base)).withColumn("_deleted", F.coalesce("_deleted", F.lit(False)))
        seen = Observation()
        counted = F.count(F.lit(1)) if kind != ROWS else F.count_if(~F.col("_deleted"))
        ends = [f(F.col(k)).cast("string").alias(f"{e}{i}") for i, k in enumerate(pk) for f, e in ((F.min, "low"), (F.max, "high"))]
        rows = rows.withColumn(BUCKET, self._bucket_of(base.buckets))
        if merged is None:
            dealt = rows.hint("rebalance", BUCKET)
        else:
            dealt = rows.repartitionByRange(max(1, math.ceil(merged / FILE_BYTES)), BUCKET, *pk)
        # counted after the exchange: what lies below it is run once more to find the ranges
        dealt = dealt.observe(seen, counted.alias("rows"), *ends)
        writer = dealt.sortWithinPartitions(BUCKET, *pk).write.partitionBy(BUCKET)
        if kind == ROWS:  # parts of changes are small
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
            for k in self.spec.pk:
                writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer.parquet(target)
        prefix = f"{BUCKET}="
        names = [e.name for e in self._storage.list(target)] if self._storage.exists(target) else []
        buckets = sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))
        told = seen.get if buckets else {}
        size = self._storage.size(target) if buckets else 0
        low, high = ([told.get(f"{e}{i}") for i in range(len(pk))] for e in ("low", "high"))
        part = Part(kind, buckets, len(buckets), seq, told.get("rows", 0), size, low, high, merged is not None and bool(buckets))
        if part.ranged:
            self._ranges(name, target).write.parquet(f"{self.path}/files/{name}")
        return name, part

    def _ranges(self, name: str, target: str) -> DataFrame:
        """Key range per file: its first and its last row, as files are sorted by key.

        Only their number is aggregated; a minimum of whole keys would sort all rows with their file's path.
        """
        key = F.struct(*[F.col(f"`{k}`") for k in self.spec.pk])
        rows = self.spark.read.parquet(target)
        place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "row_index")]
        last = rows.select(*place).groupBy("file_path").agg(F.max("row_index").alias("row_index"))
        low = rows.select(*place, BUCKET, key.alias("low")).where("row_index = 0").drop("row_index")
        high = rows.select(*place, key.alias("high")).join(F.broadcast(last), ["file_path", "row_index"]).drop("row_index")
        ranges = low.join(high, "file_path").withColumnRenamed("file_path", "file")
        return ranges.select(F.lit(name).alias("part"), BUCKET, "file", "low", "high")

    def _commit(
        self,
        operation: str,
        rows: Callable[[Version], DataFrame | None],
        kind: str = ROWS,
        *,
        batch: tuple[str, int | list[int]] | None = None,
        mode: str | None = None,
        overwrite: bool = False,
        merges: list[str] | None = None,
        watermark: int | None = None,
        made_parts: list[Part] | None = None,
    ) -> Version:
        """Write ``rows`` as a part and publish it; ``merges``: in place of these parts.

        ``rows`` sees the version it is written against, but for its buckets,
        schema and watermark it must not depend on it. Each part written is added to ``made_parts``.
        """
        pending: tuple[tuple, tuple[str, Part] | None] | None = None
        number = None if batch is None else [batch[1]] if isinstance(batch[1], int) else list(batch[1])
        for attempt in range(1, ATTEMPTS + 1):
            base = self.version() or Version(0, self._buckets)
            self._check_key(base)
            if batch and base.batches.get(batch[0], [-1]) >= number:
                return base
            if mode and base.mode and base.mode != mode and not overwrite:
                raise ValueError(f"{self.path} takes {base.mode} changes, not {mode} ones")
            if merges is not None and not all(n in base.parts for n in merges):
                return base  # another writer has merged or replaced them
            try:
                shape = (base.buckets, base.schema, base.watermark)
                if pending is None or pending[0] != shape:
                    made = rows(base)
                    size = None if merges is None else sum(base.parts[n].bytes for n in merges)
                    pending = shape, None if made is None else self._write_part(made, base, kind, 0, size)
                    if made_parts is not None and pending[1] is not None:
                        made_parts.append(pending[1][1])
                gone = set(base.parts) if overwrite else set(merges or ())
                parts = {n: p for n, p in base.parts.items() if n not in gone}
                if pending[1] is not None and pending[1][1].buckets:
                    name, part = pending[1]
                    # a merged part stands where its last part stood
                    seq = base.number + 1 if merges is None else max(base.parts[n].seq for n in merges)
                    parts[name] = replace(part, seq=seq)
                new = Version(
                    base.number + 1,
                    base.buckets,
                    parts,
                    {**base.batches, **({batch[0]: number} if batch else {})},
                    operation,
                    self._table_schema(base).json(),
                    list(self.spec.pk),
                    (None if overwrite else base.mode) or mode,
                    max([w for w in (base.watermark, watermark) if w is not None], default=None),
                )
                self._storage.create_text(self._version_file(new.number), new.to_json())
                return new
            except Exception as err:
                if attempt == ATTEMPTS or not is_retryable(err):
                    raise
                time.sleep(PAUSE * attempt)
        raise AssertionError("unreachable")

    def _merge(self, names: list[str]) -> Version:
        """Make one part of neighbouring ones; of all parts of their buckets, plain rows."""
        current = self.version()
        held = {b for n in names for b in current.parts[n].buckets}
        whole = not any(held.intersection(p.buckets) for n, p in current.parts.items() if n not in names)
        kinds = {current.parts[n].kind for n in names}
        kind = ROWS if whole or kinds == {ROWS} else ORDERED if kinds == {ORDERED} else RUN

        def rows(base: Version) -> DataFrame | None:
            state = self._state(base, names, complete=kind == ROWS)
            if state is not None and kind == ROWS and base.watermark is not None:
                forgotten = F.col("_deleted") & (F.col("_order.total_order") < base.watermark)
                state = state.where(~F.coalesce(forgotten, F.lit(False)))
            return state

        return self._commit("layout", rows, kind, merges=names)

    def _tidy(self) -> None:
        """Merge what has gathered, as often as merging leaves something to merge."""
        while names := self.version().due():
            before = self.version().number
            if self._merge(names).number == before:
                return

    def append(self, rows: DataFrame) -> Version:
        """Add rows without a key check."""
        return self._commit("append", lambda base: rows)

    def append_counted(self, rows: DataFrame) -> int:
        """Append and return the number of rows, counted while they are written."""
        seen = Observation()
        self.append(rows.observe(seen, F.count(F.lit(1)).alias("n")))
        return seen.get["n"]

    def overwrite(self, rows: DataFrame) -> Version:
        """Replace the whole content."""
        return self._commit("overwrite", lambda base: rows, overwrite=True)

    def upsert(self, rows: DataFrame, order: list[str] | None = None) -> Version:
        """Keyed upsert; of several source rows with one key the last by ``order`` counts.

        Without an order the greatest row counts. Writes the source's rows only.
        """
        return self._upsert(rows, order)

    def upsert_counted(self, rows: DataFrame, order: list[str]) -> int:
        """Upsert and return the number of rows left to apply, counted on the way."""
        seen = Observation()
        self._upsert(rows, order, seen)
        return seen.get["n"]

    def _upsert(self, rows: DataFrame, order: list[str] | None, seen: Observation | None = None) -> Version:
        pk = self._pk("upsert")

        def run(base: Version) -> DataFrame:
            shape = self._table_schema(base)
            source = rows if order else mutate.conform(rows, shape)
            source = mutate.conform(mutate.last_wins(source, pk, order or []), shape)
            return runs.upserts(source if seen is None else source.observe(seen, F.count(F.lit(1)).alias("n")), pk)

        return self._change("upsert", run)

    def delete(self, keys_of: DataFrame) -> Version:
        """Remove the rows whose key occurs in ``keys_of``; writes the keys only."""
        pk = self._pk("delete")
        if not self.exists():
            raise ValueError(f"no table at {self.path}")
        return self._change("delete", lambda base: runs.deletes(keys_of, pk))

    def _change(self, operation: str, run: Callable[[Version], DataFrame], batch=None) -> Version:
        done = self._commit(operation, run, RUN, batch=batch, mode="keyed")
        self._tidy()
        return done

    def apply_ordered(self, events: DataFrame, batch: tuple[str, int | list[int]] | None = None) -> Version:
        """Apply decoded events in change order; late ones lose against what is stored.

        Events with a NULL in their key or below the watermark are left out.
        """
        pk = self._pk("apply")
        keyed = events.where(runs.with_key(pk))

        def changes(base: Version) -> DataFrame:
            timely = F.lit(True) if base.watermark is None else F.col("_order.total_order") >= base.watermark
            return apply.latest_changes(keyed.where(timely), pk)

        return self._apply_changes(changes, batch)

    def _apply_changes(self, changes: Callable[[Version], DataFrame], batch, made_parts: list[Part] | None = None) -> Version:
        self._pk("apply")
        done = self._commit("apply_ordered", changes, ORDERED, batch=batch, mode="ordered", made_parts=made_parts)
        self._tidy()
        return done

    def apply_grouped(self, events: DataFrame, batch: tuple[str, int | list[int]] | None = None) -> Version:
        """Apply decoded events as append, upsert, delete; writes what the batch does to each key."""
        pk = self._pk("apply")
        return self._change("apply_grouped", lambda base: runs.grouped(events, pk), batch)

    def apply_feed(
        self, feed: DataFrame, mode: str = "ordered", batch: tuple[str, int | list[int]] | None = None
    ) -> DataFrame:
        """Decode change events and apply them; returns the rejected ones.

        In change order they are counted while the others are written; without any, nothing is read again.
        """
        self._pk("apply")
        if mode == "ordered":
            current = self.version()
            since = [None if current is None else current.watermark]
            seen: list[Observation] = []
            parts: list[Part] = []

            def changes(base: Version) -> DataFrame:
                since.append(base.watermark)
                seen.append(Observation())
                return apply.as_changes(latest_events(feed, self.spec, base.watermark, seen[-1]))

            self._apply_changes(changes, batch, parts)
            rejects = misfits(feed, self.spec, since[-1])
            # a batch applied before, or one that has left no row, has not counted them
            counted = len(parts) == len(seen) and parts and parts[-1].buckets
            return rejects.where(F.lit(False)) if counted and not seen[-1].get["refused"] else rejects
        if mode == "grouped":
            events, rejects = decode_feed(feed, self.spec)
            events = events.persist()
            try:
                self.apply_grouped(events, batch)
            finally:
                events.unpersist()
            return rejects
        raise ValueError(f"unknown apply mode {mode!r}")

    def advance_watermark(self, total_order: int) -> Version:
        """From now on events below ``total_order`` are late.

        They are rejected, and merges of whole buckets forget deletions below it.
        The watermark never goes back.
        """
        return self._commit("watermark", lambda base: None, mode="ordered", watermark=total_order)

    def ensure_key_layout(self, parts: int = 1) -> int:
        """Bring buckets with more than ``parts`` parts or with changes into one, sorted by key; returns how many."""
        current = self.version()
        if not self.spec.pk or current is None:
            return 0
        crowded = current.crowded(parts)
        if crowded:
            self._merge(current.sharing(crowded))
        return len(crowded)

    def audit_keys(self) -> DataFrame:
        """Keys that occur more than once, with their number of rows, as of the current version.

        The result is kept with the version it covers. The next audit reads only
        buckets whose parts have changed since.
        """
        pk, current = self._pk("a key audit"), self._found(None)
        folder, keyed = f"{self.path}/audits", [f"`{k}`" for k in self.spec.pk]
        target = f"{folder}/{current.number:010d}"
        audited = [int(e.name) for e in self._storage.list(folder)] if self._storage.exists(folder) else []
        known = [n for n in audited if n in self.versions() and self._storage.exists(f"{folder}/{n:010d}/_SUCCESS")]
        shape = self.spark.createDataFrame([], T.StructType([self._table_schema(current)[k] for k in pk]))
        shape = shape.select("*", F.lit(0).cast("long").alias("records"), F.lit(0).alias(BUCKET)).schema
        if current.number not in known:
            before = self.version(max(known)).holding() if known else {}
            now = current.holding()
            changed = [b for b in now if now[b] != before.get(b)]
            rows = self._live(current, buckets=changed).groupBy(*keyed).agg(F.count(F.lit(1)).alias("records"))
            found = rows.where("records > 1").withColumn(BUCKET, self._bucket_of(current.buckets))
            if known:
                kept = self.spark.read.schema(shape).parquet(f"{folder}/{max(known):010d}")
                found = found.unionByName(kept.where(F.col(BUCKET).isin([b for b in now if now[b] == before.get(b)])))
            found.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(shape).parquet(target).drop(BUCKET)

    def expire(self, keep: int) -> int:
        """Drop all but the last ``keep`` versions and the parts only they hold; returns how many.

        Parts no version names (a lost attempt, or a write under way) are left.
        """
        known = self.versions()
        old = known[: max(0, len(known) - max(1, keep))]
        needed = {p for n in known[len(old) :] for p in self.version(n).parts}
        gone = {p for n in old for p in self.version(n).parts} - needed
        for number in old:
            self._storage.delete(self._version_file(number))
        for part in gone:
            self._storage.delete(f"{self.path}/data/{PART}={part}")
            self._storage.delete(f"{self.path}/files/{part}")
        return len(old)

    def _pk(self, action: str) -> list[str]:
        return mutate.key_columns(self.spec.pk, action)


def _union(*frames: DataFrame | None) -> DataFrame | None:
    found = [f for f in frames if f is not None]
    return None if not found else found[0] if len(found) == 1 else found[0].unionByName(found[1])
