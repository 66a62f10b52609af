"""Delimited files: layout detection, reading, typed loading."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.catalog.spec import TableSpec
from rowtide.functions import text
from rowtide.sources.storage import Storage

_CORRUPT = "_corrupt_record"

# Delimiter by file extension.
DELIMITERS = {"tbl": "|", "csv": ","}


@dataclass(frozen=True)
class Layout:
    """How a source directory is organised."""

    extension: str
    partitioned: bool

    @property
    def delimiter(self) -> str:
        return DELIMITERS[self.extension]


def _suffix(name: str, lower: bool = False) -> str:
    stem, dot, suffix = name.rpartition(".")
    return (suffix.lower() if lower else suffix) if dot and stem else ""


def _stem(name: str) -> str:
    return name.rpartition(".")[0] or name


def detect_layout(spark: SparkSession, source: str) -> Layout:
    """Root ``.tbl`` before root ``.csv`` before the first subdirectory with either."""
    storage = Storage(spark)
    if not storage.exists(source):
        raise FileNotFoundError(f"data source not found: {source}")
    if not storage.is_dir(source):
        raise ValueError(f"data source must be a directory: {source}")
    entries = storage.list(source)
    if not entries:
        raise ValueError(f"empty directory: {source}")
    endings = {_suffix(e.name, lower=True) for e in entries if not e.is_dir}
    for extension in DELIMITERS:
        if extension in endings:
            return Layout(extension, partitioned=False)
    for folder in (e for e in entries if e.is_dir):
        inside = {_suffix(e.name) for e in storage.list(folder.path) if not e.is_dir}
        for extension in DELIMITERS:
            if extension in inside:
                return Layout(extension, partitioned=True)
    raise ValueError(f"no .tbl or .csv data in {source}")


def list_tables(spark: SparkSession, source: str, layout: Layout) -> list[str]:
    """Names of the data sets in a source directory, sorted."""
    entries = Storage(spark).list(source)
    if layout.partitioned:
        return sorted(e.name for e in entries if e.is_dir)
    return sorted(
        _stem(e.name) for e in entries if not e.is_dir and _suffix(e.name) == layout.extension
    )


def table_files(spark: SparkSession, source: str, table: str, layout: Layout) -> list[tuple[str, int]]:
    """``(path, length)`` of a table's files; the name matches in any case. Empty if none."""
    storage = Storage(spark)
    entries = storage.list(source)
    if layout.partitioned:
        folder = next((e for e in entries if e.is_dir and e.name.lower() == table.lower()), None)
        found = storage.list(folder.path) if folder else []
        return [
            (e.path, e.length) for e in found if not e.is_dir and _suffix(e.name) == layout.extension
        ]
    for e in entries:
        named = not e.is_dir and _suffix(e.name) == layout.extension
        if named and _stem(e.name).lower() == table.lower():
            return [(e.path, e.length)]
    return []


def _single_quotes(record: Column) -> Column:
    """Without doubled quotes: they never open or close a field as a pair."""
    return F.replace(record, F.lit('""'), F.lit(""))


def field_count(record: Column, delimiter: str) -> Column:
    """Number of fields of a raw record; quotes count only at the start of a field."""
    d = re.escape(delimiter)
    quoted = F.regexp_replace(_single_quotes(record), rf'(^|{d})"[^"]*+"', "$1")
    plain = F.when(F.contains(record, F.lit('"')), quoted).otherwise(record)
    return F.length(plain) - F.length(F.replace(plain, F.lit(delimiter), F.lit(""))) + 1


def _ends_open(line: Column, delimiter: str) -> Column:
    """Is a quoted field still open at the end of a line that starts outside of one?"""
    d = re.escape(delimiter)
    one = rf'(?:"[^"]*+"[^{d}]*+|(?!")[^{d}]*+)'
    return F.contains(line, F.lit('"')) & ~_single_quotes(line).rlike(rf"(?s)^{one}(?:{d}{one})*+\z")


def open_quote_files(spark: SparkSession, paths: list[str], delimiter: str) -> list[str]:
    """Those of the files in which some quoted field is still open at the end of its line."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    broken = lines.where(_ends_open(F.col("value"), delimiter))
    # file names, of which the driver holds the whole list anyway
    found = {_plain_path(r["file"]) for r in broken.select("file").distinct().collect()}
    return [p for p in paths if _plain_path(p) in found]


# --- records with line breaks, read by many tasks ------------------------------
#
# A line starts outside or inside a quoted field. What it does to either state is
# known from the line alone, and so is, by composition, what a split does. The driver
# composes the splits (one row each) and tells every split the state it starts in and
# where the record that is open there began.

OUTSIDE, INSIDE = 0, 1


def _lines(spark: SparkSession, paths: list[str], delimiter: str) -> DataFrame:
    """Lines in order within a split, each with the state it leads to from either state."""
    rows = spark.read.option("lineSep", "\n").text(paths)
    value = F.col("value")
    return rows.select(
        value, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        _ends_open(value, delimiter).alias("from_outside"),
        F.when(F.contains(value, F.lit('"')), _ends_open(F.concat(F.lit('"x'), value), delimiter)).otherwise(True).alias("from_inside"),
    )


def _split_effects(lines: DataFrame) -> DataFrame:
    """Per split: the end state from either state, and whether an open field is closed in it."""

    def run(batches):
        effects: dict[tuple[str, int], list] = {}
        for batch in batches:
            quoted = batch[batch["from_outside"] | ~batch["from_inside"]]
            for file, block in batch[["file", "block"]].drop_duplicates().itertuples(index=False):
                effects.setdefault((file, block), [False, True, False])
            for file, block, *after in quoted[["file", "block", "from_outside", "from_inside"]].itertuples(index=False):
                effect = effects[file, block]
                effect[2] |= effect[1] and not after[1]
                effect[0], effect[1] = after[effect[0]], after[effect[1]]
        rows = [(f, b, *effect) for (f, b), effect in effects.items()]
        yield pd.DataFrame(rows, columns=["file", "block", "from_outside", "from_inside", "closes"])

    return lines.mapInPandas(run, "file string, block long, from_outside boolean, from_inside boolean, closes boolean")


def _split_starts(effects: list) -> dict[tuple[str, int], tuple[bool, int]]:
    """(file, block) -> does it start inside a field, and the block in which the open record began."""
    starts, state, origin, last = {}, False, 0, None
    for file, block, from_outside, from_inside, closes in sorted(effects):
        if file != last:
            state, last = False, file
        starts[file, block] = (state, origin)
        if not state or closes:
            origin = block  # whatever is open at its end began here
        state = from_inside if state else from_outside
    return starts


RECORDS = "record string, file string, block long, row long, origin long, part long"


def _records(lines: DataFrame, starts: dict[tuple[str, int], tuple[bool, int]]) -> DataFrame:
    """Records, and pieces of those that lie in several splits (``part`` 0 and up, joined by ``origin``)."""

    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches):
        held: list[str] = []
        place, row, state, origin = None, 0, False, None  # origin: where an open record of earlier splits began

        def piece(began: int | None):
            return "\n".join(held), *place, row, began, None if began is None else place[1]

        for batch in batches:
            out = []
            for value, file, block, *after in batch.itertuples(index=False):
                if (file, block) != place:
                    if held:
                        out.append(piece(place[1] if origin is None else origin))
                    held, place, row = [], (file, block), 0
                    state, origin = starts[place]
                    origin = origin if state else None
                held.append(value)
                state = after[state]
                if not state:
                    out.append(piece(origin))
                    held, origin, row = [], None, row + 1
            yield pd.DataFrame(out, columns=names, dtype=object)
        if held:
            yield pd.DataFrame([piece(place[1] if origin is None else origin)], columns=names, dtype=object)

    return lines.mapInPandas(run, RECORDS)


def read_records(spark: SparkSession, paths: list[str], delimiter: str) -> DataFrame:
    """``record`` and its place ``at``: whole records of files with quoted line breaks, read split by split.

    A record longer than a split is put together by one task, all others where
    they stand. Lines end with a line feed, before which a carriage return goes.
    """
    lines = _lines(spark, paths, delimiter)
    starts = _split_starts([tuple(r) for r in _split_effects(lines).collect()])
    rows = _records(lines, starts)
    at = F.struct("file", "block", "row").alias("at")
    alone = rows.where("part IS NULL").select("record", at)
    joined = rows.where("part IS NOT NULL").groupBy("file", "origin").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "record"))), lambda p: p["record"]), "\n").alias("record"),
        F.min(F.struct("file", "block", "row")).alias("at"),
    )
    whole = alone.unionByName(joined.select("record", "at"))
    return whole.select(F.regexp_replace("record", "\r\\z", "").alias("record"), "at").where(F.trim("record") != "")


def _plain_path(path: str) -> str:
    return re.sub("^file:/+", "/", unquote(path))


def read_delimited(
    spark: SparkSession,
    files: list[tuple[str, int]],
    width: int,
    delimiter: str,
    whole_files: bool | None = None,
    positions: bool = False,
) -> DataFrame:
    """Raw text cells ``c0 .. c<width-1>``; short records are skipped, extra cells ignored.

    A scan of the lines with quotes tells which files have quoted line breaks; their
    records are put together split by split (``read_records``), all other files
    go to the reader as they are. ``whole_files`` saves the scan: False says that no
    file has such breaks, True reads each file by one task. With ``positions`` a column ``_at`` orders the rows as they stand in the files.
    """
    names = [f"c{i}" for i in range(width)]
    paths = [path for path, _ in files]
    if whole_files:
        return _read_cells(spark, paths, names, delimiter, True, width, positions)
    broken = open_quote_files(spark, paths, delimiter) if whole_files is None else []
    plain = [p for p in paths if p not in set(broken)]
    parts = [_read_cells(spark, plain, names, delimiter, False, width, positions)] if plain else []
    if broken:
        parts.append(_record_cells(read_records(spark, broken, delimiter), names, delimiter, width, positions))
    return reduce(DataFrame.unionByName, parts)


def _record_cells(records: DataFrame, names: list[str], delimiter: str, width: int, positions: bool) -> DataFrame:
    schema = ", ".join(f"{n} string" for n in [*names, _CORRUPT])
    how = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _CORRUPT}
    cells = records.select(F.from_csv("record", schema, how).alias("cells"), "at").select("cells.*", F.col("at").alias("_at"))
    corrupt = F.col(_CORRUPT)
    rows = cells.where(corrupt.isNull() | (field_count(corrupt, delimiter) >= width))
    if not positions:
        return rows.select(*names)
    at = F.struct(F.col("_at.file").alias("file_path"), F.col("_at.block").alias("file_block_start"), F.col("_at.row"))
    return rows.select(*names, at.alias("_at"))


def _read_cells(
    spark: SparkSession, paths: list[str], names: list[str], delimiter: str, multiline: bool, width: int, positions: bool
) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(paths)
    )
    corrupt = F.col(_CORRUPT)
    complete = corrupt.isNull() | (field_count(corrupt, delimiter) >= width)
    # always true, but keeps a data column in the scan: Spark refuses to read the
    # corrupt-record column alone, as a bare count would
    parsed = F.octet_length(F.coalesce(F.col(names[0]), F.lit(""))) >= 0
    if positions:
        # within a task rows keep the order of the file
        row = F.monotonically_increasing_id().alias("row")
        at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), row)
        rows, names = rows.select("*", at.alias("_at")), [*names, "_at"]
    return rows.where(complete & parsed).select(*names)


def typed(cells: DataFrame, spec: TableSpec) -> DataFrame:
    """Text cells ``c0 ..`` as the columns of a spec."""
    shape = spec.struct()
    kept = [c for c in cells.columns if c == "_at"]
    cells = cells.select(
        *[text.trimmed(F.col(f"c{i}")).alias(f"c{i}") for i in range(len(spec.fields))], *kept
    )
    return cells.select(
        *kept,
        *[
            text.value(f, F.col(f"c{i}")).alias(f.name, metadata=shape[f.name].metadata)
            for i, f in enumerate(spec.fields)
        ]
    )


def load_table(
    spark: SparkSession,
    source: str,
    table: str,
    spec: TableSpec,
    layout: Layout | None = None,
    positions: bool = False,
) -> DataFrame | None:
    """One table of a source directory, typed by its spec; None when it has no files."""
    layout = layout or detect_layout(spark, source)
    files = table_files(spark, source, table, layout)
    if not files:
        return None
    cells = read_delimited(spark, files, len(spec.fields), layout.delimiter, positions=positions)
    return typed(cells, spec)
