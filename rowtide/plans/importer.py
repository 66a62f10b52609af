"""Bulk import of delimited files into keyed tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.catalog.spec import TableSpec
from rowtide.plans.table import KeyedTable
from rowtide.sources.files import detect_layout, list_tables, load_table


class Importer:
    """Import one or all tables of a source directory that have a spec."""

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        specs: dict[str, TableSpec],
        root: str,
        case_sensitive: bool = False,
        buckets: int = 16,
    ):
        self.spark = spark
        self.source = source
        self.root = root
        self.case_sensitive = case_sensitive
        self.buckets = buckets
        self.specs = specs if case_sensitive else {k.lower(): s for k, s in specs.items()}
        self.layout = detect_layout(spark, source)

    def _spec(self, table: str) -> TableSpec | None:
        return self.specs.get(table if self.case_sensitive else table.lower())

    def table(self, name: str) -> KeyedTable:
        return KeyedTable(self.spark, self.root, self._spec(name), self.buckets)

    def import_table(self, name: str, mode: str = "append") -> int:
        """Rows imported; 0 without a spec or without files. ``mode``: append or upsert.

        Rows whose key does not parse are written below the table as rejects. Of
        rows with one key, an upsert keeps the last in file order.
        """
        if mode not in ("append", "upsert"):
            raise ValueError(f"unknown import mode {mode!r}")
        spec = self._spec(name)
        if spec is None:
            return 0
        rows = load_table(self.spark, self.source, name, spec, self.layout, positions=mode == "upsert")
        if rows is None:
            return 0
        table = self.table(name)
        if not spec.pk:
            return self._stored(table, rows, mode)
        field = F.coalesce(*[F.when(F.col(f"`{k}`").isNull(), k) for k in spec.pk])
        # counted while the others are stored: the files are read again only if some row is refused
        seen = Observation()
        counted = rows.observe(seen, F.count_if(field.isNotNull()).alias("refused"))
        imported = self._stored(table, counted.where(field.isNull()), mode)
        refused = rows.select("*", field.alias("reject_field"), F.lit("no_key").alias("reject_reason"))
        if seen.get.get("refused"):
            refused = refused.where("reject_field IS NOT NULL")
        else:
            refused = self.spark.createDataFrame([], refused.schema)
        refused.write.parquet(f"{table.path}/rejects/run={uuid.uuid4().hex}")
        return imported

    def _stored(self, table: KeyedTable, rows: DataFrame, mode: str) -> int:
        if mode == "append":
            return table.append_counted(rows)
        return table.upsert_counted(rows, ["_at"])

    def import_all(self, mode: str = "append", parallel: int = 4) -> dict[str, int]:
        """Rows per table; tables without a spec are left out. ``parallel`` tables share the cluster."""
        found = list_tables(self.spark, self.source, self.layout)
        names = [n for n in found if self._spec(n) is not None]
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            return dict(zip(names, pool.map(lambda n: self.import_table(n, mode), names)))

    def summary(self, counts: dict[str, int]) -> DataFrame:
        return self.spark.createDataFrame(sorted(counts.items()), "table string, records bigint")
