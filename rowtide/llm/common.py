"""Helpers the operators share: landed tables, safe column names, Bloom filters, components."""

from __future__ import annotations

import gc
import math
import os
import tempfile
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.storage import scratch_dir

# Rows and bytes an Arrow batch may hold: long texts must not pile up in one batch.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the Python stages rely on for bounded memory; sends this package to the workers."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def _ship(spark: SparkSession) -> None:
    """Add the package to the Python files of the session, once, as ``--py-files`` would."""
    context, archive = spark.sparkContext, "rowtide_workers.zip"
    if any(os.path.basename(f) == archive for f in context._python_includes):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="rowtide-"), archive)
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)


def land(rows: DataFrame, label: str) -> DataFrame:
    """Write rows below ``spark.checkpoint.dir`` and read them back: cuts lineage, survives executors."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames nobody refers to any more, on all executors.

    They otherwise stay until the driver happens to collect its garbage.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(rows: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``rows`` does not have yet."""
    taken = {c.lower() for c in rows.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_place(docs: DataFrame, id_col: str, place: str) -> DataFrame:
    """``docs`` with a column that tells its rows apart: the id, or a number from a landed copy if ids repeat or are null."""
    told = docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1)).isEmpty()
    if told:
        return docs.withColumn(place, F.col(id_col))
    return land(docs.withColumn(place, F.monotonically_increasing_id()), "documents")


# --- Bloom filters ------------------------------------------------------------

PROBES = 4
# 64-bit words of a filter that reach the driver together.
BLOOM_BLOCK = 1 << 13


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, over unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bloom_positions(hashes: np.ndarray, bits: int, probes: int = PROBES, salt: int = 0) -> np.ndarray:
    """Bit positions, one row per probe; ``bits`` is a power of two."""
    h = hashes.astype(np.int64).view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    first = _mix(h)
    second = _mix(first ^ np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    steps = np.arange(probes, dtype=np.uint64)[:, None]
    return (first + steps * second) & np.uint64(bits - 1)


def bloom_build(
    keys: DataFrame, count: int, bits_per_key: int, max_bits: int, probes: int = PROBES, salt: int = 0
) -> np.ndarray:
    """A filter over the single long column of ``keys`` as an array of 64-bit words.

    Its size follows ``count`` up to ``max_bits``; the driver receives at most
    ``max_bits / 64`` words, however many keys there are. A fuller filter lets
    more other keys pass, never fewer listed ones.
    """
    wanted = max(1, count) * bits_per_key
    bits = min(max_bits, 1 << max(10, math.ceil(math.log2(wanted))))

    def words(batches):
        for batch in batches:
            at = bloom_positions(batch.iloc[:, 0].to_numpy(), bits, probes, salt).ravel()
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(word, kind="stable")
            word, bit = word[order], bit[order]
            if len(word):
                start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                yield pd.DataFrame({"word": word[start], "bits": np.bitwise_or.reduceat(bit, start).view(np.int64)})

    def packed(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros(BLOOM_BLOCK, np.int64)
        block[own["word"].to_numpy() % BLOOM_BLOCK] = own["bits"].to_numpy()
        return pd.DataFrame({"block": [key[0]], "words": [block.tobytes()]})

    table = keys.mapInPandas(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # the driver receives blocks of bytes, no row per word
    blocks = table.groupBy(F.floor(F.col("word") / BLOOM_BLOCK).alias("block")).applyInPandas(packed, "block long, words binary")
    out = np.zeros(-(-bits // 64 // BLOOM_BLOCK) * BLOOM_BLOCK, dtype=np.uint64)
    for block, part in blocks.collect():
        out[block * BLOOM_BLOCK : (block + 1) * BLOOM_BLOCK] = np.frombuffer(part, np.uint64)
    out = out[: bits // 64]
    return out


def bloom_has(words: np.ndarray, hashes: np.ndarray, probes: int = PROBES, salt: int = 0) -> np.ndarray:
    at = bloom_positions(hashes, len(words) * 64, probes, salt)
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def bloom_test(spark: SparkSession, words: np.ndarray, probes: int = PROBES, salt: int = 0):
    """A column function: may the long hash be in the filter?"""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        return pd.Series(bloom_has(shared.value, hashes.to_numpy(), probes, salt))

    return passes


# --- connected components -------------------------------------------------------


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a long, b long); component: its smallest node.

    Alternating large-star and small-star steps: every node is linked to the
    smallest node it sees, until only stars are left. A step is a minimum per
    node (combined before the shuffle) and an equi-join that adaptive execution
    can split, so a node with very many links is no hot task. Each round is
    landed; its count and checksum tell whether anything changed.
    """
    now = land(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = _signature(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        after = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        now = land(after.distinct(), "edges")
        before, seen = seen, _signature(now)
        if before == seen:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def words_of(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in a text; 0 for null."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "x")
    return F.length(F.translate(squeezed, " \t\n\x0b\x0c\r", "")).cast("long")
