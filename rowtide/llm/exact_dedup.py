"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Every task sorts the distinct fingerprints of its rows and sends them, Rice
   coded, to the owners of the fingerprint ranges.
2. An owner decodes what it got and answers each sender with a bitmap over the
   sender's sorted list: which of its fingerprints somebody else has too.
3. The senders read their bitmaps; the duplicated fingerprints become a Bloom
   filter of bounded size, and only rows that pass it are shuffled.
4. Those suspects are grouped by the text itself, so fingerprint collisions
   cannot join different texts. The grouping is combined before the shuffle:
   a text with a third of all rows arrives as one row per task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import bloom_build, bloom_test, fresh, land

# Bits of a fingerprint: at 10^10 texts about one in a thousand is suspected wrongly.
FINGERPRINT_BITS = 44
# Distinct fingerprints a task holds before it sends them.
CHUNK = 1 << 20
# Rows per owner of a fingerprint range.
ROWS_PER_OWNER = 1 << 20
# Largest suspect filter that is broadcast: 16 MB.
MAX_FILTER_BITS = 1 << 27

PAYLOAD = "part string, owner int, n int, rice int, unary binary, rest binary, twice binary"


def rice_encode(values: np.ndarray, base: int, span: int) -> tuple[int, bytes, bytes]:
    """Ascending values of ``[base, base + span)``: parameter, quotients in unary, remainders."""
    rice = max(0, int(math.log2(max(1.0, span / max(1, len(values))))))
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(base))
    ends = np.cumsum(gaps >> rice) + np.arange(len(gaps))
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, dtype=np.uint8)
    unary[ends] = 1
    low = (gaps & ((1 << rice) - 1)).astype(">u8").view(np.uint8).reshape(-1, 8)
    rest = np.unpackbits(low, axis=1)[:, 64 - rice :] if rice else np.zeros((0, 0), np.uint8)
    return rice, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def rice_decode(n: int, rice: int, unary: bytes, rest: bytes, base: int) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    high = np.diff(ends, prepend=-1) - 1
    low = np.zeros((n, 64), np.uint8)
    if rice:
        low[:, 64 - rice :] = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * rice].reshape(n, rice)
    gaps = (high.astype(np.int64) << rice) + np.packbits(low, axis=1).view(">u8").ravel().astype(np.int64)
    return base + np.cumsum(gaps)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8))[:n].astype(bool)


def fingerprint(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - FINGERPRINT_BITS)


def _span(owners: int) -> int:
    return -(-(1 << FINGERPRINT_BITS) // owners)


def exchange(prints: DataFrame, owners: int) -> DataFrame:
    """The distinct fingerprints (column ``fp``) that occur on more than one row."""
    span = _span(owners)

    def send(batches):
        task, chunk, held, size = TaskContext.get(), 0, [], 0

        def rows():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(values, np.arange(owners + 1, dtype=np.int64) * span)
            for owner in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[owner], cuts[owner + 1])
                rice, unary, rest = rice_encode(values[own], int(owner) * span, span)
                part = f"{task.stageId()}.{task.partitionId()}.{chunk}"
                yield part, int(owner), len(values[own]), rice, unary, rest, _bits(counts[own] > 1)

        def batch():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows()], schema=schema)

        for one in batches:
            held.append(one.column(0).to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= CHUNK:
                yield batch()
                chunk, held, size = chunk + 1, [], 0
        if size:
            yield batch()

    schema = pa.schema(
        [("part", pa.string()), ("owner", pa.int32()), ("n", pa.int32()), ("rice", pa.int32())]
        + [(c, pa.binary()) for c in ("unary", "rest", "twice")]
    )
    sent = land(prints.mapInArrow(send, PAYLOAD), "payloads")

    def answer(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
        base = int(key[0]) * span
        got = [rice_decode(r.n, r.rice, r.unary, r.rest, base) for r in lists.itertuples()]
        values, senders = np.unique(np.concatenate(got), return_counts=True)
        several = values[senders > 1]
        seen = [_bits(np.isin(v, several) | _flags(r.twice, r.n)) for v, r in zip(got, lists.itertuples())]
        return pd.DataFrame({"part": lists["part"], "owner": lists["owner"], "seen": seen})

    answers = sent.groupBy("owner").applyInPandas(answer, "part string, owner int, seen binary")

    def read(batches):
        for batch in batches:
            found = [
                rice_decode(r.n, r.rice, r.unary, r.rest, r.owner * span)[_flags(r.seen, r.n)]
                for r in batch.itertuples()
            ]
            if found:
                yield pd.DataFrame({"fp": np.concatenate(found)})

    returned = sent.join(answers, ["part", "owner"]).select("owner", "n", "rice", "unary", "rest", "seen")
    return land(returned.mapInPandas(read, "fp long").distinct(), "suspects")


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))


def _suspect_test(docs: DataFrame, text_col: str):
    """A column function on fingerprints: may another row have the same text?"""
    body = F.coalesce(F.col(text_col), F.lit(""))
    owners = max(1, math.ceil(docs.count() / ROWS_PER_OWNER)) * 16
    suspects = exchange(docs.select(fingerprint(body).alias("fp")), owners)
    words = bloom_build(suspects, suspects.count(), 16, MAX_FILTER_BITS)
    return bloom_test(docs.sparkSession, words)


def _verified(narrow: DataFrame, texts: DataFrame, passes) -> DataFrame:
    """(sha, size, best) per text of more than one row, equal byte for byte."""
    sizes = (
        texts.where(passes(fingerprint("body")))
        .groupBy("body")
        .agg(F.count("*").alias("size"))
        .where("size > 1")
        .select(F.unhex(F.sha2("body", 256)).alias("sha"), "size")
    )
    best = narrow.where("suspect").groupBy("sha").agg(F.max(F.struct("id", "uid")).alias("best"))
    return sizes.join(best, "sha")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as the empty text. The
    row with the greatest id of a group stays (a null id is less than any;
    of repeated rows with one id, one stays). An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    passes = _suspect_test(docs, text_col)
    texts = _plain(docs, id_col, text_col)
    narrow = land(
        texts.select(
            "id",
            F.unhex(F.sha2("body", 256)).alias("sha"),
            passes(fingerprint("body")).alias("suspect"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "hashes",
    )
    # landed, so that the join below deals out both sides and a text with very many rows can be split
    groups = land(_verified(narrow, texts, passes), "groups")
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    alone = narrow.where("not suspect").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    )
    grouped = narrow.where("suspect").join(groups, "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.uid") == F.col("uid"), F.lit(True)).alias("kept"),
        sha,
    )
    return alone.unionByName(grouped)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the rule of ``exact_duplicates``.

    Rows no other row shares its fingerprint with never leave their task.
    """
    passes = _suspect_test(docs, text_col)
    fp, body, best = fresh(docs, "fp", "body", "best")
    flagged = docs.withColumn(body, F.coalesce(F.col(text_col), F.lit("")))
    flagged = flagged.withColumn(fp, passes(fingerprint(F.col(body))))
    suspects = flagged.where(F.col(fp))
    winners = suspects.groupBy(body).agg(F.max(id_col).alias(best))
    winners = winners.select(F.unhex(F.sha2(body, 256)).alias(body), best)
    rows = suspects.withColumn(body, F.unhex(F.sha2(body, 256)))
    w = winners.alias("w")
    chosen = rows.alias("r").join(
        w, (F.col(f"r.{body}") == F.col(f"w.{body}")) & F.col(f"r.{id_col}").eqNullSafe(F.col(f"w.{best}")), "left_semi"
    )
    stay = chosen.dropDuplicates([body])
    return flagged.where(~F.col(fp)).drop(body, fp).unionByName(stay.drop(body, fp))
