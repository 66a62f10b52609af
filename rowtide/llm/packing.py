"""Best-fit decreasing packing of token pieces into sequences of one length.

Pieces of one length are interchangeable, so the packing is decided over the
histogram of lengths: at most one entry per token count up to the sequence
length, however many documents there are. ``best_fit_plan`` takes the lengths
from long to short and asks a segment tree over the remaining room of the open
sequences for the tightest one that still fits. It decides what best fit would
decide document by document, for runs of equal pieces at once. A document then
finds its place from its length and its rank among pieces of that length.

Ranks are counted per writing task first, so one length with a third of all
pieces is spread over as many groups as there are tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import land
from rowtide.llm.tokens import encoder

SEQUENCE = 2048
END = 0


class TightestRoom:
    """Segment tree over rooms: is any sequence open with a room in this range?"""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._open = [0] * (2 * self._leaves)

    def add(self, room: int, sequences: int) -> None:
        node = room + self._leaves
        while node:
            self._open[node] += sequences
            node >>= 1

    def find(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that a sequence has."""
        node = least + self._leaves
        while not self._open[node]:
            # Up while we are a right child, then to the right neighbour.
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node = 2 * node if self._open[2 * node] else 2 * node + 1
        return node - self._leaves


@dataclass(frozen=True)
class Plan:
    """Runs of equal pieces: piece ``rank`` of a run fills sequence
    ``first + rank // each`` at ``offset + rank % each * length``."""

    key: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << 44) + rank
        run = np.searchsorted(self.key, key, side="right") - 1
        at = key - self.key[run]
        return self.first[run] + at // self.each[run], self.offset[run] + at % self.each[run] * length


def best_fit_plan(histogram: dict[int, int], capacity: int) -> Plan:
    tree, held, runs, made = TightestRoom(capacity), {}, [], 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            held.setdefault(room, []).append((first, count))
            tree.add(room, count)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.find(length)
            if room is None:
                room, each = capacity, capacity // length
                first, count = made, -(-left // each)
                made += count
            else:
                first, count = held[room].pop()
                tree.add(room, -count)
                each = room // length
            taken = min(left, count * each)
            runs.append(((length << 44) + rank, first, each, capacity - room))
            full, rest = divmod(taken, each)
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            touched = full + (rest > 0)
            put(room, first + touched, count - touched)
            rank, left = rank + taken, left - taken
    columns = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4).T
    return Plan(*columns, made)


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than ``capacity``."""
    if tokens <= capacity:
        return [(0, tokens)]
    first = tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, tokens, capacity)]


def token_pieces(
    docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str | None, keep_ids: bool = False, dtype="<u4"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of all texts, an end id after each."""

    def pieces(batches):
        code, end = encoder(tokenizer, dtype), np.array([END], dtype).tobytes()
        width = len(end)
        for batch in batches:
            rows, ids = [], []
            for at, text in enumerate(batch.iloc[:, 1]):
                data = code.encode(text or "") + end
                for piece, (start, length) in enumerate(cut(len(data) // width, capacity)):
                    own = data[start * width : (start + length) * width]
                    wide = own if width == 4 else np.frombuffer(own, dtype).astype("<u4").tobytes()
                    rows.append((at, piece, start, length, zlib.crc32(wide)))
                    ids.append(own)
            at, *columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            out = dict(zip(("piece", "start", "length", "ids_crc32"), columns))
            frame = pd.DataFrame({"id": batch.iloc[at, 0].array, **out})
            yield frame.assign(ids=ids) if keep_ids else frame

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return plain.mapInPandas(pieces, schema)


def assign(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to landed pieces with a ``uid`` from the task that wrote them."""
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(best_fit_plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    group = ["length", "task"]
    rows = pieces.withColumn("task", F.shiftrightunsigned("uid", 33))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*group).count().withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*group).orderBy("uid")) - 1)
    ranked = ranked.join(counts.select(*group, "before"), group)
    placed = ranked.withColumn("at", place("length", F.col("before") + F.col("nth")))
    return placed.withColumns({"sequence_id": F.col("at.sequence_id"), "offset": F.col("at.offset")}).drop("task", "nth", "before", "at")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = SEQUENCE,
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and one end id; a null or empty text is the end id
    alone. Documents longer than ``capacity`` are cut, nothing is dropped.
    Repeated rows are packed each. An empty table gives no rows. Other columns
    are not read. ``tokenizer`` is a path that every executor can open.
    """
    rows = token_pieces(docs, id_col, text_col, capacity, tokenizer)
    rows = land(rows.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = assign(rows, capacity)
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
