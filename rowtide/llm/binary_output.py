"""Packed token ids as binary rows, ready for training.

Tokenise, cut overlong documents without loss, pack best-fit decreasing, bring
the pieces of a sequence together and write one fixed-width row of ids per
sequence, with the cumulative segment lengths and the places where positions
start again at 0. Places are computed from lengths alone. The ids of full pieces
are not shuffled; others are, to meet their place and to meet their sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import land
from rowtide.llm.packing import END, SEQUENCE, assign, token_pieces

DTYPE = "<u2"

ROW = (
    "sequence_id long, n_tokens long, n_segments long, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, pieces array<int>, ids_crc32 long"
)


def _rows(batches: Iterator[pd.DataFrame], capacity: int, dtype: str) -> Iterator[pd.DataFrame]:
    """Sequences from pieces sorted by sequence and offset; one may go on in the next batch."""
    held: list = []

    def row():
        lengths = [p.length for p in held]
        ids = np.frombuffer(b"".join(p.ids for p in held), dtype)
        ends = np.cumsum(lengths)
        if int(ends[-1]) != len(ids) or any(p.offset != e - p.length for p, e in zip(held, ends)):
            raise ValueError(f"sequence {held[0].sequence_id} has a gap")
        full = np.full(capacity, END, dtype)
        full[: len(ids)] = ids
        return (
            held[0].sequence_id, len(ids), len(held), full.tobytes(), [0, *ends.tolist()], [0, *ends[:-1].tolist()],
            [p.piece for p in held], zlib.crc32(ids.astype("<u4").tobytes()), [p.id for p in held],
        )

    names = [c.split()[0] for c in ROW.split(", ")] + ["doc_ids"]
    for batch in batches:
        out = []
        for piece in batch.itertuples(index=False):
            if held and held[0].sequence_id != piece.sequence_id:
                out.append(row())
                held = []
            held.append(piece)
        if out:
            yield pd.DataFrame(out, columns=names)
    if held:
        yield pd.DataFrame([row()], columns=names)


def packed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = SEQUENCE,
    tokenizer: str | None = None,
    dtype: str = DTYPE,
) -> DataFrame:
    """The packed matrix, one row per sequence.

    Sequences of one full piece have negative numbers.
    ids: ``capacity`` little-endian ids of type ``dtype``, padded with the end id
    beyond n_tokens. cu_seqlens: 0 and the end of each segment. position_resets:
    the offsets where a segment starts, so where positions are 0 again. doc_ids
    and pieces: what the segments are. ids_crc32 is over the n_tokens ids as
    unsigned 32-bit numbers. Null and empty texts are the end id alone; repeated
    rows are packed each; an empty table gives no rows; other columns are not read.
    """
    rows = token_pieces(docs, id_col, text_col, capacity, tokenizer, keep_ids=True, dtype=dtype)
    pieces = land(rows.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    columns = ["sequence_id", "offset", "id", "piece", "length", "ids"]
    # A full piece is a sequence of its own, so it stays in its task.
    alone = {"sequence_id": -F.col("uid") - 1, "offset": F.lit(0).cast("long")}
    full = pieces.where(F.col("length") == capacity).withColumns(alone).select(*columns)
    open_ = pieces.where(F.col("length") < capacity)
    places = assign(open_.drop("ids", "ids_crc32", "start"), capacity).select("uid", "sequence_id", "offset")
    placed = open_.join(places, "uid").select(*columns)
    together = placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    schema = f"{ROW}, doc_ids array<{placed.schema['id'].dataType.simpleString()}>"
    packed = [rows.mapInPandas(lambda b: _rows(b, capacity, dtype), schema) for rows in (full, together)]
    return packed[0].unionByName(packed[1])


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """``packed_rows`` as zstd-compressed Parquet: a fixed-width id row and its index per sequence."""
    packed_rows(docs, **options).write.option("compression", "zstd").parquet(path)
