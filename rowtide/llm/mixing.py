"""Mixing sources to target weights by systematic sampling.

Each document of a source expects the same number of copies, target / source
size. Along the documents of a source, ordered by size, the expected copies are
summed up from one random offset, and a document is taken once for each integer
the running sum crosses. Sorted by size, the taken words of a source stay
within about one document of its target.

The running sum needs a document's rank in its source only. Ranks come from one
range sort over (source, size, id), so a source with a third of all rows lies in
many tasks; what is gathered in one place is a row per task and a row per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import fresh, land, with_place, words_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Add ``target`` to one row per source (source, n, source_size); also rank and weight.

    Sources take the weights in turn, by code point with null last. Targets are
    level * weight, stopped at cap * size; the level is raised until the targets
    use the whole budget. The steps exchange three numbers with the driver.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ring = F.array(*[F.lit(w) for w in weights])
    table = sources.withColumn("rank", F.row_number().over(order))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    table = table.withColumn("weight", ring[(F.col("rank") - 1) % len(weights)])
    table = land(table.withColumn("limit", F.col("source_size") * cap), "sources")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget, level, stopped = share * total, 0.0, -1
    while True:
        over = F.col("limit") < F.lit(level) * F.col("weight")
        caps, free, count = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, 1)),
        ).first()
        if count == stopped or not free:
            break
        level, stopped = (budget - caps) / free, count
    target = F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight"))
    return table.withColumn("target", target if free else F.col("limit").cast("double"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, size, source_size, target, copies, taken.

    Size is the number of words; null and empty texts have none and add nothing
    to what is taken. A null source is a source of its own. Repeated rows count
    one by one. The offset is a hash of seed and source, ties are ordered by id,
    so reruns agree. No document gets more than ``cap`` copies. An empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    sized = land(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words_of(F.col(text_col)).alias("size")
        ),
        "sizes",
    )
    key = [F.col("source").asc_nulls_last(), F.col("size"), F.col("id")]
    placed = sized.repartitionByRange(*key).sortWithinPartitions(*key)
    placed = land(placed.withColumn("at", F.monotonically_increasing_id()), "sorted")
    task = F.shiftrightunsigned("at", 33)
    tasks = placed.groupBy(task.alias("task")).agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("task", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    sources = placed.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, cap).select(
        F.col("source").alias("name"), "first", "source_size", "target"
    )
    # One row per task of the sort: small whatever the input.
    ranked = placed.withColumn("task", task).join(F.broadcast(starts), "task")
    ranked = ranked.join(targets, F.col("source").eqNullSafe(F.col("name")))
    rank = (F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1) - F.col("first")).cast("double")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("\x00null"))).cast("binary"))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 4294967296.0
    copies = F.floor(offset + rate * (rank + 1)) - F.floor(offset + rate * rank)
    return ranked.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` the mix takes, each as often as it is taken, with all their columns.

    Rows are told apart by their id or, if some share one or have none, by their place in a landed
    copy, so each row gets its own copies.
    """
    place, copies = fresh(docs, "place", "copies")
    landed = with_place(docs, id_col, place)
    rows = landed.select(F.col(place), F.col(text_col), F.col(source_col))
    taken = mix_sources(rows, place, text_col, source_col, **options).where("copies > 0")
    taken = taken.select(F.col(place), F.col("copies").alias(copies))
    each = landed.join(taken, place).withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return each.select(*docs.columns)
