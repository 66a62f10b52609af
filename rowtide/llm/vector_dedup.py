"""Near-duplicate vectors by robust-pruned graphs on overlapping shards.

1. Identical vectors of a label become one node that stands for all copies.
2. Centroids of each large label, fitted on a bounded sample, cut it into cells;
   every node lies in all whose angle to it is within a margin of the nearest
   one's, however many that are. Cells that are still large are cut again alike, each
   by centroids fitted on a sample of its own, until none is or cutting no longer helps
   (very many vectors within the margin of each other); such a cell is dealt into
   blocks that meet pair by pair, so no task holds more than two.
3. Each block becomes a flat graph: nodes keep the near neighbours that robust
   pruning leaves and a few random ones, with reverse edges, all reachable from the medoid.
4. The adjacency lists a node has from its cells are united.
5. Every node is searched for in its cells: a greedy beam from the medoid (from the
   node itself where it is in the graph, and from its neighbours of other cells)
   until the beam is exhausted, then on from every vector in range until no further
   one turns up. Two blocks are searched both ways.
6. What is found is verified in double precision. A pair is counted in the first
   cell both nodes are in, which has found it if any has. Tasks return counts and a spanning forest, not pairs,
   so a dense group does not blow up.

``audit_recall`` compares with brute force for the vectors whose id is divisible by 100.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import connected_components, land

THRESHOLD = 0.93
# Vectors the centroids are fitted on, and sample vectors per centroid at least.
SAMPLE_ROWS = 20_000
SAMPLE_PER_CENTROID = 8
CELL_ROWS = 1500
BLOCK_ROWS = 4000
# Centroids per CELL_ROWS nodes: each node lies in about two cells of a label that just needs them, in more of a larger one.
OVERLAP = 2
# Margin of the cells, in standard deviations of the turn from a vector to another in range along one direction.
SLACK = 1.5
# Graph: neighbours kept, candidates pruned from, slack of the pruning on squared distances.
DEGREE, CANDIDATES, ALPHA = 24, 64, 1.44
BEAM = 48
# Random further neighbours of each row: ways out of groups of more than CANDIDATES rows, and into them.
FAR = 8
# Neighbours from other cells that a search starts from.
STARTS = 3
# Further cuts of large cells: centroids and sample vectors of a cell, and how often at most.
FINER, FINER_SAMPLE, CUTS = 32, 4000, 8


# --- graph ----------------------------------------------------------------------


def _candidates(x: np.ndarray, rows: slice, size: int) -> np.ndarray:
    scores = x[rows] @ x.T
    scores[np.arange(len(scores)), np.arange(rows.start, rows.start + len(scores))] = -2
    top = np.argpartition(-scores, size - 1, axis=1)[:, :size] if size < len(x) else np.argsort(-scores, axis=1)
    order = np.argsort(-np.take_along_axis(scores, top, 1), axis=1, kind="stable")
    return np.take_along_axis(top, order, 1)[:, :size]


def robust_prune(x: np.ndarray, points: np.ndarray, near: np.ndarray) -> list[np.ndarray]:
    """For each point, of its candidates from near to far: keep one, drop those much closer to it than to the point."""
    own = x[near]
    far = 2 - 2 * np.einsum("pcd,pd->pc", own, x[points])
    between = 2 - 2 * np.matmul(own, own.transpose(0, 2, 1))
    alive = np.ones(near.shape, bool)
    kept = np.zeros(near.shape, bool)
    every = np.arange(len(points))
    for _ in range(DEGREE):
        first = alive.argmax(axis=1)
        some = alive[every, first]
        if not some.any():
            break
        kept[every[some], first[some]] = True
        alive &= ALPHA * between[every, first] > far
        alive[every, first] = False
    return [n[k] for n, k in zip(near, kept)]


def build_graph(x: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Neighbours of each unit row of ``x``, and the medoid all rows can be reached from."""
    n = len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    if n == 1:
        return [np.empty(0, np.int64)], 0
    size, out = min(CANDIDATES, n - 1), []
    for start in range(0, n, 256):
        rows = slice(start, min(n, start + 256))
        out += robust_prune(x, np.arange(rows.start, rows.stop), _candidates(x, rows, size))
    far = np.random.default_rng(n).integers(0, n - 1, (n, FAR))
    far += far >= np.arange(n)[:, None]  # anybody but the row itself
    source = np.concatenate([np.repeat(np.arange(n), [len(o) for o in out]), np.repeat(np.arange(n), FAR)])
    target = np.concatenate([*out, far.ravel()])
    ends = np.unique(np.concatenate([source * n + target, target * n + source]))
    source, target = ends // n, ends % n
    graph = np.split(target, np.searchsorted(source, np.arange(1, n)))
    for i, own in enumerate(graph):
        if len(own) > 2 * DEGREE + FAR:
            order = own[np.argsort(-(x[own] @ x[i]), kind="stable")]
            graph[i] = np.concatenate([order[: 2 * DEGREE], order[-FAR:]])
    _connect(x, graph, medoid)
    return graph, medoid


def _reached(graph: list[np.ndarray], seen: np.ndarray, start: np.ndarray) -> None:
    while len(start):
        seen[start] = True
        ahead = np.unique(np.concatenate([graph[i] for i in start]))
        start = ahead[~seen[ahead]]


def _connect(x: np.ndarray, graph: list[np.ndarray], medoid: int) -> None:
    """Link what the medoid does not reach to the nearest reached row."""
    seen = np.zeros(len(x), bool)
    _reached(graph, seen, np.array([medoid]))
    while not seen.all():
        lost, inside = int(np.flatnonzero(~seen)[0]), np.flatnonzero(seen)
        near = int(inside[(x[inside] @ x[lost]).argmax()])
        graph[near] = np.append(graph[near], lost)
        graph[lost] = np.append(graph[lost], near)
        _reached(graph, seen, np.array([lost]))


def _table(graph: list[np.ndarray]) -> np.ndarray:
    """Neighbour lists as one matrix, filled up with -1."""
    width = max(1, max(map(len, graph)))
    out = np.full((len(graph), width), -1, np.int64)
    for i, own in enumerate(graph):
        out[i, : len(own)] = own
    return out


def range_search(
    x: np.ndarray, table: np.ndarray, entries: np.ndarray, queries: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of what is found with a product of at least ``least``; ``entries``: start rows per query."""
    q, n = len(queries), len(x)
    seen, score = np.zeros((q, n), bool), np.full((q, n), -2, np.float32)

    def visit(who: np.ndarray, rows: np.ndarray) -> None:
        for at in range(0, len(who), 1 << 16):
            w, r = who[at : at + (1 << 16)], rows[at : at + (1 << 16)]
            score[w, r] = np.einsum("pd,pd->p", queries[w], x[r])
        seen[who, rows] = True

    def ahead(who: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unseen neighbours, each once."""
        out = []
        for at in range(0, len(who), 1 << 16):
            near = table[rows[at : at + (1 << 16)]]
            w = np.broadcast_to(who[at : at + (1 << 16), None], near.shape)[near >= 0]
            near = near[near >= 0]
            new = ~seen[w, near]
            out.append(np.unique(w[new] * n + near[new]))
        ends = np.unique(np.concatenate([np.empty(0, np.int64), *out]))
        return ends // n, ends % n

    visit(np.repeat(np.arange(q), entries.shape[1]), entries.ravel())
    done = np.zeros((q, n), bool)
    active, width, steps = np.arange(q), min(BEAM, n), 0
    floor = np.full(q, -3, np.float32)
    while len(active):
        open_ = np.where(done[active], -3, score[active])
        best = open_.argmax(axis=1)
        value = open_[np.arange(len(active)), best]
        if steps % 6 == 0:
            # The beam's worst, which only rises: nothing below it is expanded any more.
            floor[active] = np.partition(score[active], n - width, axis=1)[:, n - width]
        go, steps = (value > -2) & (value >= floor[active]), steps + 1
        active, best = active[go], best[go]
        done[active, best] = True
        visit(*ahead(active, best))
    who, rows = np.nonzero((score >= least) & ~done)
    while len(who):
        done[who, rows] = True
        visit(*ahead(who, rows))
        who, rows = np.nonzero((score >= least) & ~done)
    return np.nonzero(score >= least)


def block_pairs(
    x: np.ndarray, near: list[np.ndarray], entry: int, queries: np.ndarray, starts: list[np.ndarray], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """(query, row of ``x``) found by searching the graph ``near``; ``starts``: rows a query starts from besides the medoid."""
    table, who, rows = _table(near), [], []
    for at in range(0, len(queries), 256):
        own = starts[at : at + 256]
        entries = np.full((len(own), 1 + STARTS), entry)
        for i, some in enumerate(own):
            entries[i, 1 : 1 + len(some[:STARTS])] = some[:STARTS]
        a, b = range_search(x, table, entries, queries[at : at + 256], least)
        who.append(a + at)
        rows.append(b)
    return (np.concatenate(who), np.concatenate(rows)) if who else (np.empty(0, np.int64), np.empty(0, np.int64))


# --- cells ----------------------------------------------------------------------


def _fit(sample: np.ndarray, count: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    centres = sample[rng.choice(len(sample), count, replace=False)].copy()
    for _ in range(8):
        owner = (sample @ centres.T).argmax(axis=1)
        for c in np.unique(owner):
            mean = sample[owner == c].sum(axis=0)
            norm = np.linalg.norm(mean)
            if norm > 0:
                centres[c] = mean / norm
    return centres


def _count(size: int, sample: int) -> int:
    return min(-(-size // CELL_ROWS) * OVERLAP, sample // SAMPLE_PER_CENTROID)


def _margin(sample: np.ndarray, threshold: float) -> float:
    """How much larger than the angle to the nearest centroid that to another of a node's may be.

    The angle of the threshold itself loses no pair: both ends are within it of
    the centroid nearest to their middle. A pair's turn has a small share only
    in the direction from one centroid to another, the smaller the more
    directions the vectors spread in, so SLACK such shares are enough for 0.99
    of the pairs at 0.935 of 64-d Gaussian vectors, at 14 centroids and at
    2500, also far off the origin.
    """
    spread = sample - sample.mean(axis=0)
    scatter = spread.T @ spread
    square = float((scatter * scatter).sum())
    directions = float(np.trace(scatter)) ** 2 / square if square else 1.0
    return float(np.arccos(np.clip(threshold, -1, 1)) * min(1.0, SLACK / np.sqrt(directions)))


def _within(unit: np.ndarray, centres: np.ndarray, margin: float) -> list[np.ndarray]:
    """The centroids of each row of ``unit``."""
    angle = np.arccos(np.clip(unit @ centres.T, -1, 1))
    row, near = np.nonzero(angle <= angle.min(axis=1, keepdims=True) + margin)
    return np.split(near, np.searchsorted(row, np.arange(1, len(unit))))


def fit_centroids(nodes: DataFrame, threshold: float) -> dict[str, tuple[np.ndarray, float]]:
    """Centroids and margin of the groups of more than ``CELL_ROWS`` nodes, from a sample of ``SAMPLE_ROWS`` nodes of those.

    At most SAMPLE_ROWS / SAMPLE_PER_CENTROID groups and centroids, so they can be broadcast.
    """
    most = SAMPLE_ROWS // SAMPLE_PER_CENTROID
    sizes = nodes.groupBy("group").count().where(F.col("count") > CELL_ROWS).orderBy(F.desc("count"), "group").limit(most)
    large = {r["group"]: r["count"] for r in sizes.collect()}
    if not large:
        return {}
    chosen = nodes.where(F.col("group").isin(list(large))).orderBy(F.xxhash64("node"), "node").limit(SAMPLE_ROWS)
    sample, out = chosen.select("group", "unit").toPandas(), {}
    for group, rows in sample.groupby("group")["unit"]:
        x = np.stack(rows.to_list())
        count = _count(large[group], len(x))
        if count > 1:
            out[group] = _fit(x, count).astype(np.float32), _margin(x, threshold)
    return out


def _assign(nodes: DataFrame, centroids: dict[str, tuple[np.ndarray, float]]) -> DataFrame:
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)

    @F.pandas_udf("array<string>")
    def cells(group: pd.Series, unit: pd.Series) -> pd.Series:
        out = pd.Series([[g] for g in group], index=group.index)
        for name, rows in unit.groupby(group):
            if name in shared.value:
                near = _within(np.stack(rows.to_list()).astype(np.float32), *shared.value[name])
                for at, own in zip(rows.index, near):
                    out[at] = sorted(f"{name}/{c}" for c in own.tolist())
        return out

    return nodes.withColumn("cells", cells("group", "unit"))


# --- the operator -----------------------------------------------------------------


def _usable(vector: Column, label: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(label.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def _unit(vector: Column) -> Column:
    """Vectors of length 1; null stays null."""

    @F.pandas_udf("array<double>")
    def unit(vectors: pd.Series) -> pd.Series:
        return vectors.map(_normalised)

    return unit(vector)


def _normalised(vector: np.ndarray | None) -> np.ndarray | None:
    if vector is None:
        return None
    # Divided by the largest component first: squares neither overflow nor vanish.
    scaled = vector / np.abs(vector).max()
    return scaled / np.sqrt((scaled * scaled).sum())


def _classes(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the key of their class, and the landed nodes, one per class."""
    vector = F.col(vector_col).cast("array<double>")
    own = rows.select(F.col(id_col).alias("id"), vector.alias("vector"), F.col(label_col).cast("string").alias("label"))
    own = own.withColumn("usable", _usable(F.col("vector"), F.col("label")))
    group = F.concat_ws(":", F.size("vector"), "label")
    key = F.when(F.col("usable"), F.struct(F.xxhash64("label", "vector").alias("h"), F.xxhash64("vector", "label").alias("g")))
    keyed = land(own.select("id", "usable", F.when(F.col("usable"), group).alias("group"), key.alias("key"), "vector"), "keyed")
    nodes = keyed.where("usable").groupBy("key", "group").agg(
        F.min("id").alias("low"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    nodes = nodes.select("key", "group", "low", "copies", _unit(F.col("vector")).alias("unit"))
    return keyed.select("id", "key"), land(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _finer(placed: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """The rows of large cells in cells of their own, by centroids fitted on a sample of each."""
    rows = placed.join(sizes, "cell")
    sample = rows.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.ceil(F.col("count") / FINER_SAMPLE)) == 0)

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("node")
        x = np.stack(own["unit"].to_list()).astype(np.float32)
        count = min(FINER, -(-int(own["count"].iloc[0]) // CELL_ROWS) * OVERLAP, len(x) // SAMPLE_PER_CENTROID)
        centres = _fit(x, max(1, count)).astype("<f4").tobytes()
        return pd.DataFrame({"cell": own["cell"].iloc[:1], "centres": [centres], "margin": [_margin(x, threshold)]})

    centres = sample.select("cell", "count", "node", "unit").groupBy("cell").applyInPandas(
        fit, "cell string, centres binary, margin double"
    )

    def assign(batches):
        for batch in batches:
            batch["cells"] = None
            cells = batch["cells"].astype(object)
            for cell, own in batch.groupby("cell"):
                unit = np.stack(own["unit"].to_list()).astype(np.float32)
                centres = np.frombuffer(own["centres"].iloc[0], "<f4").reshape(-1, unit.shape[1])
                for at, near in zip(own.index, _within(unit, centres, own["margin"].iloc[0])):
                    cells[at] = [f"{cell}/{c}" for c in near.tolist()]
            batch["cells"] = cells
            yield batch[["node", "copies", "unit", "cells"]]

    schema = "node long, copies long, unit array<double>, cells array<string>"
    cut = rows.join(land(centres, "centres"), "cell").mapInPandas(assign, schema)
    return cut.select("node", "copies", "unit", F.explode("cells").alias("cell"))


def _blocks(nodes: DataFrame, threshold: float) -> DataFrame:
    """One row per node and cell, with all cells of the node, its block and the number of blocks of the cell."""
    placed = _assign(nodes, fit_centroids(nodes, threshold)).select("node", "copies", "unit", F.explode("cells").alias("cell"))
    placed, before = land(placed, "cells"), None
    for _ in range(CUTS):
        sizes = placed.groupBy("cell").count()
        large = land(sizes.where(F.col("count") > BLOCK_ROWS), "large")
        row = large.agg(F.max("count"), F.sum("count")).first()
        if row[0] is None or before is not None and row[0] * 4 > before * 3:
            break  # none is large, or cutting no longer helps
        before = row[0]
        rest = placed.join(large.select("cell"), "cell", "left_anti").select(*placed.columns)
        placed = land(rest.unionByName(_finer(placed, large, threshold)), "cells")
    sizes = placed.groupBy("cell").count().select("cell", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    owners = placed.groupBy("node").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    dealt = placed.join(sizes, "cell").join(owners, "node")
    return dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def _adjacency(blocks: DataFrame) -> DataFrame:
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        graph, medoid = build_graph(np.stack(rows["unit"].to_list()).astype(np.float32))
        nodes = rows["node"].to_numpy()
        return pd.DataFrame(
            {"node": nodes, "cell": rows["cell"], "near": [nodes[g] for g in graph], "entry": np.arange(len(nodes)) == medoid}
        )

    # The block is part of the key: a cell may have several.
    shards = blocks.groupBy("cell", "block").applyInPandas(build, "node long, cell string, near array<long>, entry boolean")
    return land(shards, "shards")


def _search(pairs: DataFrame, threshold: float) -> DataFrame:
    """Counts (node, null, links) and forest edges (node, other, 0) from groups of one or two blocks."""

    def find(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cell, first, second = key
        rows = rows.sort_values("node", ignore_index=True)
        block = rows["block"].to_numpy()
        unit, nodes = np.stack(rows["unit"].to_list()), rows["node"].to_numpy()
        owners, copies, near = rows["cells"].to_numpy(), rows["copies"].to_numpy(), rows["near"].to_numpy()
        is_entry = rows["entry"].to_numpy()
        links, ends = np.zeros(len(rows), np.int64), []
        for here, there in {(first, second), (second, first)}:
            asked, index = np.flatnonzero(block == here), np.flatnonzero(block == there)
            if not len(index) or not len(asked):
                continue
            graph = [_local(nodes[index], n) for n in near[index]]
            if here == there:
                starts = [np.array([i]) for i in range(len(index))]
            else:
                starts = [_local(nodes[index], near[i]) for i in asked]
            entry = int(np.flatnonzero(is_entry[index])[0])
            x, queries = unit[index].astype(np.float32), unit[asked].astype(np.float32)
            who, found = block_pairs(x, graph, entry, queries, starts, threshold - 1e-4)
            a, b = asked[who], index[found]
            ends.append(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b])
        ends = np.unique(np.concatenate(ends, axis=1), axis=1) if ends else np.empty((2, 0), np.int64)
        forest = _Forest(len(rows))
        for at in range(0, ends.shape[1], 1 << 16):
            a, b = ends[:, at : at + (1 << 16)]
            close = np.einsum("pd,pd->p", unit[a], unit[b]) >= threshold
            mine = np.array([cell == min(set(owners[i]) & set(owners[j])) for i, j in zip(a[close], b[close])], bool)
            a, b = a[close][mine], b[close][mine]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            forest.add(a, b)
        some = np.flatnonzero(links)
        a, b = forest.edges()
        return _result(nodes[some], links[some], nodes[a], nodes[b])

    return pairs.groupBy("cell", "first", "second").applyInPandas(find, "node long, other long, links long")


def _result(nodes, links, a, b) -> pd.DataFrame:
    other = pd.array([None] * len(nodes) + list(b), "Int64")
    return pd.DataFrame({"node": np.array([*nodes, *a], np.int64), "other": other, "links": np.array([*links, *[0] * len(a)], np.int64)})


def _local(nodes: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Positions of those of ``near`` that are among the sorted ``nodes``."""
    near = np.unique(near)
    at = np.minimum(np.searchsorted(nodes, near), len(nodes) - 1)
    return at[nodes[at] == near]


class _Forest:
    def __init__(self, size: int):
        self._root, self._kept = list(range(size)), []

    def _find(self, i: int) -> int:
        while self._root[i] != i:
            self._root[i] = self._root[self._root[i]]
            i = self._root[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            u, v = self._find(i), self._find(j)
            if u != v:
                self._root[v] = u
                self._kept.append((i, j))

    def edges(self) -> np.ndarray:
        return np.array(self._kept, np.int64).reshape(-1, 2).T


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``rows``: ``id_col``, n_links, component_id, kept.

    Two vectors link if their labels are equal and not null, they have as many
    components and their cosine is at least ``threshold``. Null and zero vectors,
    and those with a null or non-finite component, link with nothing. n_links
    counts the other rows linked directly (repeated rows count each), component_id
    is the smallest id reachable, kept says that it is the row's own. A null id
    is never the smallest. An empty table gives no rows; other columns are not
    read. No pair below the threshold is linked; that none is missed is measured
    by ``audit_recall``.
    """
    keyed, nodes = _classes(rows, id_col, vector_col, label_col)
    blocks = land(_blocks(nodes, threshold), "blocks")
    shards = _adjacency(blocks)
    # A list of bounded length per cell of the node.
    united = shards.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    entries = shards.select("node", "cell", "entry")
    members = blocks.join(united, "node").join(entries, ["node", "cell"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("facing")
    pairs = members.select("*", other).withColumns(
        {"first": F.least("block", "facing"), "second": F.greatest("block", "facing")}
    )
    found = land(_search(pairs.drop("facing", "blocks"), threshold), "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = connected_components(edges)
    known = nodes.select("node", "key", "low", "copies").join(counts, "node", "left").join(groups, "node", "left")
    known = known.withColumn("root", F.coalesce("component", "node"))
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = keyed.where("key is not null").join(known, "key").select("id", "n_links", "component_id")
    alone = keyed.where("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def audit_recall(
    rows: DataFrame,
    result: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> float:
    """Links found / links there are, for the rows whose id is divisible by 100 against all rows."""
    vector = F.col(vector_col).cast("array<double>")
    own = rows.select(F.col(id_col).alias("id"), vector.alias("v"), F.col(label_col).alias("label"))
    own = own.where(_usable(F.col("v"), F.col("label"))).withColumn("v", _unit(F.col("v")))
    asked = own.where("id % 100 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"), F.col("label"))
    product = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
    true = own.join(asked, "label").where((F.col("q") != F.col("id")) & (product >= threshold))
    true = true.groupBy("q").agg(F.count("*").alias("there"))
    both = true.join(result.select(F.col(id_col).alias("q"), "n_links"), "q")
    found, there = both.agg(F.sum(F.least("n_links", "there")), F.sum("there")).first()
    return found / there if there else 1.0
