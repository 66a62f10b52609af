"""Similarity self-join on word shingles with PartEnum signatures.

Sets of similar size share a band. Inside a band, similar sets differ in at most
k shingles. The shingle domain is cut (by hash) into n1 parts of n2 sub-parts;
k differences leave at least one part with at most one difference, so the two
sets agree on one of its n2 choices of n2 - 1 sub-parts. A set's signatures are
its contents of all these choices: similar sets share one, whatever the hash.

An empty choice says nothing and would be shared by very many sets, so it is not
sent. There are ``slack`` parts more than needed; only a set that is empty in
more parts than that enumerates another, independent cut as well. Two similar
sets that share nothing but empty choices both do, so no pair is lost.

The first cut leaves out shingles that very many documents have: on the rest of
the domain similar sets differ in no more than k shingles either, and a passage
in a third of all documents is no reason to compare them. Which shingles those
are is read off counts over all documents in a table of fixed size; any choice
is lossless.

Most signatures occur once. Tasks first send their hashes, Rice coded, to the owners
of hash ranges, and a Bloom filter of those that came twice tells which rows to shuffle.
Near copies share hundreds of signatures; of buckets that hold the same nodes one is kept.

Equal sets are one node from the start. Every node is first compared with the
most connected node of its buckets, which closes in most groups of near copies.
Nodes still apart from that hub's group form a cell with it: all nodes of a bucket lie in one
cell, whatever other buckets they share. Inside a cell, blocks of outsiders meet
blocks of nodes in one task each. Sizes and parity sketches tell which nodes can have
a partner there at all; the whole sets of these are compared through an index of
their shingles, and a task returns only links that join two groups, never its pairs.
Sets travel as compressed texts, a third of their shingles' hashes, and are made anew where they are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import (
    _mix,
    bloom_build,
    bloom_has,
    bloom_test,
    connected_components,
    fresh,
    land,
    release,
    with_place,
)
from rowtide.llm.exact_dedup import rice_decode, rice_encode

SUB_PARTS = 2
# Cuts a set enumerates at most; the last one sends empty choices too.
LEVELS = 5
# Nodes of a cell that are compared with each other in one task: by sketches, by whole sets.
SKETCH_BLOCK = 4000
SET_BLOCK = 500
# Signatures a set has, at most on average; only the size of the exchange depends on it.
SIGNATURES = 512
# Signature hashes an owner receives, about, and a task holds before it sends them.
OWNED = 1 << 21
HELD = 1 << 20
# Cells of the parity sketch that rules pairs out before their sets are looked at.
SKETCH_CELLS = 512
SKETCH = [f"p{i}" for i in range(SKETCH_CELLS // 64)]
# Counters the shingles of all documents are dealt to, to find common ones.
COUNTERS = 1 << 18
# Pairs that may be broadcast for their verification: 16 bytes each.
SMALL_PAIRS = 50_000
MAX_FILTER_BITS = 1 << 27
# Sets a task remembers to send each once; it starts again when full.
CACHE = 300_000
# Bytes of text hashed at once: every worker process keeps a few arrays of eight times as much.
CHUNK_BYTES = 1 << 18


# A word's hash is a polynomial over its bytes, modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _byte_values() -> np.ndarray:
    """A random number per byte, the same for A-Z and a-z; 0 for white space."""
    values = np.random.Generator(np.random.Philox(key=11)).integers(1, 1 << 64, 256, dtype=np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[[0x20, *range(0x09, 0x0E)]] = 0
    return values


_VALUES = _byte_values()


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text in UTF-8, and where they start."""
    if len(_powers[0]) <= len(data):
        for i, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(len(data) + CHUNK_BYTES, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.multiply.accumulate(factors)
    values = _VALUES[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff((values != 0).astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _powers[0][: len(data)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64)), starts


def _folded(codes: np.ndarray, n: int) -> np.ndarray:
    last = len(codes) - n + 1
    out = _mix(codes[:last])
    for i in range(1, n):
        out = _mix(out * np.uint64(_BASE) + codes[i : i + last])
    return out


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word n-grams; of fewer words, of the whole sequence."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append((text or "").encode())
        size += len(held[-1]) + 1
        if size >= CHUNK_BYTES:
            yield from _chunk_sets(held, words)
            held, size = [], 0
    if held:
        yield from _chunk_sets(held, words)


def _chunk_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    codes, starts = _word_hashes(b" ".join(texts))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    spots = np.searchsorted(starts, begins)
    grams = _folded(codes, words) if len(codes) >= words else codes[:0]
    for first, end in zip(spots[:-1].tolist(), spots[1:].tolist()):
        if end - first >= words:
            yield np.unique(grams[first : end - words + 1])
        else:
            yield _folded(codes[first:end], end - first) if end > first else codes[:0]


def shingles(text: str | None, words: int) -> np.ndarray:
    return next(shingle_sets([text], words))


def set_hash(features: np.ndarray) -> int:
    """One signed 64-bit number per set, whatever the order."""
    return int(np.add.reduce(_mix(features ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64))


def parity_sketch(features: np.ndarray) -> np.ndarray:
    """Is the number of shingles in each cell odd? Sets differ in at least as many shingles as sketches in bits."""
    cell = (_mix(features ^ np.uint64(0x27D4EB2F165667C5)) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=SKETCH_CELLS).astype(np.uint8) & 1).view(np.int64)


def counter_of(features: np.ndarray) -> np.ndarray:
    return (_mix(features ^ np.uint64(0x632BE59BD9B4E019)) & np.uint64(COUNTERS - 1)).astype(np.int64)


def common_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """Flags of the counters with clearly more shingles than chance deals to one."""

    def count(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for features in shingle_sets(_column(batch), words):
                np.add.at(counts, counter_of(features), 1)
        full = np.flatnonzero(counts)
        columns = [pa.array(full), pa.array(counts[full])]
        yield pa.RecordBatch.from_arrays(columns, names=["counter", "n"])

    counts = texts.mapInArrow(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counts = land(counts, "counters")
    mean = (counts.agg(F.sum("n")).first()[0] or 0) / COUNTERS
    flags = np.zeros(COUNTERS, bool)
    # at most COUNTERS numbers
    flags[counts.where(F.col("n") > mean + 8 * mean**0.5 + 16).select("counter").toPandas()["counter"].to_numpy(np.int64)] = True
    return flags


class PartEnum:
    """Signatures for Jaccard similarity of at least ``part / whole``."""

    def __init__(self, part: int, whole: int, sub_parts: int = SUB_PARTS):
        self.part, self.whole, self.sub = part, whole, sub_parts
        self._starts = [1]

    def band(self, size: int) -> int:
        while self._starts[-1] <= size:
            self._starts.append(self._starts[-1] * self.whole // self.part + 1)
        return int(np.searchsorted(self._starts, size, side="right")) - 1

    def distance(self, band: int) -> int:
        """Most differences of two similar sets in the band, or of one with one of the band below."""
        while len(self._starts) < band + 2:
            self._starts.append(self._starts[-1] * self.whole // self.part + 1)
        largest = self._starts[band + 1] - 1
        return (self.whole - self.part) * 2 * largest // (self.whole + self.part)

    def _slack(self, band: int, parts: int) -> int:
        """About twice the parts of a small set of the band that are expected to have an empty choice."""
        per_part = self._starts[max(0, band - 1)] / parts
        return 1 + int(2 * parts * min(1.0, self.sub * np.exp(-per_part * (self.sub - 1) / self.sub)))

    def signatures(self, features: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
        """``common``: flags of ``COUNTERS`` counters whose shingles the first cut leaves out."""
        found, own = [], self.band(len(features))
        rare = features if common is None else features[~common[counter_of(features)]]
        for band in (own, own + 1):
            k = self.distance(band)
            if not k:
                continue  # only equal sets are similar
            least = (k + 2) // 2
            slack = self._slack(band, least)
            parts, level = least + slack, 0
            while True:
                seed = np.uint64((band << 8 | level) * 0x2545F4914F6CDD1D % 2**64)
                placed = _mix((features if level else rare) ^ seed)
                cells = np.uint64(parts * self.sub)
                slot = (((placed >> np.uint64(32)) * cells) >> np.uint64(32)).astype(np.int64)
                sums = np.zeros(parts * self.sub, np.uint64)
                np.add.at(sums, slot, _mix(placed + np.uint64(1)))
                counts = np.bincount(slot, minlength=len(sums)).reshape(parts, self.sub)
                sums = sums.reshape(parts, self.sub)
                rest = sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums
                full = counts.sum(axis=1, keepdims=True) > counts
                name = _mix(seed + np.arange(sums.size, dtype=np.uint64).reshape(sums.shape))
                last = level == LEVELS - 1
                found.append(_mix(rest + name)[full | last])
                if last or int((~full).any(axis=1).sum()) <= slack:
                    break
                level += 1
        return np.concatenate(found) if found else np.empty(0, np.uint64)


def _column(batch: pa.RecordBatch) -> list:
    return batch.column(batch.num_columns - 1).to_pylist()


def _sets(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """(id, n, node, sketch) per row; node and sketch are null for a text without words."""

    def measure(batches):
        for batch in batches:
            found = list(shingle_sets(batch.pop("text").tolist(), words))
            batch["n"] = np.array([len(f) for f in found], np.int64)
            batch["node"] = pd.array([set_hash(f) if len(f) else None for f in found], "Int64")
            for c, own in zip(SKETCH, np.array([parity_sketch(f) for f in found], np.int64).reshape(-1, len(SKETCH)).T):
                batch[c] = own
            yield batch

    kind, sketch = docs.schema["id"].dataType.simpleString(), ", ".join(f"{c} long" for c in SKETCH)
    return docs.mapInPandas(measure, f"id {kind}, n long, node long, {sketch}")


def _signatures(batches, words: int, scheme: PartEnum, common: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(signatures, node of each) per batch; a set is enumerated once as long as it is remembered."""
    seen: set[int] = set()
    for batch in batches:
        codes, nodes, counts = [], [], []
        for features in shingle_sets(_column(batch), words):
            if not len(features):
                continue
            node = set_hash(features)
            if node in seen:
                continue
            if len(seen) >= CACHE:
                seen.clear()
            seen.add(node)
            own = scheme.signatures(features, common)
            codes.append(own)
            nodes.append(node)
            counts.append(len(own))
        if codes:
            yield np.concatenate(codes), np.repeat(np.array(nodes, np.int64), counts)


def shared_signatures(texts: DataFrame, words: int, scheme: PartEnum, common, rows: int) -> DataFrame:
    """``h``: the short hashes of signatures that came from more than one set, and a few others by chance."""
    bits = min(62, int(np.ceil(np.log2(max(2, rows) * SIGNATURES))) + 4)
    owners = max(1, rows * SIGNATURES // OWNED)
    span = -(-(1 << bits) // owners)

    def send(batches):
        held, size = [], 0

        def rows_of():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(values, np.arange(1, owners, dtype=np.int64) * span)
            cuts = np.concatenate([[0], cuts, [len(values)]])
            for owner in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[owner], cuts[owner + 1])
                rice, unary, rest = rice_encode(values[own], int(owner) * span, span)
                twice = np.packbits((counts[own] > 1).astype(np.uint8)).tobytes()
                yield int(owner), len(values[own]), rice, unary, rest, twice

        def batch():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows_of()], schema=schema)

        for codes, _ in _signatures(batches, words, scheme, common.value):
            held.append((codes >> np.uint64(64 - bits)).astype(np.int64))
            size += len(codes)
            if size >= HELD:
                yield batch()
                held, size = [], 0
        if size:
            yield batch()

    schema = pa.schema(
        [("owner", pa.int32()), ("n", pa.int32()), ("rice", pa.int32())] + [(c, pa.binary()) for c in ("unary", "rest", "twice")]
    )

    def meet(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
        base = int(key[0]) * span
        got = [rice_decode(r.n, r.rice, r.unary, r.rest, base) for r in lists.itertuples()]
        twice = [v[np.unpackbits(np.frombuffer(r.twice, np.uint8))[: r.n].astype(bool)] for v, r in zip(got, lists.itertuples())]
        values, senders = np.unique(np.concatenate(got), return_counts=True)
        return pd.DataFrame({"h": np.union1d(values[senders > 1], np.concatenate(twice))})

    sent = texts.mapInArrow(send, "owner int, n int, rice int, unary binary, rest binary, twice binary")
    return land(sent.groupBy("owner").applyInPandas(meet, "h long"), "shared")


def _signature_rows(texts: DataFrame, words: int, scheme: PartEnum, rows: int) -> DataFrame:
    """(sig, node, degree) of the signatures that may occur in several sets; the others never leave their task.

    ``degree``: how many of them the node has. It only ranks nodes, and is the same in every row of a node.
    """
    spark = texts.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(texts, words))
    hashes = shared_signatures(texts, words, scheme, common, rows)
    release(spark)
    bits = min(62, int(np.ceil(np.log2(max(2, rows) * SIGNATURES))) + 4)
    filter_words = spark.sparkContext.broadcast(bloom_build(hashes, hashes.count(), 16, MAX_FILTER_BITS))

    def enumerate_(batches):
        for codes, nodes in _signatures(batches, words, scheme, common.value):
            kept = bloom_has(filter_words.value, (codes >> np.uint64(64 - bits)).astype(np.int64))
            codes, nodes = codes[kept], nodes[kept]
            runs = np.diff(np.flatnonzero(np.diff(nodes) != 0), prepend=-1, append=len(nodes) - 1)
            degree = np.repeat(runs, runs).astype(np.int32)
            columns = [pa.array(codes.view(np.int64)), pa.array(nodes), pa.array(degree)]
            yield pa.RecordBatch.from_arrays(columns, names=["sig", "node", "degree"])

    return texts.mapInArrow(enumerate_, "sig long, node long, degree int")


def _packed(text: str) -> bytes:
    data = text.encode()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> str:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True).decode()


def _candidate_sets(texts: DataFrame, words: int, filter_words: np.ndarray) -> DataFrame:
    """(node, packed) of the sets whose node passes the filter, one row each; ``packed``: a text that has the set."""
    shared = texts.sparkSession.sparkContext.broadcast(filter_words)
    schema = pa.schema([("node", pa.int64()), ("packed", pa.binary())])

    def pick(batches):
        seen: set[int] = set()
        for batch in batches:
            column = _column(batch)
            found = [(text, set_hash(f)) for text, f in zip(column, shingle_sets(column, words)) if len(f)]
            nodes = np.array([node for _, node in found], np.int64)
            if not len(nodes):
                continue
            rows = []
            for i in np.flatnonzero(bloom_has(shared.value, nodes)):
                text, node = found[i]
                if node not in seen:
                    if len(seen) >= CACHE:
                        seen.clear()
                    seen.add(node)
                    rows.append((node, _packed(text)))
            if rows:
                own, packed = (pa.array(c, t) for c, t in zip(zip(*rows), schema.types))
                yield pa.RecordBatch.from_arrays([own, packed], schema=schema)

    return texts.mapInArrow(pick, "node long, packed binary").dropDuplicates(["node"])


class _Possible:
    """Sizes and sketches of the sets, one row per node, and the test they allow."""

    def __init__(self, facts: DataFrame, part: int, whole: int):
        self._narrow, self._part, self._whole = facts, part, whole

    def of(self, column: str, name: str) -> DataFrame:
        """The facts as columns of their own for the nodes in ``column``."""
        facts = {c: f"{name}_{c}" for c in ("n", *SKETCH)}
        return self._narrow.withColumnsRenamed({"node": column, **facts})

    def test(self, a: str, b: str):
        """False only for pairs that cannot be similar."""
        na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
        bits = F.lit(0)
        for c in SKETCH:
            bits = bits + F.bit_count(F.col(f"{a}_{c}").bitwiseXOR(F.col(f"{b}_{c}")))
        sizes = F.least(na, nb) * self._whole >= F.greatest(na, nb) * self._part
        return sizes & (bits * (self._whole + self._part) <= (na + nb) * (self._whole - self._part))

    def filter(self, pairs: DataFrame, a: str, b: str) -> DataFrame:
        both = pairs.join(self.of(a, "a"), a).join(self.of(b, "b"), b)
        return both.where(self.test("a", "b")).select(*pairs.columns)


def _verify(pairs: DataFrame, texts: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """Landed (a, b, linked) for landed pairs, by exact set sizes; only sets in a pair are brought together."""
    count = pairs.count()
    if not count:
        return pairs.select("a", "b", F.lit(False).alias("linked"))
    small = count <= SMALL_PAIRS
    ends = pairs.select("a").union(pairs.select("b")).distinct()
    sets = _candidate_sets(texts, words, bloom_build(ends, 2 * count, 16, MAX_FILTER_BITS))
    sets = land(sets.join(ends.withColumnRenamed("a", "node"), "node", "left_semi"), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("packed").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("packed").alias("y"))
    first = left.join(F.broadcast(pairs), "a") if small else left.join(pairs, "a")
    if small:
        # The other side meets its partner by a join of the few sets that are in a pair.
        right = right.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi")
    both = first.join(right, "b")

    def compare(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = shingle_sets([_unpacked(x.as_py()), _unpacked(y.as_py())], words)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(shared * (whole + part) >= (len(x) + len(y)) * part)
            columns = [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "linked"])

    return land(both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, linked boolean"), "verified")


def links(texts: DataFrame, facts: DataFrame, words: int, part: int, whole: int) -> DataFrame | None:
    """Verified links (a, b) that connect every pair of similar nodes; None if no two sets share a signature.

    ``facts``: n and sketch per node.
    """
    spark = texts.sparkSession
    rows = _signature_rows(texts, words, PartEnum(part, whole), texts.count()).distinct()
    rows = land(rows, "signatures")
    members = land(rows.join(_different_buckets(rows), "sig", "left_semi"), "buckets")
    release(spark)
    if members.isEmpty():
        return None
    nodes = land(members.select("node").distinct(), "nodes")
    candidates = facts.join(nodes, "node", "left_semi")
    possible = _Possible(land(candidates, "facts"), part, whole)
    pairs = land(_hub_pairs(members, possible), "pairs")
    release(spark)
    found = _verify(pairs, texts, words, part, whole).where("linked").select("a", "b")
    labels = _relabel(nodes.select("node", F.col("node").alias("label")), found)
    release(spark)
    return found.unionByName(_cell_links(members, labels, possible, texts, words, part, whole))


def _different_buckets(rows: DataFrame) -> DataFrame:
    """A ``sig`` for each set of several nodes that share one; node sets are known by size and a 64-bit hash."""
    held = F.bit_xor(F.xxhash64("node")).alias("held")
    several = rows.groupBy("sig").agg(F.count("*").alias("size"), held).where("size > 1")
    return several.groupBy("size", "held").agg(F.min("sig").alias("sig")).select("sig")


def _hub_pairs(members: DataFrame, possible: _Possible) -> DataFrame:
    """For each node one pair: with the most connected node of its buckets."""
    tops = members.groupBy("sig").agg(F.max(F.struct("degree", "node")).alias("top"))
    apart = members.join(tops, "sig").where(F.col("node") != F.col("top.node"))
    apart = apart.groupBy("node", F.col("top.node").alias("hub")).agg(F.max("top.degree").alias("degree"))
    apart = possible.filter(apart, "node", "hub")
    best = apart.groupBy("node").agg(F.max(F.struct("degree", "hub")).alias("best"))
    hub = F.col("best.hub")
    return best.select(F.least("node", hub).alias("a"), F.greatest("node", hub).alias("b")).distinct()


CELL = ["cell", "asked", "held"]


def _cell_links(
    members: DataFrame, labels: DataFrame, possible: _Possible, texts: DataFrame, words: int, part: int, whole: int
) -> DataFrame:
    """Links between the groups of buckets that still hold several, enough to join all that are similar."""
    named = members.join(labels, "node")
    tops = named.groupBy("sig").agg(
        F.max(F.struct("degree", "node", "label")).alias("top"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    mixed = tops.where("low < high").select("sig", F.col("top.label").alias("cell"))
    rows = land(named.join(mixed, "sig").select("cell", "node", "label").distinct(), "cells")
    facts = rows.join(possible.of("node", "f"), "node")
    met = land(_streamed(_dealt(facts, SKETCH_BLOCK), _possible_nodes(part, whole), "cell long, node long, label long"), "met")
    rows = land(met.distinct(), "partners")
    release(texts.sparkSession)
    count = rows.count()
    if not count:
        return rows.select(F.col("node").alias("a"), F.col("node").alias("b"))
    nodes = rows.select("node").distinct()
    sets = _candidate_sets(texts, words, bloom_build(nodes, count, 16, MAX_FILTER_BITS))
    rows = _dealt(rows, SET_BLOCK).join(sets, "node")
    return land(_streamed(rows, _forest(words, part, whole), "a long, b long").distinct(), "links")


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Rows of cells dealt to tasks: each block of outsiders meets each block of all nodes.

    ``asks`` marks the outsiders of a task, ``holds`` its nodes. An outsider is both in one of the tasks, by one row.
    """
    outside = F.col("label") != F.col("cell")
    sizes = rows.groupBy("cell").agg(F.count("*").alias("all"), F.count_if(outside).alias("out"))
    sizes = sizes.where("out > 0").select(
        "cell", F.ceil(F.col("all") / block).cast("int").alias("helds"), F.ceil(F.col("out") / block).cast("int").alias("askeds")
    )
    rows = rows.join(sizes, "cell")
    place = F.xxhash64("node", "cell")

    def spread(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    columns = [c for c in rows.columns if c not in ("helds", "askeds")]
    asker, holder = (F.pmod(place, n).cast("int") for n in ("askeds", "helds"))
    asking = rows.where(outside).select(*columns, asker.alias("asked"), holder.alias("own"), spread("helds").alias("held"))
    asking = asking.where("held <> own").select(*columns, "asked", "held", F.lit(True).alias("asks"), F.lit(False).alias("holds"))
    held = rows.select(*columns, asker.alias("own"), holder.alias("held"), spread("askeds").alias("asked"))
    both = outside & (F.col("asked") == F.col("own"))
    return asking.unionByName(held.select(*columns, "asked", "held", both.alias("asks"), F.lit(True).alias("holds")))


def _streamed(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the rows of each task of ``_dealt`` in turn, many small ones in one stream."""
    dealt = rows.repartition(*CELL).sortWithinPartitions(*CELL)

    def run(batches):
        held: list[pa.RecordBatch] = []

        def made(parts):
            table = pa.Table.from_batches(parts).combine_chunks()
            keys = [table.column(c).to_numpy() for c in CELL]
            new = np.zeros(len(table), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            cuts = np.append(np.flatnonzero(new), len(table))
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                found = work(table.slice(begin, end - begin))
                if found is not None and found.num_rows:
                    yield found

        def last(batch):
            return tuple(batch.column(c)[-1].as_py() for c in CELL)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and last(held[-1]) != last(batch):  # the task of the last rows ends in this batch
                key, same = last(held[-1]), np.ones(batch.num_rows, bool)
                for c, k in zip(CELL, key):
                    same &= batch.column(c).to_numpy() == k
                n = int(same.sum())
                yield from made([*held, batch.slice(0, n)])
                held, batch = [], batch.slice(n)
            held.append(batch)
        if held:
            yield from made(held)

    return dealt.mapInArrow(run, schema)


def _possible_nodes(part: int, whole: int):
    """Work that returns the nodes of a task that may be similar to one of another group."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        asks, holds = rows.column("asks").to_numpy(), rows.column("holds").to_numpy()
        label, n = rows.column("label").to_numpy(), rows.column("f_n").to_numpy()
        sketch = np.stack([rows.column(f"f_{c}").to_numpy() for c in SKETCH], axis=1).view(np.uint64)
        held = np.flatnonzero(holds)
        wanted = np.zeros(len(asks), bool)
        for i in np.flatnonzero(asks):
            bits = np.bitwise_count(sketch[held] ^ sketch[i]).sum(axis=1).astype(np.int64)
            total = n[held] + n[i]
            fits = (np.minimum(n[held], n[i]) * whole >= np.maximum(n[held], n[i]) * part) & (label[held] != label[i])
            fits &= bits * (whole + part) <= total * (whole - part)
            wanted[held[fits]] = True
            wanted[i] |= fits.any()
        return pa.RecordBatch.from_arrays(
            [pa.array(rows.column(c).to_numpy()[wanted]) for c in ("cell", "node", "label")], names=["cell", "node", "label"]
        )

    return work


def _forest(words: int, part: int, whole: int):
    """Work that compares the whole sets of a task and returns links that join two groups."""

    def work(rows: pa.Table) -> pa.RecordBatch | None:
        asks, holds, node, label = (rows.column(c).to_numpy() for c in ("asks", "holds", "node", "label"))
        held, queries = np.flatnonzero(holds), np.flatnonzero(asks)
        if not len(held) or not len(queries):
            return None
        sets = list(shingle_sets((_unpacked(p.as_py()) for p in rows.column("packed")), words))
        size = np.array([len(s) for s in sets])
        # an index of the held sets: which of them have a shingle
        flat = np.concatenate([sets[i] for i in held])
        owner = np.repeat(np.arange(len(held)), size[held])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        group: dict[int, int] = {}

        def find(x: int) -> int:
            while group.setdefault(x, x) != x:
                group[x] = group[group[x]]
                x = group[x]
            return x

        out = []
        for i in queries:
            own = sets[i]
            begin, end = np.searchsorted(flat, own), np.searchsorted(flat, own, side="right")
            many = end - begin
            at = np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())
            shared = np.bincount(owner[at], minlength=len(held))
            linked = shared * (whole + part) >= (size[held] + size[i]) * part
            for j in held[linked & (label[held] != label[i])]:
                a, b = find(int(label[i])), find(int(label[j]))
                if a != b:
                    group[a] = b
                    out.append((int(node[i]), int(node[j])))
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return work


def _relabel(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Merge groups along the links found: components over labels, a table of one row per candidate."""
    ends = found.join(labels.withColumnsRenamed({"node": "a", "label": "u"}), "a")
    ends = ends.join(labels.withColumnsRenamed({"node": "b", "label": "v"}), "b")
    groups = connected_components(ends.select(F.col("u").alias("a"), F.col("v").alias("b")))
    moved = labels.join(groups.withColumnsRenamed({"node": "label", "component": "to"}), "label", "left")
    return land(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    part: int = 80,
    whole: int = 100,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id.

    Words are split at ASCII white space, A-Z lower-cased; a set holds the
    distinct ``words``-word shingles, or the whole sequence if it is shorter. Two
    rows link when ``whole`` * intersection >= ``part`` * union. component_id is
    the smallest id reachable. A null text, or one without words, has 0 shingles
    and its own id as component. Repeated rows and equal texts are linked. A null
    id is never the smallest. An empty table gives no rows; other columns are not
    read. Shingles and sets are identified by 64-bit hashes.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sized = land(_sets(texts, text_col, words), "sized")
    known = sized.where("node is not null")
    classes = known.groupBy("node").agg(F.min("id").alias("low"))
    facts = known.groupBy("node").agg(*[F.min(c).alias(c) for c in ("n", *SKETCH)])
    found = links(texts, facts, words, part, whole)
    if found is not None:
        groups = connected_components(found)
        roots = F.coalesce("component", "node")
        rooted = classes.join(groups, "node", "left").select("node", "low", roots.alias("root"))
        lowest = rooted.groupBy("root").agg(F.min("low").alias("low"))
        classes = rooted.select("node", "root").join(lowest, "root").select("node", "low")
    empty = sized.where("node is null").withColumn("low", F.col("id")).select("id", "n", "low")
    full = sized.where("node is not null").join(classes, "node").select("id", "n", "low")
    return full.unionByName(empty).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("low").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row of each group of near copies, that with the smallest id, with all columns of ``docs``.

    Rows are told apart by their place in a landed copy, not by their id: of rows
    that share an id only the near copies go, and of rows with a null id one per
    group stays (a null id counts as greater than all others). Rows without words stay.
    """
    place, root = fresh(docs, "place", "root")
    text_col = options.pop("text_col", "text")
    landed = with_place(docs, id_col, place)
    known = landed.select(F.col(place), F.col(id_col))
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(place))
    said = similar_documents(landed.select(F.col(place), F.col(text_col)), place, text_col, **options)
    said = land(said.where("n_shingles > 0").select(F.col(place), F.col("component_id").alias(root)), "components")
    grouped = said.groupBy(root).agg(F.count("*").alias("size")).where("size > 1").select(root)
    members = said.join(grouped, root).join(known, place)
    best = members.groupBy(root).agg(F.min(order).alias("best"))
    kept = best.select(F.col("best")[place].alias(place))
    dropped = members.select(place).join(kept, place, "left_anti")
    return without_ids(landed, place, dropped).select(*docs.columns)


def without_ids(docs: DataFrame, id_col: str, dropped: DataFrame) -> DataFrame:
    """Anti-join that shuffles only rows a Bloom filter of bounded size takes for dropped ones."""
    key, flag = fresh(docs, "key", "flag")
    shared = land(dropped.select(F.col(dropped.columns[0]).alias(key)), "dropped")
    hashed = shared.select(F.xxhash64(key).alias("h"))
    test = bloom_test(docs.sparkSession, bloom_build(hashed, shared.count(), 16, MAX_FILTER_BITS))
    marked = docs.withColumn(flag, test(F.xxhash64(id_col)))
    suspects = marked.where(F.col(flag)).join(shared, F.col(id_col) == F.col(key), "left_anti")
    return marked.where(~F.col(flag)).unionByName(suspects).drop(flag)
