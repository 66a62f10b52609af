r"""Language-model scores of texts by a hashed maximum-entropy model.

The next word is predicted in factors: its class, its bin within the class, itself
within the bin. Class and bin are softmax layers over hashed features of the
words before it (bigram, the word before the last, and n-grams of bins); the last
factor is the word's share of its bin. Frequent words have a bin of their own, all
others share one by their last letters, and one bin stands for unknown words, trained on
the words that occur once. All factors are normalised, so scores are probabilities
over the known words and one unknown one.

1. Texts become chunks: word numbers of many documents and the chunk's own dictionary,
   in which words are known by 62-bit hashes.
2. Each chunk sends its sorted hashes, Rice coded, to the owners of hash ranges. An
   owner adds up the counts and answers each chunk with the corpus counts of its words.
   What is exchanged grows with the distinct words of the chunks.
3. Training runs in rounds, each over its own share of the chunks. Every task starts from the
   broadcast weights and takes sparse gradient steps in numpy over its chunks;
   the changes of all tasks are averaged per feature row, weighted by their gradients.
4. The chunks are scored with the final weights.

Weights have a fixed size (``ROWS`` by ``CLASSES`` and by ``BINS``): 13 MB are
broadcast and collected a round, whatever the corpus. Everything else stays distributed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import land, release
from rowtide.llm.exact_dedup import rice_decode, rice_encode
from rowtide.sources.storage import Storage, scratch_dir

END = b"\n"  # no word holds white space
FOLDS, HELD_OUT = 5, 1
SMOOTH = 0.5

# A chunk ends after so many bytes of text or distinct words.
CHUNK_BYTES = 8 << 20
CHUNK_WORDS = 250_000
HASH_BITS = 62
# Dictionary entries an owner of hashes receives, about.
OWNED = 1 << 20

# Classes, and bins of a class. The first half of the classes holds the bins of frequent words.
CLASSES, BINS = 16, 32
LEAVES = CLASSES * BINS
FREQUENT = LEAVES // 2  # with the unknown word, which is bin 0 of class 0
ROWS = 1 << 16  # feature rows of a layer; row numbers are 16-bit
# Rounds at least, and chunks a task trains on in one at most: a lost task repeats no more than that.
ROUNDS, TASK_CHUNKS = 3, 8
RATE = 0.25
STEP = 8192  # tokens of a gradient step
BLOCKS = 64  # parts the weights are averaged in
LAYERS = (CLASSES, BINS)

LOG10 = math.log(10.0)


def tokenise(text: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` with A-Z in lower case, then the end."""
    return [*text.lower().split(), END]


class Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, byte plane by byte plane, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(blob, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, count * 4, codec="zstd"), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def hash_words(words: list[bytes]) -> np.ndarray:
    digests = map(xxhash.xxh3_64_intdigest, words)
    return (np.fromiter(digests, np.uint64, len(words)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def suffix_leaves(words: list[bytes]) -> np.ndarray:
    """The leaf a word shares with others: class by its last byte, bin by the one before."""
    half = CLASSES // 2
    found = ((half + w[-1] % half) * BINS + w[-2 if len(w) > 1 else -1] % BINS for w in words)
    return np.fromiter(found, np.int64, len(words))


def leaves_of(hashes: np.ndarray, suffixes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The leaf of each word: its own if it is frequent. Ranks go round the classes, so that each has frequent and rarer words."""
    half = CLASSES // 2
    order = np.argsort(frequent)
    ranks = order + 1
    own = (ranks % half) * BINS + ranks // half
    at = np.minimum(np.searchsorted(frequent[order], hashes), max(0, len(frequent) - 1))
    found = frequent[order][at] == hashes if len(frequent) else np.zeros(len(hashes), bool)
    return np.where(found, own[at] if len(frequent) else 0, suffixes)


CHUNK = (
    "chunk long, ids array<{kind}>, train array<boolean>, sizes array<long>, tokens binary, hashes binary, suffixes binary, "
    "seen binary"
)


def chunks(docs: DataFrame) -> DataFrame:
    """Rows ``id, text (binary), train`` as chunks: word numbers, distinct words, their number in training documents."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids, train, sizes, tokens, size = [], [], [], [], 0
        known = Numbers()

        def made() -> pa.RecordBatch:
            flat, words = np.concatenate(tokens), list(known)
            seen = np.bincount(flat[np.repeat(np.array(train, bool), sizes)], minlength=len(words))
            blobs = [pack(flat), hash_words(words).astype("<i8").tobytes(), pack(suffix_leaves(words)), pack(seen)]
            row = [number, ids, train, sizes, *blobs]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            types = [pa.int64(), pa.list_(batch.column(0).type), pa.list_(pa.bool_()), pa.list_(pa.int64()), *[pa.binary()] * 4]
            for ident, text, learn in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = tokenise(text)
                tokens.append(np.fromiter(map(known.__getitem__, own), np.uint32, len(own)))
                ids.append(ident)
                train.append(learn)
                sizes.append(len(own))
                size += len(text)
                if size >= CHUNK_BYTES or len(known) >= CHUNK_WORDS:
                    yield made()
                    number += 1
                    ids, train, sizes, tokens, size, known = [], [], [], [], 0, Numbers()
        if ids:
            yield made()

    names = [c.split()[0] for c in CHUNK.split(", ")]
    return docs.select("id", "text", "train").mapInArrow(run, CHUNK.format(kind=kind))


ASKED = "chunk long, owner int, n int, rice int, unary binary, rest binary, seen binary, suffixes binary"
ANSWER = "chunk long, owner int, n int, counts binary, tokens long, words long, leaves binary, top binary"
TOP = np.dtype([("c", "<i8"), ("hash", "<i8"), ("suffix", "<i8")])


def count_words(parts: DataFrame, owners: int) -> DataFrame:
    """Per chunk and owner the corpus counts of the chunk's words there, by hash; per owner (chunk null) its sums.

    The sums: training tokens and distinct words, what its words weigh in their
    suffix leaves (``WEIGHTS`` by leaf), and its most frequent words.
    """
    span = -(-(1 << HASH_BITS) // owners)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes = np.frombuffer(batch.column("hashes")[i].as_buffer(), "<i8")
                seen, suffixes = (unpack(batch.column(c)[i].as_buffer(), len(hashes)) for c in ("seen", "suffixes"))
                order = np.argsort(hashes)
                hashes, seen, suffixes = hashes[order], seen[order], suffixes[order]
                cuts = np.searchsorted(hashes, np.arange(1, owners, dtype=np.int64) * span)
                cuts = np.concatenate([[0], cuts, [len(hashes)]])
                rows = []
                for owner in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[owner], cuts[owner + 1])
                    rice, unary, rest = rice_encode(hashes[own], int(owner) * span, span)
                    sizes = (batch.column("chunk")[i].as_py(), int(owner), int(cuts[owner + 1] - cuts[owner]), rice)
                    rows.append((*sizes, unary, rest, pack(seen[own]), pack(suffixes[own])))
                yield _batch(rows, ASKED)

    def answer(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
        lists = lists.sort_values("chunk")
        base = int(key[0]) * span
        got = [rice_decode(r.n, r.rice, r.unary, r.rest, base) for r in lists.itertuples()]
        values, first, at = np.unique(np.concatenate(got), return_index=True, return_inverse=True)
        seen = np.concatenate([unpack(r.seen, r.n) for r in lists.itertuples()])
        suffixes = np.concatenate([unpack(r.suffixes, r.n) for r in lists.itertuples()])[first].astype(np.int64)
        c = np.bincount(at, seen, len(values)).astype(np.int64)
        ends = np.cumsum([len(g) for g in got])
        rows = [
            (r.chunk, key[0], r.n, pack(np.minimum(c[at[e - r.n : e]], (1 << 32) - 1)), None, None, None, None)
            for r, e in zip(lists.itertuples(), ends)
        ]
        known = np.flatnonzero(c)
        best = known[np.lexsort((values[known], -c[known]))][: FREQUENT - 1]
        top = np.array(list(zip(c[best], values[best], suffixes[best])), TOP)
        leaves = np.stack([np.bincount(suffixes[known], w, LEAVES) for w in weights(c[known])])
        rows.append((None, key[0], None, None, int(c.sum()), len(known), leaves.astype("<f8").tobytes(), top.tobytes()))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in ANSWER.split(", ")], dtype=object)

    asked = parts.select("chunk", "hashes", "seen", "suffixes").mapInArrow(ask, ASKED)
    return land(asked.groupBy("owner").applyInPandas(answer, ANSWER), "answers")


def weights(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What known words add to their leaf: share inside it, mass of the leaf, mass of the unknown word."""
    return c + SMOOTH, np.where(c > 1, c, 0.0) + SMOOTH, (c == 1) * 1.0


@dataclass
class Model:
    """All that a task needs to train or score: bounded arrays."""

    tokens: int  # N
    distinct: int  # V
    frequent: np.ndarray  # hashes, most frequent first
    inside: np.ndarray  # per leaf: the sum of c + 0.5 over its words
    bias: tuple[np.ndarray, np.ndarray]  # of classes, of bins
    weights: tuple[np.ndarray, np.ndarray]
    energy: tuple[np.ndarray, np.ndarray]  # squared gradients of each row so far

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + SMOOTH) / (self.tokens + SMOOTH * (self.distinct + 1)))


def start_model(answers: DataFrame) -> Model:
    """The model before training: every layer predicts by corpus counts alone."""
    sums = answers.where("chunk IS NULL")
    n, v = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per task: the sums of its owners, and the most frequent of their words."""
        total, top = np.zeros((3, LEAVES)), np.zeros(0, TOP)
        for batch in batches:
            for i in range(batch.num_rows):
                total += np.frombuffer(batch.column(0)[i].as_buffer(), "<f8").reshape(3, LEAVES)
                top = _best(np.concatenate([top, np.frombuffer(batch.column(1)[i].as_buffer(), TOP)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.tobytes()], pa.binary()), pa.array([top.tobytes()], pa.binary())], names=["leaves", "top"]
        )

    shape = "leaves binary, top binary"
    few = sums.select("leaves", "top").mapInArrow(fold, shape).coalesce(1).mapInArrow(fold, shape).collect()
    total, top = np.zeros((3, LEAVES)), np.zeros(0, TOP)
    for row in few:
        total = total + np.frombuffer(row["leaves"], "<f8").reshape(3, LEAVES)
        top = _best(np.concatenate([top, np.frombuffer(row["top"], TOP)]))
    top = top[top["c"] > 1]
    frequent = np.ascontiguousarray(top["hash"]).astype(np.int64)
    own = leaves_of(frequent, top["suffix"].astype(np.int64), frequent)
    for sums_of, part in zip(total, weights(top["c"].astype(float))):  # frequent words move to leaves of their own
        np.subtract.at(sums_of, top["suffix"].astype(np.int64), part)
        np.add.at(sums_of, own, part)
    inside, mass, once = total
    mass[0], inside[0] = once.sum() + SMOOTH, 1.0
    mass = np.where(inside > SMOOTH / 2, mass, 0.0)
    bins = mass.reshape(CLASSES, BINS)
    tiny = math.exp(-30.0)
    bias = tuple(np.log(np.maximum(m, tiny * mass.sum())).astype(np.float32) for m in (bins.sum(1), bins))
    layers = tuple(np.zeros((ROWS, ways), np.float32) for ways in LAYERS)
    return Model(n, v, frequent, inside, bias, layers, tuple(np.ones(ROWS, np.float32) for _ in LAYERS))


def _best(top: np.ndarray) -> np.ndarray:
    return top[np.lexsort((top["hash"], -top["c"]))][: FREQUENT - 1]


READY = (
    "chunk long, ids array<{kind}>, train array<boolean>, sizes array<long>, tokens binary, n int, hashes binary, leaves binary, "
    "counts binary"
)


def with_counts(parts: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Chunks whose dictionary holds corpus counts, leaves and short hashes."""
    kind = parts.schema["ids"].dataType.elementType.simpleString()
    told = F.sort_array(F.collect_list(F.struct("owner", "n", "counts"))).alias("told")
    lists = answers.where("chunk IS NOT NULL").groupBy("chunk").agg(told)
    frequent = model.frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for i in range(batch.num_rows):
                hashes = np.frombuffer(batch.column("hashes")[i].as_buffer(), "<i8")
                suffixes = unpack(batch.column("suffixes")[i].as_buffer(), len(hashes))
                counts = np.empty(len(hashes), np.int64)
                counts[np.argsort(hashes)] = np.concatenate([unpack(t["counts"], t["n"]) for t in batch.column("told")[i].as_py()])
                leaves = leaves_of(hashes, suffixes, frequent)
                blobs.append((len(hashes), (hashes >> 30).astype("<u4").tobytes(), pack(leaves), pack(counts)))
            columns = [batch.column(c) for c in ("chunk", "ids", "train", "sizes", "tokens")]
            columns += [pa.array(x, t) for x, t in zip(zip(*blobs), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in READY.split(", ")])

    return parts.drop("seen").join(lists, "chunk").mapInArrow(run, READY.format(kind=kind))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(48)).astype(np.uint16)


class Sequence:
    """The tokens of a chunk's documents with the features of their histories."""

    def __init__(self, sizes: np.ndarray, token: np.ndarray, hashes: np.ndarray, leaves: np.ndarray, counts: np.ndarray):
        self.sizes, self.token, self.counts = sizes, token, counts
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.at = np.full(len(token), 2, np.int8)  # place in the document, up to the third
        self.at[self.starts[sizes > 1] + 1] = 1
        self.at[self.starts] = 0
        self.hashes, self.bins = hashes, leaves.astype(np.uint16)
        self.target = np.where(counts > 0, leaves, 0)  # what scores are about: words nobody trained on are one
        self.learned = np.where(counts > 1, leaves, 0)  # what is trained: words that occur once stand for these

    def _before(self, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Number and leaf of the word ``k`` before each place; 1 and 0 before the first."""
        there = self.at[s] >= k
        token = self.token[np.where(there, s - k, 0)]
        number = np.where(there, self.hashes[token].astype(np.uint64) + np.uint64(3), np.uint64(1))
        return number, np.where(there, self.bins[token].astype(np.uint64) + np.uint64(1), np.uint64(0))

    def rows(self, s: np.ndarray, group: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Feature rows of the class layer and of the bin layer, at the places ``s``."""
        (a, p), (b, q) = self._before(s, 1), self._before(s, 2)
        g = group.astype(np.uint64)
        six = np.uint64(6)
        return [_mix(a, 1), _mix(b, 2), _mix(p << np.uint64(16) | q, 3)], [_mix(a << six | g, 4), _mix(p << six | g, 5)]


def softmax(bias: np.ndarray, weights: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per token the probability of each way, and what its logarithm is short of the logits: (e, z) with p = e / e.sum."""
    z = bias + weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z -= z.max(axis=1, keepdims=True)
    return np.exp(z), z


def _chosen(parts: tuple[np.ndarray, np.ndarray], way: np.ndarray) -> np.ndarray:
    """Log-probabilities of the chosen ways."""
    e, z = parts
    return z[np.arange(len(way)), way] - np.log(e.sum(axis=1))


def _gradient(parts: tuple[np.ndarray, np.ndarray], way: np.ndarray) -> np.ndarray:
    """Of minus the log-likelihood, by logits."""
    e, _ = parts
    e /= e.sum(axis=1, keepdims=True)
    e[np.arange(len(way)), way] -= 1.0
    return e


def _step(weights: np.ndarray, energy: np.ndarray, rows: np.ndarray, gradient: np.ndarray, rate: float) -> None:
    """Add the gradients per feature row and move the row against them, less the more it has moved."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    last = np.flatnonzero(np.concatenate([ordered[1:] != ordered[:-1], [True]]))
    sums = np.cumsum(gradient[order], axis=0, dtype=np.float64)[last]
    total = sums.astype(np.float32)
    total[1:] = sums[1:] - sums[:-1]
    at = ordered[last]
    energy[at] += np.einsum("ij,ij->i", total, total)
    total *= (rate / np.sqrt(energy[at]))[:, None]
    weights[at] -= total


def train_chunk(model: Model, seq: Sequence, learned: np.ndarray, rate: float = RATE) -> None:
    """One pass of gradient steps over the tokens of training documents; words that occur once train the unknown bin."""
    places = np.flatnonzero(learned)
    for start in range(0, len(places), STEP):
        s = places[start : start + STEP]
        group, way = np.divmod(seq.learned[seq.token[s]], BINS)
        rows = seq.rows(s, group)
        for layer, (bias, right) in enumerate(((model.bias[0], group), (model.bias[1][group], way))):
            gradient = _gradient(softmax(bias, model.weights[layer], rows[layer]), right)
            for r in rows[layer]:
                _step(model.weights[layer], model.energy[layer], r, gradient, rate)


def token_scores(model: Model, seq: Sequence) -> np.ndarray:
    """log10 of the probability of every token."""
    out = np.empty(len(seq.token))
    inside = np.log10(np.where(seq.target == 0, 1.0, (seq.counts + SMOOTH) / np.maximum(model.inside[seq.target], SMOOTH / 2)))
    for start in range(0, len(out), STEP):
        s = np.arange(start, min(start + STEP, len(out)))
        group, way = np.divmod(seq.target[seq.token[s]], BINS)
        rows = seq.rows(s, group)
        classes = _chosen(softmax(model.bias[0], model.weights[0], rows[0]), group)
        bins = _chosen(softmax(model.bias[1][group], model.weights[1], rows[1]), way)
        out[s] = (classes.astype(float) + bins) / LOG10 + inside[seq.token[s]]
    return out


def _sequences(batches: Iterator[pa.RecordBatch]):
    """(batch, row, sequence) of every chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            blob = {c: batch.column(c)[i].as_buffer() for c in ("tokens", "hashes", "leaves", "counts")}
            sizes, n = np.array(batch.column("sizes")[i].as_py(), np.int64), batch.column("n")[i].as_py()
            leaves, counts = (unpack(blob[c], n).astype(np.int64) for c in ("leaves", "counts"))
            yield batch, i, Sequence(sizes, unpack(blob["tokens"], int(sizes.sum())), np.frombuffer(blob["hashes"], "<u4"), leaves, counts)


CHANGE = "layer int, block int, trainer int, change binary, scale binary, energy binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = [c.split() for c in schema.split(", ")]
    arrays = [pa.array(values, kinds[kind]) for values, (_, kind) in zip(zip(*rows), columns)]
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in columns])


def _trained(ready: DataFrame, model: Model, trainers: int) -> DataFrame:
    """Per task and block of rows: how the weights changed (bytes, scaled per row), and the squared gradients behind it."""
    shared = ready.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start: Model = shared.value
        copies = (tuple(x.copy() for x in arrays) for arrays in (start.weights, start.energy))
        own = replace(start, **dict(zip(("weights", "energy"), copies)))
        moved = False
        for batch, i, seq in _sequences(batches):
            train_chunk(own, seq, np.repeat(np.array(batch.column("train")[i].as_py(), bool), seq.sizes))
            moved = True
        for layer in range(len(LAYERS)) if moved else ():
            change, energy = own.weights[layer] - start.weights[layer], own.energy[layer] - start.energy[layer]
            scale = np.maximum(np.abs(change).max(axis=1), 1e-20).astype("<f4") / 127
            coded = np.rint(change / scale[:, None]).astype(np.int8)
            parts = (np.split(x, BLOCKS) for x in (coded, scale, energy.astype("<f4")))
            rows = [(layer, b, TaskContext.get().partitionId(), *(x.tobytes() for x in xs)) for b, xs in enumerate(zip(*parts))]
            yield _batch(rows, CHANGE)

    return ready.coalesce(trainers).mapInArrow(run, CHANGE)


MERGED = "layer int, block int, change binary, energy binary"


def _averaged(changes: DataFrame) -> DataFrame:
    """Per block the changes of all tasks, averaged by the squared gradients of each row; they stream by in order."""
    rows = changes.repartition("layer", "block").sortWithinPartitions("layer", "block", "trainer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, weight = None, None, None

        def made() -> pa.RecordBatch:
            change = (total / np.maximum(weight, 1e-12)[:, None]).astype("<f4").tobytes()
            return _batch([(*current, change, weight.astype("<f4").tobytes())], MERGED)

        for batch in batches:
            for i in range(batch.num_rows):
                place = (batch.column("layer")[i].as_py(), batch.column("block")[i].as_py())
                coded, scale, energy = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                    for c, kind in (("change", np.int8), ("scale", "<f4"), ("energy", "<f4"))
                )
                if place != current:
                    if current is not None:
                        yield made()
                    current, total, weight = place, np.zeros((len(scale), LAYERS[place[0]])), np.zeros(len(scale))
                total += coded.reshape(len(scale), -1) * (scale * energy.astype(float))[:, None]
                weight += energy
        if current is not None:
            yield made()

    return rows.mapInArrow(run, MERGED)


def train(spark: SparkSession, read_round, model: Model, rounds: int = ROUNDS) -> Model:
    """``rounds`` rounds of updates; ``read_round(r)`` gives the chunks of a round."""
    trainers = spark.sparkContext.defaultParallelism
    for r in range(rounds):
        merged = sorted(_averaged(_trained(read_round(r), model, trainers)).collect(), key=lambda x: (x["layer"], x["block"]))
        for layer, ways in enumerate(LAYERS if merged else ()):
            own = [x for x in merged if x["layer"] == layer]
            change = np.concatenate([np.frombuffer(x["change"], "<f4") for x in own]).reshape(ROWS, ways)
            energy = np.concatenate([np.frombuffer(x["energy"], "<f4") for x in own])
            model = replace(
                model,
                weights=tuple(w + change if i == layer else w for i, w in enumerate(model.weights)),
                energy=tuple(e + energy if i == layer else e for i, e in enumerate(model.energy)),
            )
        release(spark)
    return model


SCORES = "id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(ready: DataFrame, model: Model) -> DataFrame:
    """One row per document of the chunks."""
    kind = ready.schema["ids"].dataType.elementType.simpleString()
    shared = ready.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        for batch, i, seq in _sequences(batches):
            values = ((seq.counts > 0)[seq.token] * 1, own.base(seq.counts)[seq.token], token_scores(own, seq))
            sums = [np.add.reduceat(v, seq.starts) for v in values]
            held = ~np.array(batch.column("train")[i].as_py(), bool)
            ids = batch.column("ids")[i].values
            total = np.full(len(held), own.tokens, np.int64)
            columns = [ids, held, seq.sizes, sums[0], total, sums[1], sums[2]]
            names = [c.split()[0] for c in SCORES.split(", ")]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return ready.mapInArrow(run, SCORES.format(kind=kind))


def rounds_for(parts: int, trainers: int) -> int:
    return max(ROUNDS, math.ceil(parts / (trainers * TASK_CHUNKS)))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: one token, the end. A null id counts as the empty text in
    the checksum that holds documents out. Repeated rows are learned from and
    scored each. Without training documents every token is unknown. An empty table
    gives no rows. ``rounds`` follows the number of chunks and cores unless given. Other columns are not read. The texts of one document must fit a task.
    """
    spark = docs.sparkSession
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        (F.crc32(ident) % FOLDS != HELD_OUT).alias("train"),
    )
    whole = scratch_dir(spark, "chunks")
    chunks(rows).write.option("compression", "zstd").parquet(whole)
    parts = spark.read.parquet(whole)
    size, count = parts.agg(F.coalesce(F.sum(F.octet_length("hashes")), F.lit(0)), F.count("*")).first()
    rounds = rounds or rounds_for(count, spark.sparkContext.defaultParallelism)
    answers = count_words(parts, max(1, math.ceil(size / 8 / OWNED)))
    release(spark)
    model = start_model(answers)
    path = scratch_dir(spark, "ready")
    ready = with_counts(parts, answers, model).withColumn("round", F.pmod(F.xxhash64("chunk"), F.lit(rounds)).cast("int"))
    ready.write.partitionBy("round").option("compression", "zstd").parquet(path)
    Storage(spark).delete(whole)  # all of it is in ``ready`` now
    release(spark)
    schema = ready.schema

    def read_round(r: int | None) -> DataFrame:
        table = spark.read.schema(schema).parquet(path)
        return (table if r is None else table.where(F.col("round") == r)).drop("round")

    model = train(spark, read_round, model, rounds)
    return score(read_round(None), model).withColumnRenamed("id", id_col)
