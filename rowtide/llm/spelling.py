r"""Spelling variants: words one code point apart, found in a frequency-vector trie.

A word is arranged by how often each letter group occurs in it, group after
group. Two words that differ by one inserted, deleted or replaced code point
differ by at most one surplus and one deficit over all groups, so a depth-first
search through the trie of count vectors spends a budget of one each. What is
left at the leaves is verified on the words themselves.

The top levels of the trie are spread over tasks: a subtree is named by the
counts of the first ``depth`` groups. A word lies in its own subtree and, one
count less, in that of each group it has; two near words share exactly one subtree
in which the smaller counts of both meet. The depth is the least at which no subtree holds
more than ``SUBTREE`` words; subtrees that do at full depth are divided once more
by the first or the second half of the word, one of which near words share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import land

RUN = "[A-Za-z\\u00C0-\\u00FF]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
SHARE = 31  # one run in so many loses a code point
RATIO = 10  # times as often as its variant must a form occur

# Letter groups: the most frequent letters have their own, the others share the last ones.
GROUPS = 24
# Words a subtree may hold before its words are arranged by further groups.
SUBTREE = 20_000
# Rows that are searched together in one trie, and words under a node that are compared directly.
TOGETHER = 60_000
LEAF = 64
# Longest word compared in fixed-width rows; longer ones are compared one by one.
WIDTH = 40
CELLS = 4 << 20


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of the words with at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences.

    Shorter runs cannot become words, so they are not taken out of the text.
    """
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"{RUN}{{{MIN_LENGTH},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    run = F.translate("run", CAPITALS, SMALL)
    runs = runs.select("id", run.alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % SHARE == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each of the 256 possible letters: by how many words have it, ties by code point."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter"))
    found = letters.where("letter <> ''").groupBy("letter").count().collect()  # 90 rows at most
    order = sorted(found, key=lambda r: (-r["count"], r["letter"]))
    table = np.full(256, groups - 1, np.int64)
    for place, row in enumerate(order):
        table[ord(row["letter"])] = place if place < groups - 1 else groups - 1
    return table


def count_vectors(words: list[str], table: np.ndarray, groups: int) -> np.ndarray:
    """One row per word: how often each letter group occurs in it."""
    joined = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.bincount(owner * groups + table[joined], minlength=len(words) * groups)
    return flat.reshape(len(words), groups).astype(np.int32)


def _key(counts: np.ndarray) -> np.ndarray:
    """Big-endian bytes of each row, so that keys sort like the counts."""
    rows = np.ascontiguousarray(counts.astype(">u4"))
    return np.array([r.tobytes() for r in rows], dtype=object)


MEMBERS = "key binary, word string, n long, less int"


def members(words: DataFrame, table: np.ndarray, groups: int, depth: int, own: bool = False) -> DataFrame:
    """A row per subtree a word lies in (``own``: its own only); ``less`` is the group that counts one less there, or -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            top = count_vectors(texts, table, groups)[:, :depth]
            at, less = np.nonzero(top[: 0 if own else None])
            lower = top[at]
            lower[np.arange(len(at)), less] -= 1
            source = np.concatenate([np.arange(len(texts)), at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_key(np.concatenate([top, lower])), pa.binary()),
                    batch.column(0).take(pa.array(source)),
                    pa.array(n[source], pa.int64()),
                    pa.array(np.concatenate([np.full(len(texts), -1), less]), pa.int32()),
                ],
                names=["key", "word", "n", "less"],
            )

    return words.select("word", "n").mapInArrow(run, MEMBERS)


def choose_depth(words: DataFrame, table: np.ndarray, groups: int, most: int) -> int:
    """The least number of top levels at which every subtree has at most ``most`` own words."""
    for depth in range(2, groups, 2):
        largest = members(words, table, groups, depth, own=True).groupBy("key").count().agg(F.max("count")).first()[0]
        if (largest or 0) <= most:
            return depth
    return groups


class Words:
    """Words as fixed-width rows of bytes and hashes of their halves, for verifying many pairs at once.

    Of two words one code point apart whose shorter one has ``m`` code points, the
    first ``m // 2`` or the last ``m - m // 2`` are the same. Each word has
    hashes of both for its own length and for one less; the length is hashed in.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.array([len(w) for w in words])
        self.width = int(min(WIDTH, self.size.max(initial=1)))
        fitting = [w.encode("latin-1") if len(w) <= self.width else b"" for w in words]
        shape = (len(words), self.width)
        self.left = np.frombuffer(b"".join(w.ljust(self.width, b"\0") for w in fitting), np.uint8).reshape(shape)
        self.right = np.frombuffer(b"".join(w.rjust(self.width, b"\0") for w in fitting), np.uint8).reshape(shape)
        halves = [
            (hash((w[: m // 2], m)), hash((w[len(w) - m + m // 2 :], m)))
            for w in words
            for m in (len(w), len(w) - 1)
        ]
        self.halves = np.array(halves, np.int64).reshape(len(words), 2, 2)

    def may_be_near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Do words of ``a`` (a column) and ``b`` (a row) share a half?"""
        out = np.zeros((len(a), len(b)), bool)
        for side in (0, 1):
            (a0, a1), (b0, b1) = self.halves[a, :, side].T, self.halves[b, :, side].T
            out |= (a0[:, None] == b0) | (a1[:, None] == b0) | (a0[:, None] == b1)
        return out

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs are one code point apart: their common head and tail leave one out."""
        longest = np.maximum(self.size[a], self.size[b])
        shortest = np.minimum(self.size[a], self.size[b])
        differ = self.left[a] != self.left[b]
        head = np.where(differ.any(1), differ.argmax(1), self.width)
        differ = (self.right[a] != self.right[b])[:, ::-1]
        tail = np.where(differ.any(1), differ.argmax(1), self.width)
        head, tail = np.minimum(head, shortest), np.minimum(tail, shortest)
        out = (head + tail >= longest - 1) & (head < longest) & (longest - shortest <= 1)
        for i in np.flatnonzero(longest > self.width):
            out[i] = one_apart(self.words[a[i]], self.words[b[i]])
        return out


def search(levels: np.ndarray, less: np.ndarray, first: np.ndarray, words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of words one code point apart, each pair once.

    ``levels``: the counts below the top levels, ``first``: the number of the
    subtree, ``less``: the group left out on the way there. All words are queries;
    at each node the queries whose budget reaches it go on together, and a leaf is
    verified against the queries that reach it. A pair is met by its earlier word.
    """
    rows = np.column_stack([first, less, levels]).astype(np.int32)
    order = np.lexsort(rows.T[::-1])
    rows, depth = rows[order], rows.shape[1]
    one = np.ones(len(rows), np.int8)
    stack = [(0, len(rows), 0, np.arange(len(rows)), one, one)]
    while stack:
        low, high, level, alive, surplus, deficit = stack.pop()
        if level >= 2 and (high - low <= LEAF or level == depth):
            step = max(1, CELLS // (high - low))
            leaf = np.arange(low, high)
            for start in range(0, len(alive), step):
                some = alive[start : start + step]
                at, other = np.nonzero(words.may_be_near(order[some], order[leaf]))
                at, other = some[at], leaf[other]
                kept = at < other
                a, b = order[at[kept]], order[other[kept]]
                kept = words.near(a, b)
                if kept.any():
                    yield a[kept], b[kept]
            continue
        column = rows[low:high, level]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [high - low]])
        own = rows[alive, level]
        for begin, end in zip((low + cuts[:-1]).tolist(), (low + cuts[1:]).tolist()):
            value = rows[begin, level]
            if level == 0:  # another subtree
                stack.append((begin, end, 1, alive[begin:end], surplus[begin:end], deficit[begin:end]))
                continue
            earlier = np.searchsorted(alive, end)
            gap = own[:earlier] - value
            s, t = surplus[:earlier], deficit[:earlier]
            if level == 1:  # what was left out above is spent
                kept = (gap != 0) | (value == -1)
                s, t = s - (own[:earlier] >= 0), t - (value >= 0)
            else:
                kept = (gap <= s) & (-gap <= t)
                s, t = s - (gap > 0), t - (gap < 0)
            if kept.any():
                stack.append((begin, end, level + 1, alive[:earlier][kept], s[kept].astype(np.int8), t[kept].astype(np.int8)))


def one_apart(a: str, b: str) -> bool:
    """Do two words differ by exactly one inserted, deleted or replaced code point?"""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    head = 0
    while head < len(short) and short[head] == long[head]:
        head += 1
    return short[head + (len(short) == len(long)) :] == long[head + 1 :]


FOUND = "word string, n_near long, best_n long, best string"


def _best(frame: pd.DataFrame, table: np.ndarray, groups: int, depth: int, halves: np.ndarray | None) -> pd.DataFrame:
    """Per word with near words among ``frame``: their number, and the one of largest n, least text."""
    words = frame["word"].tolist()
    less, n = frame["less"].to_numpy(), frame["n"].to_numpy()
    first = pd.factorize(frame["key"])[0]
    levels = count_vectors(words, table, groups)[:, depth:]
    by_text = np.empty(len(words), np.int64)
    by_text[np.argsort(np.array(words, dtype=object), kind="stable")] = np.arange(len(words))
    near = np.zeros(len(words), np.int64)
    from_rank = np.lexsort((by_text, -n))
    rank = np.empty(len(words), np.int64)
    rank[from_rank] = np.arange(len(words))
    top = np.full(len(words), len(words), np.int64)
    for a, b in search(levels, less, first, Words(words)):
        if halves is not None:
            kept = _meet_here(frame, halves, a, b)
            a, b = a[kept], b[kept]
        for x, y in ((a, b), (b, a)):
            np.add.at(near, x, 1)
            np.minimum.at(top, x, rank[y])
    has = np.flatnonzero(near)
    best = from_rank[top[has]]
    return pd.DataFrame(
        {"word": [words[i] for i in has], "n_near": near[has], "best_n": n[best], "best": [words[i] for i in best]}
    )


def _meet_here(frame: pd.DataFrame, halves: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of pairs that share both halves only those that met by the first one."""
    size, words = halves, frame["word"].to_numpy()
    second = frame["half"].to_numpy() == 2
    shared = np.array([words[i][: size[i]] == words[j][: size[i]] for i, j in zip(a, b)], bool)
    return ~second[a] | ~shared if len(a) else np.zeros(0, bool)


def _searched(rows: DataFrame, table: np.ndarray, groups: int, depth: int, halved: bool, together: int) -> DataFrame:
    """Streams sorted members, some whole subtrees at a time, through the trie search."""
    by = ["key"]
    columns = ["key", "word", "n", "less", *(["half", "size"] if halved else [])]
    sorted_rows = rows.select(*columns).repartition(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def made(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            frame = frame.reset_index(drop=True)
            found = _best(frame, table, groups, depth, frame["size"].to_numpy() if halved else None)
            if len(found):
                yield found

        for batch in batches:
            if not len(batch):
                continue
            if size >= together:
                # compared one by one: numpy takes the zero bytes off the end of the key it compares an array with
                last = held[-1]["key"].iloc[-1]
                others = np.flatnonzero([key != last for key in batch["key"]])
                if len(others):  # the last subtree ends here
                    held.append(batch.iloc[: others[0]])
                    yield from made(pd.concat(held))
                    held, size, batch = [], 0, batch.iloc[others[0] :]
            held.append(batch)
            size += len(batch)
        if size:
            yield from made(pd.concat(held))

    return sorted_rows.mapInPandas(run, FOUND)


def _halved(rows: DataFrame) -> DataFrame:
    """Members of crowded subtrees once by the first and once by the second half of the subtree's length."""
    short = F.length("word") - (F.col("less") >= 0).cast("int")
    size = F.floor(short / 2).cast("int")
    half = F.explode(F.array(F.lit(1), F.lit(2))).alias("half")
    rows = rows.select("key", "word", "n", "less", size.alias("size"), half)
    part = F.when(F.col("half") == 1, F.substring("word", F.lit(1), F.col("size"))).otherwise(
        F.right("word", short - F.col("size"))
    )
    key = F.concat("key", F.col("half").cast("string").cast("binary"), part.cast("binary"))
    return rows.withColumn("key", key)


def near_words(
    words: DataFrame, groups: int = GROUPS, most: int = SUBTREE, depth: int | None = None, together: int = TOGETHER
) -> DataFrame:
    """(word, n_near, best_n, best): of (word, n) those with near words, and the near word of largest n."""
    table = letter_groups(words, groups)
    depth = depth or choose_depth(words, table, groups, most)
    rows = land(members(words, table, groups, depth), "members")
    crowded = rows.groupBy("key").count().where(F.col("count") > most * (depth + 1)).select("key")
    if depth < groups or crowded.isEmpty():
        found = _searched(rows, table, groups, depth, False, together)
    else:
        calm = _searched(rows.join(crowded, "key", "left_anti"), table, groups, depth, False, together)
        dense = _halved(rows.join(crowded, "key", "left_semi"))
        found = calm.unionByName(_searched(dense, table, groups, depth, True, together))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) by following (word, form) to the end: each round doubles the way gone.

    A form occurs ``RATIO`` times as often as its word, so ways are short and have no circles.
    """
    now = land(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = land(step, "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: int = GROUPS,
    most: int = SUBTREE,
    depth: int | None = None,
    together: int = TOGETHER,
) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; a null id counts as the empty text in the
    checksum. Repeated rows count each; of near words that occur equally often the least in
    code-point order is the form. An empty table gives no rows. Other columns are
    not read.
    """
    words = land(word_counts(docs, id_col, text_col), "words")
    near = land(near_words(words, groups, most, depth, together), "near")
    rows = words.join(near, "word", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    rows = land(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = roots_of(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
