"""URL rules and host lists behind Bloom filter cascades.

A cascade answers membership in a list exactly for every key of a known
universe. Level 0 encodes the listed keys. Level 1 encodes the keys of the
universe that level 0 takes for listed, level 2 the listed keys that level 1
takes for false ones, and so on until a level errs on no key. A lookup stops at
the first level that does not hold the key: listed if that is an odd level.

The universe is every key of the corpus that could be listed. The lists are
joined to it once, while the cascade is built; pages are judged without a join,
next to where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm.common import bloom_build, bloom_has, bloom_test, land

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BITS_PER_KEY = 12
# Bits of one level that are held in memory; a fuller level only needs more levels.
MAX_LEVEL_BITS = 1 << 28
MAX_LEVELS = 64


@dataclass(frozen=True)
class Cascade:
    levels: tuple[np.ndarray, ...]

    def __contains__(self, key_hash: int) -> bool:
        return bool(self.has(np.array([key_hash], np.int64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Is the key listed? Exact for the universe's keys."""
        listed = np.zeros(len(hashes), bool)
        left = np.arange(len(hashes))
        for level, words in enumerate(self.levels):
            inside = bloom_has(words, hashes[left], salt=level)
            listed[left[~inside]] = level % 2 == 1
            left = left[inside]
        listed[left] = len(self.levels) % 2 == 1
        return listed


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """From two tables of one string column ``key``; both may repeat keys."""
    keys = universe.select("key").distinct()
    flagged = keys.join(listed.select("key").distinct().withColumn("listed", F.lit(True)), "key", "left")
    flagged = land(flagged.select(F.xxhash64("key").alias("h"), F.coalesce("listed", F.lit(False)).alias("listed")), "universe")
    encode, test, levels = flagged.where("listed").select("h"), flagged.where("not listed").select("h"), []
    while count := encode.count():
        if len(levels) == MAX_LEVELS:
            raise ValueError("a listed and an unlisted key cannot be told apart")
        salt = len(levels)
        words = bloom_build(encode, count, BITS_PER_KEY, MAX_LEVEL_BITS, salt=salt)
        levels.append(words)
        passes = bloom_test(universe.sparkSession, words, salt=salt)
        encode, test = test.where(passes("h")), encode
        encode = land(encode, "level")
    return Cascade(tuple(levels))


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """All keys of the given shapes (labels of the host, characters of the path) a URL has, longest first.

    Only shapes that occur in a list can match it, so no other key is looked up.
    """
    labels = F.split(host, r"\.")
    parts = []
    for count, width in sorted(set(shapes)):
        key = F.concat(F.array_join(F.slice(labels, -count, count), "."), F.substring(path, 1, width))
        parts.append(F.when((F.size(labels) >= count) & (F.length(path) >= width), key))
    keys = F.array_distinct(F.filter(F.array(*parts), lambda k: k.isNotNull()))
    order = F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key")))
    return F.transform(F.sort_array(order, asc=False), lambda s: s["key"])


def _shape(host: str, path: str) -> tuple[int, int]:
    return host.count(".") + 1, len(path)


def _first_member(spark: SparkSession, cascade: Cascade):
    shared = spark.sparkContext.broadcast(cascade)

    @F.pandas_udf("int")
    def first(hashes: pd.Series) -> pd.Series:
        counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
        owner = np.repeat(np.arange(len(hashes)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        flat = np.concatenate([np.empty(0, np.int64), *hashes]).astype(np.int64)
        hit = shared.value.has(flat)
        out = np.full(len(hashes), -1, np.int32)
        # Backwards, so that the first hit is written last.
        out[owner[hit][::-1]] = place[hit][::-1]
        return pd.Series(out)

    return first


def _keys(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("key", T.StringType())]))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed_hosts: DataFrame,
    listed_labels: Sequence[int],
    url_col: str = "url",
) -> DataFrame:
    """``pages`` with one more column ``judged``: struct(host, path, rule, verdict). One of that name is replaced.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest rule wins, of equally long ones a blocking one. Without a rule the
    verdict is block if the host or a parent domain is in ``listed_hosts`` (column
    ``key``; ``listed_labels``: the numbers of labels its hosts have), else allow.
    A null URL, or one without ``://``, has empty host and path. Repeated rows are
    judged each; an empty table gives no rows.
    """
    spark, url = pages.sparkSession, F.col(url_col)
    host, path = url_host(url), url_path(url)
    shapes = [_shape(r.host, r.path) for r in rules]
    by_rule = candidate_keys(host, path, shapes) if shapes else F.array().cast("array<string>")
    by_host = candidate_keys(host, path, [(n, 0) for n in listed_labels]) if listed_labels else F.array().cast("array<string>")
    keys = land(pages.select(F.explode(by_rule).alias("key")).distinct(), "keys")
    block = build_cascade(keys, _keys(spark, [r.key for r in rules if r.verdict == "block"]))
    allow = build_cascade(keys, _keys(spark, [r.key for r in rules if r.verdict == "allow"]))
    hosts = build_cascade(pages.select(F.explode(by_host).alias("key")), listed_hosts)

    def first(cascade: Cascade, keys: Column) -> Column:
        return _first_member(spark, cascade)(F.transform(keys, lambda k: F.xxhash64(k)))

    found = F.struct(
        host.alias("host"), path.alias("path"), by_rule.alias("keys"), first(block, by_rule).alias("block"),
        first(allow, by_rule).alias("allow"), first(hosts, by_host).alias("listed"),
    )
    judged = pages.withColumn("judged", found)
    j = F.col("judged")
    length = lambda at: F.length(F.get(j["keys"], at))
    blocked = (j["block"] >= 0) & ((j["allow"] < 0) | (length(j["block"]) >= length(j["allow"])))
    at = F.when(blocked, j["block"]).when(j["allow"] >= 0, j["allow"])
    verdict = (
        F.when(blocked, "block").when(j["allow"] >= 0, "allow").when(j["listed"] >= 0, "block").otherwise("allow")
    )
    return judged.withColumn(
        "judged",
        F.struct(j["host"].alias("host"), j["path"].alias("path"), F.get(j["keys"], at).alias("rule"), verdict.alias("verdict")),
    )
