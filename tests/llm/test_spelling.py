import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import spelling
from rowtide.llm.queries import QUERIES

SMALL = str.maketrans(spelling.CAPITALS, spelling.SMALL)


def naive_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def naive(docs):
    counts = naive_words(docs)
    letters = sorted({c for w in counts for c in w})
    near, form = {}, {}
    for word, n in counts.items():
        found = {e for e in edits(word, letters) if e in counts and e != word}
        near[word] = len(found)
        best = min(found, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n, near[word], counts[form[word]] if form[word] else None))
    return out


def rows(frame):
    return [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    stems = ["straßenbahn", "communication", "Éléphants", "abcdefgh", "question", "x" * 60, "×÷multiply"]
    out = [(0, None), (1, ""), (None, "Question question questions"), (2, "short words only")]
    for i in range(60):
        words = []
        for stem in stems:
            words += [stem] * int(rng.integers(1, 30))
            for _ in range(6):
                at, c = int(rng.integers(0, len(stem))), chr(rng.choice([97, 98, 101, 0xE9, 0xC9, 0xFF]))
                words += [stem[:at] + stem[at + 1 :], stem[:at] + c + stem[at:], stem[:at] + c + stem[at + 1 :]]
        letters = list("abcdefgh")
        for _ in range(40):  # many words of the same letters
            rng.shuffle(letters)
            words.append("".join(letters))
        out.append((i, " ".join(words) + ("-" if i % 2 else "\n")))
    return out + out[5:9]


def test_variants_match_brute_force(llm, corpus):
    frame = llm.createDataFrame(corpus, "doc_id long, text string")
    clash = frame.withColumns({c: F.lit("x") for c in ("word", "n", "key", "root", "form", "id", "run")}).repartition(4)
    want = naive(corpus)
    assert any(r[1] is not None and r[2] != r[1] for r in want) or any(r[1] for r in want)
    for options in ({}, {"depth": 2}, {"groups": 6, "depth": 6}, {"most": 5}, {"groups": 3, "most": 1}, {"together": 30}):
        got = rows(spelling.spelling_variants(clash, **options))
        assert len(got) == len(set(got)) and set(got) == want, options


def test_crowded_subtrees_are_halved(llm):
    rng = np.random.default_rng(7)
    letters, words = list("aabbccdd"), set()
    for _ in range(1500):
        rng.shuffle(letters)
        words.add("".join(letters))
        words.add("".join(letters) + "e")
    docs = [(1, " ".join(sorted(words) * 2))]
    got = rows(spelling.spelling_variants(llm.createDataFrame(docs, "doc_id long, text string"), groups=3, most=20))
    assert set(got) == naive(docs) and len(got) == len(set(got))


def test_subtrees_stay_whole_over_batches(llm):
    """Several batches of one subtree arrive after the rows that are searched together."""
    rng = np.random.default_rng(11)
    letters, words = list("aabbccdd"), set()
    for _ in range(1200):
        rng.shuffle(letters)
        words.add("".join(letters))
        words.add("".join(letters) + "e")
    docs = [(1, " ".join(sorted(words) * 2))]
    frame = llm.createDataFrame(docs, "doc_id long, text string")
    size = llm.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = rows(spelling.spelling_variants(frame, groups=6, depth=6, together=60))
    finally:
        llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert set(got) == naive(docs) and len(got) == len(set(got))


def test_chains_of_forms_end_at_one_root(llm):
    chain = [("wordsaa", "wordsab"), ("wordsab", "wordsbb"), ("wordsbb", "wordbbb"), ("wordbbb", "worbbbb"), ("lonesome", "lonesom")]
    got = {r[0]: r[1] for r in spelling.roots_of(llm.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {"wordsaa": "worbbbb", "wordsab": "worbbbb", "wordsbb": "worbbbb", "wordbbb": "worbbbb", "lonesome": "lonesom"}


def test_one_apart_agrees_with_the_wide_comparison():
    words = ["abcdefg", "abcdefh", "abcdef", "abcdefgh", "xbcdefg", "aabcdefg", "abdcefg", "y" * 50, "y" * 51, "y" * 49 + "z"]
    told = spelling.Words(words)
    a, b = map(np.ravel, np.indices((len(words), len(words))))
    assert told.near(a, b).tolist() == [spelling.one_apart(words[i], words[j]) for i, j in zip(a, b)]
    may = told.may_be_near(np.arange(len(words)), np.arange(len(words))).ravel()
    assert may[told.near(a, b)].all() and not may.all()
    assert spelling.one_apart("abcdefg", "abcdefh") and not spelling.one_apart("abcdefg", "abdcefg")


def test_registered_query_and_empty_table(llm):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert set(rows(QUERIES["op11_spelling_variants"](llm, sf))) == naive(docs)
    assert rows(spelling.spelling_variants(llm.createDataFrame([], "doc_id long, text string"))) == []
