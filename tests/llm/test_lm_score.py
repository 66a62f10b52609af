import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import lm_score
from rowtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return [*out, None]


def naive(docs):
    """The contract's columns, token by token."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    counts = Counter(t for (_, text), h in zip(docs, held) if not h for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, text), h in zip(docs, held):
        own = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((i, h, len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def rows(frame, id_col="doc_id"):
    return [tuple(r) for r in frame.select(id_col, *COLUMNS).collect()]


def close(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)


def test_counts_and_base_match_brute_force(docs):
    clash = docs.withColumns({c: F.lit(1) for c in ("train", "chunk", "words", "round", "tokens", "score")})
    got = rows(lm_score.score_documents(clash, rounds=2))
    close(got, naive([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert all(r[6] <= 1e-6 for r in got)


def test_empty_table_and_no_training_documents(llm):
    empty = llm.createDataFrame([], "doc_id long, text string")
    assert rows(lm_score.score_documents(empty)) == []
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = rows(lm_score.score_documents(llm.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")))
    assert {r[1:5] for r in got} == {(True, 3, 0, 0)}
    assert all(r[5] == 0 and math.isfinite(r[6]) and r[6] <= 1e-6 for r in got)


@pytest.fixture(scope="module")
def trained(llm):
    """A model trained as the operator does, with chunks of the smallest table."""
    docs = llm.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id id", "CAST(coalesce(text, '') AS binary) text")
    docs = docs.withColumn("train", F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 1)
    parts = lm_score.chunks(docs).cache()
    answers = lm_score.count_words(parts, 5)
    model = lm_score.start_model(answers)
    ready = lm_score.with_counts(parts, answers, model).cache()
    counts = Counter(t for r in docs.where("train").collect() for t in lm_score.tokenise(bytes(r["text"])))
    before = {r[0]: r[-1] for r in lm_score.score(ready, model).collect()}
    model = lm_score.train(llm, lambda r: ready, model, rounds=2)
    return docs, counts, model, ready, before


def leaves(model, words):
    return lm_score.leaves_of(lm_score.hash_words(words), lm_score.suffix_leaves(words), model.frequent).tolist()


def naive_scores(model, counts, text):
    """Token by token with plain sums, from the model's arrays; also the total probability after each history."""
    words = list(counts)
    leaf_of = dict(zip(words, leaves(model, words)))
    one = lambda x: np.array([x], np.uint64)
    mix = lambda x, salt: int(lm_score._mix(one(x % 2**64), salt)[0])
    number = lambda w: int(lm_score.hash_words([w])[0] >> 30) + 3
    tokens = lm_score.tokenise(text)
    bins = [x + 1 for x in leaves(model, tokens)]
    total = 0.0
    for t, token in enumerate(tokens):
        a, p = (number(tokens[t - 1]), bins[t - 1]) if t else (1, 0)
        b, q = (number(tokens[t - 2]), bins[t - 2]) if t > 1 else (1, 0)
        z = model.bias[0].astype(float)
        for row in (mix(a, 1), mix(b, 2), mix(p << 16 | q, 3)):
            z = z + model.weights[0][row]
        classes = np.exp(z) / np.exp(z).sum()
        inside = np.zeros((lm_score.CLASSES, lm_score.BINS))
        for g in range(lm_score.CLASSES):
            z = model.bias[1][g].astype(float)
            for row in (mix(a << 6 | g, 4), mix(p << 6 | g, 5)):
                z = z + model.weights[1][row]
            inside[g] = np.exp(z) / np.exp(z).sum()
        both = (classes[:, None] * inside).ravel()
        assert abs(both.sum() - 1) < 1e-6
        leaf = leaf_of[token] if token in counts else 0
        share = (counts[token] + 0.5) / model.inside[leaf] if token in counts else 1.0
        total += math.log10(both[leaf] * share)
    return total


def test_scores_are_those_of_the_model_and_probabilities(trained):
    docs, counts, model, ready, _ = trained
    words = list(counts)
    assert {lm_score.hash_words([w])[0] for w, _ in counts.most_common(50)} <= set(model.frequent)
    assert len(set(leaves(model, words)) & set(range(lm_score.LEAVES // 2))) == len(model.frequent)
    inside = np.bincount(leaves(model, words), [counts[w] + 0.5 for w in words], lm_score.LEAVES)
    assert np.allclose(inside[1:], model.inside[1:]) and inside[0] == 0  # shares in each leaf sum to one
    short = docs.orderBy(F.length("text")).limit(25).collect()
    got = {r[0]: r[-1] for r in lm_score.score(ready, model).collect()}
    for r in short:
        assert got[r["id"]] == pytest.approx(naive_scores(model, counts, bytes(r["text"])), abs=1e-3)


def test_training_helps_held_out_documents(trained):
    docs, _, model, ready, before = trained
    got = lm_score.score(ready, model).where("held_out").collect()
    assert sum(r["score"] for r in got) > sum(before[r["id"]] for r in got) > sum(r["base_score"] for r in got)


def test_gradient_step_is_that_of_the_log_likelihood():
    rng = np.random.default_rng(0)
    bias, weights = rng.normal(size=8).astype(np.float32), rng.normal(size=(6, 8)).astype(np.float64)
    rows, target = [np.array([0, 1, 1, 2]), np.array([3, 3, 4, 5])], np.array([1, 2, 2, 7])
    loss = lambda w: -lm_score._chosen(lm_score.softmax(bias, w, rows), target).sum()
    gradient = lm_score._gradient(lm_score.softmax(bias, weights, rows), target)
    moved, energy = weights.copy(), np.full(6, 1e12)
    for r in rows:
        lm_score._step(moved, energy, r, gradient, 1e6)
    for at in np.ndindex(6, 8):
        probe = weights.copy()
        probe[at] += 1e-6
        assert (weights - moved)[at] == pytest.approx((loss(probe) - loss(weights)) / 1e-6, abs=1e-4)


def test_registered_query(llm):
    docs = [tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(QUERIES["op13_lm_score"](llm, SF))
    close(got, naive(docs))
    assert got and rows(QUERIES["op13_lm_score"](llm, SF)) == got


def test_rounds_grow_with_the_chunks_of_a_task():
    assert [lm_score.rounds_for(n, 6) for n in (0, 1, 144, 145, 48_000)] == [3, 3, 3, 4, 1000]
