"""The pipeline's stages against brute force, each on what the one before kept."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rowtide.llm import mixing
from rowtide.llm.common import land
from rowtide.llm.tokens import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def _shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def _near(rows):
    """Ids that go: all but the smallest of each component."""
    sets = {i: _shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, own in sorted(sets.items()):
        for s in own:
            holders[s].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(sets):
        shared = Counter(b for s in sets[a] for b in holders[s] if b > a)
        for b, n in shared.items():
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {i for i in sets if find(i) != i}


@pytest.fixture(scope="module")
def stages(llm):
    documents = llm.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = llm.createDataFrame(
        [(10**6, None, "en", None, 0), (10**6 + 1, "", None, "s", 0), (10**6 + 2, "123 ...", "en", "s", 7)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    frames = [land(documents.unionByName(odd), "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(land(stage(llm, frames[-1], SF_DIR), name))
    return frames


def _pairs(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "jaccard_join", "mixing", "best_fit_packing",
    ]
    assert all(f.columns == stages[0].columns for f in stages[:-1])


def test_language_stage_drops_only_rows_without_letters(stages):
    expected = [(i, t) for i, t in _pairs(stages[0]) if t and any(c.isalpha() for c in t)]
    assert Counter(_pairs(stages[1])) == Counter(expected) and len(expected) < len(_pairs(stages[0]))


def test_exact_stage_keeps_the_greatest_id_of_each_text(stages):
    best = {}
    for i, t in _pairs(stages[1]):
        best[t] = max(i, best.get(t, i))
    assert Counter(_pairs(stages[2])) == Counter((i, t) for t, i in best.items())


def test_near_stage_keeps_the_smallest_id_of_each_group(stages):
    rows = _pairs(stages[2])
    gone = _near(rows)
    assert Counter(_pairs(stages[3])) == Counter(r for r in rows if r[0] not in gone)


def test_mixing_stage_takes_what_the_mix_says(stages):
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(stages[3]).collect()}
    taken = Counter(i for i, _ in _pairs(stages[4]))
    assert taken == Counter({i: n for i, n in copies.items() if n}) and max(taken.values()) == 2


def test_packing_stage_places_every_token_once(stages):
    code, total = Encoder(), Counter()
    for i, t in _pairs(stages[4]):
        total[i] += len(code.encode(t)) // 4 + 1
    placed = stages[5].collect()
    got, fill = Counter(), defaultdict(list)
    for r in placed:
        got[r.doc_id] += r.length
        fill[r.sequence_id].append((r.offset, r.length))
    assert got == total
    for pieces in fill.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(fill) <= -(-sum(total.values()) // 2048) + 1


def test_nothing_in_nothing_out(llm):
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = land(stage(llm, docs, SF_DIR), name)
        assert docs.count() == 0


def test_language_stage_rejects_long_texts_in_no_language(llm):
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(1)
    junk = " ".join("".join(rng.choice(list("qxzjkwvpbmhg"), 6)) for _ in range(200))
    odd = llm.createDataFrame([(-1, junk, None), (-2, "привет мир, как дела сегодня " * 20, None), (-3, "zxq", None)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(llm, docs.unionByName(odd), SF_DIR).collect()}
    assert not kept & {-1, -2} and -3 in kept


def test_rows_that_share_an_id_and_odd_columns_pass_all_stages(llm, docs):
    frame = land(docs, "documents")
    for name, stage in corpus_pipeline.STAGES:
        frame = land(stage(llm, frame, SF_DIR), name)
    assert frame.count() > 0


def test_without_languages_the_same_rows_stay(llm):
    docs = llm.createDataFrame(
        [(1, "words", None), (2, None, None), (3, "12", None), (4, "é", None)], "doc_id long, text string, lang string"
    )
    assert {r.doc_id for r in corpus_pipeline.identify_language(llm, docs, SF_DIR).collect()} == {1, 4}
