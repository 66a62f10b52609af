"""The operators' plain functions against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowtide.llm import chat_format, exact_dedup, html_extract, jaccard_join, lang_id, packing, vector_dedup
from rowtide.llm.queries import QUERIES
from rowtide.llm.tokens import Encoder, default_tokenizer


@given(st.lists(st.integers(0, 1 << 20), min_size=1, max_size=60, unique=True), st.integers(0, 1 << 40))
def test_rice_round_trip(values, base):
    values = np.array(sorted(values), np.int64) + base
    rice, unary, rest = exact_dedup.rice_encode(values, base, 1 << 21)
    assert exact_dedup.rice_decode(len(values), rice, unary, rest, base).tolist() == values.tolist()


def _jaccard(a, b):
    inter = len(np.intersect1d(a, b))
    return inter, len(a) + len(b) - inter


@pytest.mark.parametrize("part,sub", [(90, 3), (80, 3), (80, 2), (60, 4)])
def test_similar_sets_share_a_signature(part, sub):
    rng = np.random.default_rng(part + sub)
    scheme, similar = jaccard_join.PartEnum(part, 100, sub), 0
    for _ in range(400):
        size = int(rng.integers(2, 150))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = a.copy()
        change = int(rng.integers(1, 1 + max(1, size * (110 - part) // 200)))
        b = np.delete(b, rng.choice(len(b), min(change, len(b) - 1), replace=False))
        b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, change + 1))).astype(np.uint64)]))
        inter, union = _jaccard(a, b)
        if 100 * inter >= part * union and inter != union:
            similar += 1
            assert np.intersect1d(scheme.signatures(a), scheme.signatures(b)).size, (len(a), len(b), inter)
    assert similar > 100


def test_shingles():
    same = jaccard_join.shingles
    assert same("A b\x0bC", 3).tolist() == same("a B c", 3).tolist()
    assert len(same("a b c a b c a", 3)) == 3
    assert len(same("a b", 3)) == 1 and len(same(" \t", 3)) == 0 and len(same(None, 3)) == 0
    assert same("Ä", 1).tolist() != same("ä", 1).tolist()
    assert same("a b c", 2).tolist() != same("a b c", 2).tolist()


TEXTS = st.text(
    st.one_of(st.sampled_from(list("ab 'st1,\n\t<|>ñ日 ")), st.characters(codec="utf-8")), max_size=60
)


@pytest.fixture(scope="module")
def coders():
    from tokenizers import Tokenizer

    return Encoder(), Tokenizer.from_file(default_tokenizer())


def test_ids_are_the_tokenizers(coders):
    fast, plain = coders

    @settings(max_examples=400, deadline=None)
    @given(TEXTS)
    def same(text):
        got = np.frombuffer(fast.encode(text), "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids

    same()
    text = "a<|endoftext|> b  <|endoftext|>"
    assert np.frombuffer(fast.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def _best_fit(lengths, capacity):
    """Document by document, by looking at every open sequence."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@given(st.lists(st.integers(1, 32), max_size=120))
@settings(deadline=None)
def test_plan_is_best_fit_decreasing(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit_plan(histogram, 32)
    fill = {}
    for length, count in histogram.items():
        sequence, offset = plan.place(np.full(count, length), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            fill.setdefault(s, []).append((o, length))
    rooms = []
    for pieces in fill.values():
        pieces.sort()
        assert all(o == sum(n for _, n in pieces[:i]) for i, (o, _) in enumerate(pieces))
        rooms.append(32 - sum(n for _, n in pieces))
    assert sorted(rooms) == _best_fit(lengths, 32) and len(fill) == plan.sequences


@given(st.integers(1, 100), st.integers(1, 20))
def test_cut_loses_nothing(tokens, capacity):
    pieces = packing.cut(tokens, capacity)
    assert [s for s, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
    assert sum(n for _, n in pieces) == tokens
    assert all(n == capacity for _, n in pieces[1:]) and pieces[0][1] <= capacity


CHATS = st.text(st.sampled_from(list("<|>\\im_endstart\nx ")), max_size=40)


@given(CHATS, CHATS)
def test_chat_escape(role, text):
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert "<|" not in chat_format.escape(text)
    assert chat_format.read_turn(chat_format.chatml([(role, text)])) == (role, text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), CHATS), max_size=9), st.integers(1, 4))
@settings(deadline=None)
def test_spans_make_up_the_rendering(turns, window):
    def template(shown):
        return "<s>" + chat_format.chatml(shown)

    records = list(chat_format.render_turns(turns, template, window))
    whole = "".join(r["span"] for r in records)
    assert not turns or whole == template(turns)
    for (_, text), r in zip(turns, records):
        assert whole[r["text_start"] : r["text_end"]] == chat_format.escape(text) and not r["rewrites"]


def test_rewritten_history_is_detected():
    def forgetful(turns):
        """Drops the text of all assistant turns but the last."""
        last = max((i for i, (role, _) in enumerate(turns) if role == "assistant"), default=-1)
        return "".join(f"[{r}]{t if r != 'assistant' or i == last else ''}" for i, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    made = [r["rewrites"] for r in chat_format.render_turns(turns, forgetful)]
    assert made == [False, False, False, True]
    # An empty text cannot be told from a dropped one, but the probe finds it.
    upper = list(chat_format.render_turns([("user", "a")], lambda ts: "".join(t.upper() for _, t in ts)))
    assert upper[0]["text_start"] is None


def _chat(n):
    return [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(n)]


def test_templates_that_look_far_back():
    """Prefixes start at the first turn, however long the conversation."""

    def keeps_last(turns):
        return "".join(f"[{r}]{t}" for r, t in turns[-100:])

    made = list(chat_format.render_turns(_chat(130), keeps_last))
    assert [r["rewrites"] for r in made] == [False] * 100 + [True] * 30
    for i, r in enumerate(made):  # spans of rewriting turns lie where the new rendering has them
        whole = keeps_last(_chat(i + 1))
        assert whole[r["start"] :] == r["span"] and whole[r["text_start"] : r["text_end"]] == f"turn {i}"

    def alternating(turns):
        if [r for r, _ in turns] != [("user", "assistant")[i % 2] for i in range(len(turns))]:
            raise ValueError("turns must alternate, user first")
        return chat_format.chatml(turns)

    records = list(chat_format.render_turns(_chat(130), alternating))
    assert "".join(r["span"] for r in records) == alternating(_chat(130)) and not any(r["rewrites"] for r in records)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<div id="cookie-notice"><p>We use cookies, really, yes, and more.</p></div>
<header><a href=/>Home</a><p>Slogan, of the site.</p></header><nav><ul><li><a href=1>One</a></ul></nav>
<div class="wrap"><div class="sidebar"><p>Side, text, long, with, many, commas, in, it.</p></div>
<div class="content"><h1>Title &amp; more</h1><script>var a="</p>";</script><p>First para, with commas,
 and more.<p>Second <a href=x>link</a> text&nbsp;here<br>after.<ul><li>one<li>two</ul>
<table><tr><td>a<td>b<tr><td>c</table><!-- no --><div class="share">Share me</div>
<form><label>Mail</label><input></form><div class="ad-box">Buy, now, this.</div></div>
<div id="comments"><article class=comment><p>Nice, post, really, good, stuff, indeed.</p></article></div></div>
<footer>&copy; site</footer></body></html>"""


def test_main_text():
    got = html_extract.main_text(PAGE).split("\n")
    assert got == [
        "Title & more", "First para, with commas, and more.", "Second link text here after.", "one", "two", "a b", "c",
    ]


@pytest.mark.parametrize(
    "source,text",
    [
        (None, ""), ("", ""), ("<html></html>", ""), ("just <b>text</b>", "just text"), ("<p>a</p><p>b", "a\nb"),
        ("<p>cut off &am", "cut off &am"), ("<p>One<p", "One"), ("<p>One, two.<div>in</div>tail", "One, two.\nin\ntail"),
        ("<p>1 < 2 & 3 &lt; 4 &#233;", "1 < 2 & 3 < 4 é"), ("<script>x", ""), ("<p hidden>no</p><p>yes", "yes"),
        ("<div><p>a</div></p></p>b", "a\nb"), ("<article><h1>T</h1><p>x<b>y</p><p>z</article><p>Other, text.", "T\nxy\nz"),
    ],
)
def test_odd_pages(source, text):
    assert html_extract.main_text(source) == text


LONG = "Text of the article, with commas, and long enough to count."


@pytest.mark.parametrize(
    "part",
    [
        "<section id='discussion'><p>{}</section>", "<h2 id='related-work'>{}</h2>", "<h2 id='search'>{}</h2>", "<p class='notice'>{}</p>",
        "<div class='elementor-widget-text-editor'><p>{}</div>", "<ol><li><a href=1>{}</a><li><a href=2>b</a><li><a href=3>c</a></ol>",
    ],
)
@pytest.mark.parametrize("around", ["article", "main"])
def test_names_in_the_article(part, around):
    page = f"<body><{around}><h1>T</h1><p>{LONG}</p>{part.format('kept words')}<p>{LONG}</p></{around}>"
    assert "kept words" in html_extract.main_text(page).split("\n")


def test_unmistakable_names_in_the_article():
    parts = "<div class=ad>x1</div><div class='share-buttons'>x2</div><ul class=comments><li>x3</ul><aside>x4</aside>"
    assert html_extract.main_text(f"<article><p>{LONG}</p>{parts}</article>") == LONG


@pytest.mark.parametrize("name", ["content sidebar-right", "sidebar-right", "widget", "related", "search-result"])
def test_names_do_not_lose_the_page(name):
    page = f"<nav><a href=/>Home</a></nav><div class='{name}'><p>{LONG}</p><p>{LONG}</p></div><footer>f</footer>"
    assert html_extract.main_text(page) == f"{LONG}\n{LONG}"
    short = f"<div><p>Short.</p></div><div class='widget'><p>{LONG * 5}</p><p>{LONG * 5}</p></div>"
    assert LONG in html_extract.main_text(short)


@pytest.mark.parametrize(
    "source,text",
    [
        ("<header><svg viewBox='0 0 1 1'/></header><p>One, two.", "One, two."), ("<div><math/></div><p>One, two.", "One, two."),
        ("<header><svg><path d='M0'/></header><article><p>One, two.</article>", "One, two."), ("<svg><path><p>One, two.", "One, two."),
        ("<p>One, two.<object data=x><p>Three, four.", "One, two.\nThree, four."), ("<svg><title>t</title><text>no</text></svg><p>One.", "One."),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mspace/><mn>1</mn></math> be.</article>", "Let x=1 be."),
        ("<article><p>a, b.<xmp><b>kept</b></xmp><p>c, d.</article>", "a, b.\n<b>kept</b>\nc, d."), ("<p>a, b.<xmp>c<p>d", "a, b.\nc\nd"),
        ("<head><template><div>no</div></template></head><p>One.", "One."), ("<head><template></head><body><p>One.", "One."),
        ("<svg><script/></svg><p>One.", "One."), ("<svg><foreignObject><div>no</div></foreignObject></svg><p>One.", "One."),
        ("<p>a <svg><g><text>no</text></g></svg> b", "a b"), ("<script/>no</script><p>One.", "One."),
    ],
)
def test_embedded_languages(source, text):
    assert html_extract.main_text(source) == text


def test_article_in_parts():
    two = "<main><article><p>One, two.</article><article><p>Three, four.</article></main>"
    assert html_extract.main_text(two) == "One, two.\nThree, four."
    more = "".join(f"<p>{LONG}</p>" for _ in range(12))
    parts = f"<article>{more}</article><section>{more}</section><section><p>Teaser.</section><p>Beside.</p>"
    assert html_extract.main_text(parts) == "\n".join([LONG] * 24)


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "<p>text, here.</p>"
    assert html_extract.main_text(deep) == "text, here."
    long = "<article>" + "<p>one, two, three.</p>" * 20_000
    assert html_extract.main_text(long).count("\n") == 19_999


def test_ngrams_are_those_of_the_texts():
    texts = ["Ab, a!", "", "  É1x", "..."]
    found = lang_id.grams(texts)
    letters = found.letters
    seen = sorted(
        (int(t), "".join(chr(letters[p[g]] or 32) for p in found.parts)) for t, g in zip(found.text, found.gram)
    )
    assert seen == sorted([(0, " ab"), (0, "ab "), (0, " a "), (2, " é "), (2, " x ")])
    assert lang_id.grams(["", "1 2"]) is None


def test_bundles_do_not_depend_on_the_batch():
    words = ["the cat sat", "le chat noir", "die katze", "ночь", "日本語の文", ""] * 5
    model = lang_id.LanguageModel(("a",), np.ones((1, lang_id.DIMENSIONS)) / lang_id.DIMENSIONS**0.5)
    names, scores = lang_id.classify(words, model)
    single = [lang_id.classify([w], model) for w in words]
    assert names == [n for (n,), _ in single]
    assert np.allclose(scores, [s[0] for _, s in single])


def test_graph_search_finds_what_is_in_range():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 32))
    for i in range(0, 200, 4):  # chains and tight groups
        x[i + 1 : i + 4] = x[i] + rng.normal(size=(3, 32)) * 0.1
    x[300:420] = x[300] + rng.normal(size=(120, 32)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    graph, medoid = vector_dedup.build_graph(x)
    seen = np.zeros(len(x), bool)
    vector_dedup._reached(graph, seen, np.array([medoid]))
    assert seen.all()
    entries = np.stack([np.full(len(x), medoid), np.arange(len(x))], 1)
    who, row = vector_dedup.range_search(x, vector_dedup._table(graph), entries, x, 0.93)
    true = (x @ x.T >= 0.93).sum()
    assert len(who) >= 0.98 * true
    only, row = vector_dedup.range_search(x, vector_dedup._table(graph), entries[:, :1], x, 0.93)
    assert len(only) >= 0.9 * true


def test_robust_prune_drops_what_a_kept_one_covers():
    x = np.array([[1, 0, 0], [0.99, 0.14, 0], [0.985, 0.17, 0], [0, 0, 1]], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    (kept,) = vector_dedup.robust_prune(x, np.array([0]), np.array([[1, 2, 3]]))
    assert kept.tolist() == [1, 3]


@pytest.mark.parametrize("shift", [0.0, 4.0])
@pytest.mark.parametrize("size", [10_000, 100_000, 2_000_000])
def test_near_pairs_share_a_cell(size, shift):
    rng = np.random.default_rng(11)
    gauss = rng.normal(size=(23_000, 64)) + shift * (np.arange(64) == 0)
    sample, x = np.split(gauss / np.linalg.norm(gauss, axis=1, keepdims=True), [vector_dedup.SAMPLE_ROWS])
    turn = rng.normal(size=x.shape)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = rng.uniform(0.93, 0.96, (len(x), 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * turn
    centres = vector_dedup._fit(sample, vector_dedup._count(size, len(sample)))
    margin = vector_dedup._margin(sample, 0.93)
    assert margin < np.arccos(0.93)
    pairs = zip(vector_dedup._within(x, centres, margin), vector_dedup._within(y, centres, margin))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.98


def test_few_directions_lose_no_pair():
    rng = np.random.default_rng(12)
    x = np.zeros((4000, 64))
    x[:, :2] = rng.normal(size=(4000, 2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = vector_dedup._fit(x[:1000], 40)
    cells = np.zeros((len(x), 40), bool)
    for own, near in zip(cells, vector_dedup._within(x, centres, vector_dedup._margin(x[:1000], 0.93))):
        own[near] = True
    close = x @ x.T >= 0.93
    assert (cells.astype(int) @ cells.T.astype(int))[close].min() > 0


def _planted(rng, x, low=0.931, high=0.96):
    """A row in range of each row of ``x``."""
    turn = rng.normal(size=x.shape)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    cosine = rng.uniform(low, high, (len(x), 1))
    return (cosine * x + np.sqrt(1 - cosine**2) * turn).astype(np.float32)


def test_search_between_blocks_goes_through_the_graph():
    """Vectors of one block asked for in the graph of another from its medoid: tight groups, and lone vectors."""
    rng = np.random.default_rng(13)
    # Groups of more than CANDIDATES rows: hardly a near neighbour is outside the own group.
    middle = np.repeat(rng.normal(size=(20, 64)), 80, axis=0)
    x, asked = middle + 0.15 * rng.normal(size=(2, *middle.shape))
    lone = rng.normal(size=(2400, 64))
    x, asked = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (np.concatenate([x, lone]), asked))
    x = x.astype(np.float32)
    asked = np.concatenate([asked.astype(np.float32), _planted(rng, x[1600:])])
    graph, medoid = vector_dedup.build_graph(x)
    nothing = [np.empty(0, np.int64)] * len(asked)
    true = int((asked @ x.T >= 0.93).sum())
    who, row = vector_dedup.block_pairs(x, graph, medoid, asked, nothing, 0.93)
    assert true >= 3400 and len(set(zip(who.tolist(), row.tolist()))) == len(who) >= 0.98 * true
    empty, _ = vector_dedup.block_pairs(x, [np.empty(0, np.int64)] * len(x), medoid, asked, nothing, 0.93)
    assert len(empty) < 0.05 * true  # without the graph next to nothing is found


SENTENCES = "<p>The river rose in spring, and the town, as ever, watched it from the bridge while boats were tied to posts.</p>"
FURNITURE = [
    'div class="nav"', 'div class="menu"', 'ul class="menu"', 'div role="navigation"', 'div role="complementary"',
    'div class="footer"', 'div class="site-footer"', 'div class="cookie-banner"', 'div class="cookie-notice"', 'div class="notice"',
    'div class="sidebar-left"', 'div class="ad-banner"', 'div class="banner-ad"', 'p class="ad"', 'span class="advert"',
    'ins class="adsbygoogle"', 'div class="comments-section"', 'div id="user-comments"', 'div class="newsletter-signup"',
    'div class="subscribe-box"', "ul",
]
ARTICLE = [
    'section id="discussion"', 'section id="related-work"', 'section id="menu"', 'div class="elementor-widget-text-editor"',
    'p class="notice"', 'div class="content sidebar-right"', 'div class="has-sidebar"', 'h2 id="related-work"', 'h2 class="menu"',
]


@pytest.mark.parametrize("around", ["article", "main", "div"])
@pytest.mark.parametrize("start", FURNITURE)
def test_furniture_goes_inside_and_outside_the_article(around, start):
    tag = start.split()[0]
    shares = '<li><a href="/f">Share on Facebook</a></li><li><a href="/t">Tweet FURNITURE</a></li><li><a href="/m">Email</a></li>'
    inner = shares if tag == "ul" else "FURNITURE of the page"
    page = f"<body><{around}><h1>Title</h1>{SENTENCES * 3}<{start}>{inner}</{tag}>{SENTENCES * 2}</{around}></body>"
    text = html_extract.main_text(page)
    assert "FURNITURE" not in text and text.count("The river rose") == 5


@pytest.mark.parametrize("start", ARTICLE)
def test_parts_of_the_article_stay(start):
    tag = start.split()[0]
    page = f"<article><h1>Title</h1>{SENTENCES * 2}<{start}>KEPT, with commas, as part of it.</{tag}>{SENTENCES}</article>"
    assert "KEPT" in html_extract.main_text(page)


def test_a_page_that_would_lose_its_paragraphs_keeps_them():
    assert html_extract.main_text(f"<main><div class='sidebar-right'>{SENTENCES * 5}</div></main>").count("The river") == 5


def test_generated_pages_against_their_template():
    """Pages made from known parts: what comes out is the article's blocks, in order."""
    rng = np.random.default_rng(2)
    for _ in range(60):
        blocks, body = [], []
        for i in range(int(rng.integers(4, 12))):
            text = f"Sentence {i} of the story, told at some length, with commas and all, number {rng.integers(1000)}."
            kind = rng.choice(["p", "h2", "li", "quote"])
            blocks.append(text)
            body.append({"p": f"<p>{text}</p>", "h2": f"<h2>{text}</h2>", "li": f"<ul><li>{text}</li></ul>", "quote": f"<blockquote><p>{text}</p></blockquote>"}[kind])
            if rng.random() < 0.4:
                start = FURNITURE[int(rng.integers(len(FURNITURE) - 1))]
                body.append(f"<{start}>Buy now, cheap, today.</{start.split()[0]}>")
        around = rng.choice(["article", "main"])
        page = f"<html><body><nav><a href=/>Home</a></nav><{around}>{''.join(body)}</{around}><footer>About</footer></body></html>"
        assert html_extract.main_text(page).split("\n") == blocks


def test_registered_query_renders_prefixes_from_the_first_turn(llm, tmp_path, monkeypatch):
    real = chat_format.format_chats

    def whole_prefixes(turns):
        if turns[0][1] not in ("first", chat_format.MARKER, "<|im_end|><|im_start|>assistant ok"):
            raise ValueError("a prefix without its first turn")
        return chat_format.chatml(turns)

    monkeypatch.setattr(chat_format, "format_chats", lambda chats, **how: real(chats, template=whole_prefixes, **how))
    turns = [(5, i, ("user", "assistant")[i % 2], "first" if i == 0 else f"text {i}") for i in range(9)]
    llm.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op4_chat_format"](llm, str(tmp_path)).collect()}
    assert got[5].n_turns == 9 and got[5].loss_chars == 4 * len("text 1") and got[-1].n_turns == 2
