"""Main text of web pages by tree scoring.

The page is read into a flat list of elements and texts. Elements that are never
the article (scripts, forms, navigation, or named like adverts, comments,
notices, ...) are taken out; in an article or main element a name counts if the
word it begins or ends with is unmistakable. A page that loses most of its paragraphs to names is read
again by the unmistakable ones only, then by none. Each paragraph gives points for being there, for
commas and for length to its ancestors, less the further up; a container's points
count as far as its text is not link text. The best container is the article: the
nearest article or main element around it, if there is one, else the container;
in both cases with those siblings that look like more of the same (of an article:
articles and sections).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea noembed noframes".split())
# Elements of other languages, whose end a "/>" is; inside them these hold text of the page again, and BREAKOUT ends them.
FOREIGN = frozenset(("svg", "math"))
INTEGRATION = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody tfoot thead tr ul xmp".split()
)
BREAKOUT = BLOCK - {"table", "tbody", "tfoot", "thead", "tr", "dir", "legend"} | frozenset(
    "table b big br code em embed i img nobr s small span strong strike sub sup tt u var".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Elements that never hold the article's text.
OUTSIDE = frozenset(
    "head nav aside footer header form button select option datalist menu dialog canvas audio video map applet fieldset search".split()
)
# What a start tag closes if it is open, up to the border elements.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
IN_HEAD = frozenset("html head title meta link base style script noscript template".split())
PARAGRAPH = frozenset("# p pre xmp td th blockquote li dd div section article main body".split())
# Text directly inside one of these counts for the element itself.
DIRECT = frozenset("# div section article main body".split())
CONTAINER = frozenset("# div section article main body td blockquote center ul ol dd figure".split())

# A paragraph's points count in full for its parent, and less for those above.
SHARES = (1, 2, 6, 9, 12)

# Words in class, id or role that name something else than the article.
UNWANTED = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle adslot adbox banner sponsor sponsored promo promos "
    "promotion comment comments commentlist disqus discussion respond replies reply feedback sidebar aside rail widget "
    "widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead topbar toolbar footer "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay subscribe subscription newsletter "
    "signup share sharing social related recommended recommendations outbrain taboola skip hidden login copyright "
    "complementary contentinfo search sitemap teaser".split()
)
REMARKS = frozenset("comment comments commentlist disqus discussion respond replies reply feedback".split())
# Names made of these and of FILLER only are unmistakable on a container, also in the article.
CLEAR = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promos comment "
    "comments commentlist disqus respond replies sidebar navbar breadcrumb breadcrumbs pagination cookie cookies consent "
    "gdpr newsletter share sharing related outbrain taboola teaser".split()
)
FILLER = frozenset("area bar block body box button buttons container inner items links list post posts slot unit wrap wrapper".split())
# In the article a container also goes if one of its names begins or ends with one of these, whatever else the name says.
HEADS = frozenset(
    "nav navbar navigation menu menubar footer sidebar cookie cookies consent gdpr notice notices comment comments "
    "commentlist disqus newsletter subscribe subscription signup breadcrumb breadcrumbs pagination".split()
)
# Adverts go whatever element they are.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle adslot adbox sponsored".split())
ROLES = frozenset("navigation complementary contentinfo search menu menubar toolbar dialog alertdialog".split())
# An id of one such word may as well name a section of the article.
SECTIONS = REMARKS - {"comments", "commentlist", "disqus"} | {"menu", "notice", "notices", "navigation", "subscription"}
SHARE = re.compile(r"\b(share|tweet|facebook|twitter|linkedin|whatsapp|pinterest|reddit|telegram|e-?mail|print|copy link)\b", re.I)
NAMED = frozenset("article aside div dl footer header menu nav ol section table ul".split())
# A result below this share of the page's paragraphs is read again.
SHORT = 0.25
WANTED = frozenset("article body content entry main page post text blog story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.S,
)
_NAMING = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")


def _names(attrs: str) -> tuple[list[list[str]], list[str], bool]:
    """The words of each class, id and role; which of them it is; whether the element is hidden."""
    names, kinds, hidden = [], [], False
    for match in _NAMING.finditer(attrs):
        kind, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if kind in ("class", "id", "role"):
            names += [_WORD.findall(_CAMEL.sub("-", name).lower()) for name in value.split()]
            kinds += [kind] * (len(names) - len(kinds))
        elif kind == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        else:
            hidden |= kind == "hidden" or value.lower() == "true"
    return names, kinds, hidden


def _unwanted(names: list[list[str]], words: frozenset = UNWANTED) -> bool:
    for own in names:
        if own and own[0] not in ("has", "with", "no", "without", "is"):
            if any(w in words for w in own) or any(a + b in words for a, b in zip(own, own[1:])):
                return True
    return False


def _clear(tag: str, names: list[list[str]], kinds: list[str]) -> bool:
    """Is this a container that can only be something else? An id of REMARKS words alone does not say so."""
    return tag in NAMED and any(
        CLEAR.intersection(own) and all(w in CLEAR or w in FILLER for w in own) and not (kind == "id" and REMARKS.intersection(own))
        for own, kind in zip(names, kinds)
    )


def _inside(tag: str, names: list[list[str]], kinds: list[str]) -> bool:
    """Does a name or role say that this is no part of the article it lies in?"""
    if tag in HEADINGS:
        return False
    for own, kind in zip(names, kinds):
        if not own or own[0] in ("has", "with", "no", "without", "is"):
            continue
        if kind == "role":
            if "".join(own) in ROLES:
                return True
        elif own[0] in ADVERTS or own[-1] in ADVERTS:
            return True
        elif tag in NAMED and (own[0] in HEADS or own[-1] in HEADS):
            if not (kind == "id" and len(own) == 1 and own[0] in SECTIONS):
                return True
    return _clear(tag, names, kinds)


class Page:
    """Elements in page order: parallel lists of tag, parent, attributes; events open, text and close."""

    def __init__(self, source: str):
        self.tag, self.parent, self.names, self.kinds, self.hidden = ["#"], [0], [[]], [[]], [False]
        self.events: list[tuple[int, str | None]] = []  # (element, text), or (element, None), or (-element, None)
        self._stack, self._opened = [0], Counter()
        self._parse(source)
        while len(self._stack) > 1:
            self._close()

    def _open(self, tag: str, attrs: str) -> None:
        names, kinds, hidden = _names(attrs) if attrs else ([], [], False)
        self.tag.append(tag)
        self.parent.append(self._stack[-1])
        self.names.append(names)
        self.kinds.append(kinds)
        self.hidden.append(hidden)
        self._stack.append(len(self.tag) - 1)
        self._opened[tag] += 1
        self.events.append((self._stack[-1], None))

    def _close(self) -> None:
        element = self._stack.pop()
        self._opened[self.tag[element]] -= 1
        self.events.append((-element, None))

    def _close_open(self, tags: set, borders: set) -> None:
        if not any(self._opened[t] for t in tags):
            return
        for at in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[at]]
            if tag in tags:
                while len(self._stack) > at:
                    self._close()
                return
            if tag in borders:
                return

    def _text(self, raw: str) -> None:
        if raw:
            if self.tag[self._stack[-1]] == "head" and raw.strip():
                self._close()
            self.events.append((self._stack[-1], html.unescape(raw) if "&" in raw else raw))

    def _parse(self, source: str) -> None:
        at = 0
        while True:
            match = _TOKEN.search(source, at)
            if match is None:
                self._text(source[at:])
                return
            self._text(source[at : match.start()])
            at = match.end()
            if match["start"]:
                tag = match["start"].lower()
                if match.end() == len(source) and not match[0].endswith(">"):
                    return  # cut off inside a tag
                at = self._start(tag, match["attrs"] or "", source, at)
            elif match["end"]:
                tag = match["end"].lower()
                if tag == "br":
                    self.events.append((self._stack[-1], " "))
                elif tag not in ("body", "html"):
                    self._close_open({tag}, set() if tag in TABLE else {"td", "th", "table"})

    def _start(self, tag: str, attrs: str, source: str, at: int) -> int:
        if tag not in IN_HEAD:
            self._close_open({"head"}, {"body", "template"})
        if tag in BREAKOUT:
            self._close_open(FOREIGN, INTEGRATION)
        if tag in FOREIGN or self._opened["svg"] or self._opened["math"]:
            if attrs.endswith("/"):
                return at
        if tag == "template" and not re.compile(r"</template[\s/>]", re.I).search(source, at):
            return at
        if tag == "xmp":
            end = re.compile(r"</xmp(?=[\s/>])[^>]*>?", re.I).search(source, at)
            if end:
                self._close_open({"p"}, {"td", "th", "table", "button", "object", "caption"})
                self._open(tag, attrs)
                self.events.append((self._stack[-1], source[at : end.start()]))
                self._close()
                return end.end()
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            return end.end() if end else len(source)
        if tag in VOID:
            if tag in ("br", "hr", "img", "wbr") and tag != "wbr":
                self._open(tag, "")
                self.events.append((self._stack[-1], " "))
                self._close()
            return at
        if tag == "title":
            end = re.compile(r"</title\s*>", re.I).search(source, at)
            if end:
                at = end.end()
            return at
        if tag in BLOCK:
            self._close_open({"p"}, {"td", "th", "table", "button", "object", "caption"})
        if tag in HEADINGS and self.tag[self._stack[-1]] in HEADINGS:
            self._close()
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        self._open(tag, attrs)
        return at


def _kept(page: Page, by: str = "names") -> tuple[list[bool], list[bool], bool]:
    """False for elements that are, or lie in, something else than the article; True for what lies in an article or
    main element; whether a name took anything out. ``by``: all "names" outside the article, "clear" ones only, or "tags"."""
    count = len(page.tag)
    clear = [by != "tags" and _clear(*of) for of in zip(page.tag, page.names, page.kinds)]
    inside = [by == "names" and _inside(*of) and not _wanted(of[1]) for of in zip(page.tag, page.names, page.kinds)]
    unwanted = [
        clear[i] or by == "names" and page.tag[i] not in HEADINGS and not _wanted(page.names[i]) and _unwanted(page.names[i])
        for i in range(count)
    ]
    # Does an element hold the article's own element or its title?
    holds = [False] * count
    for i in range(count - 1, 0, -1):
        own = page.tag[i] in ("article", "main", "h1") and not clear[i]
        if own or holds[i]:
            holds[page.parent[i]] = True
    keep, in_article, named = [True] * count, [False] * count, False
    for i in range(1, count):
        above, tag = page.parent[i], page.tag[i]
        in_article[i] = in_article[above] or tag in ("article", "main")
        if not keep[above] or tag in ("svg", "template") or page.hidden[i] and tag not in ("html", "body", "main", "h1"):
            keep[i] = False
        elif tag in ("html", "body", "main", "h1"):
            keep[i] = True
        elif in_article[i]:
            out = clear[i] or inside[i] and not holds[i]
            keep[i] = not out and (tag not in OUTSIDE or tag in ("header", "form", "fieldset") and holds[i])
            named |= out
        elif unwanted[i] and _unwanted(page.names[i], REMARKS):
            keep[i], named = False, True
        elif tag in OUTSIDE or unwanted[i]:
            keep[i] = tag in ("header", "div", "section", "hgroup", "form", "fieldset") and holds[i]
            named |= unwanted[i] and not keep[i]
    return keep, in_article, named


def _wanted(names: list[list[str]]) -> bool:
    return any(len(own) == 1 and own[0] in WANTED for own in names)


def _score(page: Page, keep: list[bool]) -> tuple[list[float], list[int], list[int], list[int]]:
    count = len(page.tag)
    own, chars, linked, commas = [0] * count, [0] * count, [0] * count, [0] * count
    link = [False] * count
    for i in range(1, count):
        link[i] = link[page.parent[i]] or page.tag[i] == "a"
    for element, text in page.events:
        if text is not None and keep[element]:
            n = len(" ".join(text.split()))
            block = element
            while block and page.tag[block] not in BLOCK and page.tag[block] not in ("td", "th"):
                block = page.parent[block]
            own[block] += n
            commas[block] += text.count(",") + text.count("、") + text.count("،")
            chars[element] += n
            linked[element] += n if link[element] else 0
    for i in range(count - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        linked[page.parent[i]] += linked[i]
    score = [0.0] * count
    for i in range(count):
        if keep[i] and own[i] and page.tag[i] in PARAGRAPH:
            points = 1 + commas[i] + min(own[i] // 100, 3)
            holder = i if page.tag[i] in DIRECT else page.parent[i]
            for share in SHARES:
                score[holder] += points / share
                if not holder:
                    break
                holder = page.parent[holder]
    for i in range(1, count):
        if score[i]:
            if page.tag[i] in ("article", "main"):
                score[i] += 25
            elif page.tag[i] == "div":
                score[i] += 5
            if any(w in WANTED for own_words in page.names[i] for w in own_words):
                score[i] += 25
            score[i] *= 1 - linked[i] / max(1, chars[i])
    return score, chars, linked, own


def _chosen(page: Page, keep: list[bool]) -> set[int]:
    """The elements whose text is the article's."""
    score, chars, linked, own = _score(page, keep)
    options = [i for i in range(len(page.tag)) if keep[i] and score[i] > 0 and page.tag[i] in CONTAINER]
    if not options:
        return {0}
    best = max(options, key=lambda i: (score[i], -i))
    around, up = best, best
    while up:
        if page.tag[up] in ("article", "main") and keep[up]:
            around = up
            break
        up = page.parent[up]
    if page.tag[around] in ("article", "main"):
        least, out = max(10.0, score[around] * 0.2), {around}
        if page.tag[around] == "article":  # what lies beside main is not the main part
            for i in range(1, len(page.tag)):
                beside = page.parent[i] == page.parent[around] and page.tag[i] in ("article", "section")
                if beside and keep[i] and chars[i] and score[i] >= least:
                    out.add(i)
        return out
    if own[page.parent[best]]:
        return {page.parent[best]}  # text between the blocks is part of the whole
    least, out = max(10.0, score[best] * 0.2), {best}
    for i in range(1, len(page.tag)):
        if i == best or page.parent[i] != page.parent[best] or not keep[i] or not chars[i]:
            continue
        density = linked[i] / chars[i]
        if score[i] >= least or (page.tag[i] in HEADINGS and density < 0.5):
            out.add(i)
        elif page.tag[i] in ("p", "pre", "blockquote") and density < 0.25:
            out.add(i)
    return out


def _link_lists(page: Page, keep: list[bool], in_article: list[bool]) -> None:
    """Take out lists and tables that are little but links; of those in an article only links for sharing it."""
    count = len(page.tag)
    chars, linked, links, link = [0] * count, [0] * count, [0] * count, [False] * count
    shares = [0] * count
    for i in range(1, count):
        link[i] = link[page.parent[i]] or page.tag[i] == "a"
        links[i] = int(page.tag[i] == "a")
    for element, text in page.events:
        if text is not None and keep[element]:
            n = len("".join(text.split()))
            chars[element] += n
            linked[element] += n if link[element] else 0
            shares[element] += int(link[element] and n <= 30 and bool(SHARE.search(text)))
    for i in range(count - 1, 0, -1):
        for sums in (chars, linked, links, shares):
            sums[page.parent[i]] += sums[i]
    for i in range(1, count):
        if not keep[page.parent[i]]:
            keep[i] = False
        elif page.tag[i] in ("ul", "ol", "dl", "table", "div", "section") and links[i] >= (2 if in_article[i] else 3):
            gone = linked[i] > 0.75 * chars[i] and (not in_article[i] or shares[i] * 3 >= links[i] * 2)
            keep[i] = keep[i] and not gone


def main_text(source: str | None) -> str:
    """The article's text: one line per block; empty for null or a page without text."""
    if not source:
        return ""
    page = Page(source)
    keep, in_article, named = _kept(page)
    best = _text(page, keep, in_article)
    for by in ("clear", "tags"):
        # Without any name only if nothing else is left.
        if not named or by == "tags" and best:
            break
        keep, in_article, named = _kept(page, by)
        if len(best) < SHORT * _paragraphs(page, keep):
            best = max(best, _text(page, keep, in_article), key=len)
    return best


def _paragraphs(page: Page, keep: list[bool]) -> int:
    """Characters of the kept paragraphs."""
    inside = [False] * len(page.tag)
    for i in range(1, len(inside)):
        inside[i] = keep[i] and (inside[page.parent[i]] or page.tag[i] in ("p", "pre", "blockquote"))
    return sum(len(" ".join(text.split())) for element, text in page.events if text is not None and inside[element])


def _text(page: Page, keep: list[bool], in_article: list[bool]) -> str:
    _link_lists(page, keep, in_article)
    chosen = _chosen(page, keep)
    lines, line, inside = [], [], int(0 in chosen)

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            lines.append(text)
        line.clear()

    for element, text in page.events:
        own = abs(element)
        if text is not None:
            if inside > 0 and keep[own]:
                line.append(text)
            continue
        if page.tag[own] in BLOCK:
            flush()
        elif page.tag[own] in ("td", "th", "br"):
            line.append(" ")
        if own in chosen:
            inside += 1 if element > 0 else -1
    flush()
    return "\n".join(lines)


def main_text_column(source: Column) -> Column:
    """``main_text`` of a column of pages. Repeated rows give equal texts; nothing else is read."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(main_text)

    return extract(source)
