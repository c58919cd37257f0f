"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags. Each block has features of
its ancestors' tags, roles and class words, of its text, and of the container it stands in. The
chain's labels are article and other; weights are learned by gradient ascent on the exact
log-likelihood (forward-backward) from labelled pages, and a page is decoded by Viterbi.

Where no part of a page is marked as its article, or only a small part, each of the text and
container features has a second weight for such pages, so that plain ``div`` and table layouts are
judged by their text, and not by marks that they lack.

The labelled pages come from ``labelled_pages``, a seeded generator of layouts: where the article
stands, what surrounds it, what interrupts it, and whether marks tell it, are silent or mislead,
vary. Other labelled pages can be given to ``fit``.

Defined results: a null or empty page has an empty text; a page without article blocks, too;
unclosed and stray tags are read as browsers do, roughly, in a time in line with the page's length
however deep they nest; text in the elements of ``RAW`` is no text of the page, that in formulas
and fallbacks (math, object, canvas, noscript) is; repeated pages give equal texts, an empty table
no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from atelier.llm.common import pieces

TEXTS = "page_id long, url string, text string, n_chars long"

# Element kinds of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup "
    "option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "svg", "iframe")
CLOSES_P = BLOCKS - frozenset("body button head html label option optgroup select textarea title".split())
CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = ("ul", "ol", "dl", "table", "select")
CONTAINERS = frozenset("article aside body center dd details dialog div fieldset footer form header main nav noscript section td th".split())
SECTIONS = frozenset("article aside body dialog footer form header main nav section".split())
# Beginnings of class and id words that tell what a part of a page is for.
STEMS = (
    "advert sponsor promo banner cookie consent gdpr privacy notice alert popup modal overlay newsletter subscri signup login search form comment repl respon disqus discuss sidebar rail widget menu nav "
    "breadcrumb pagina pager toolbar header masthead topbar footer bottom copyright legal share social related recommend trending popular tags meta byline author content article post entry story main body text page wrap hidden skip"
).split()
AD_WORDS = frozenset(("ad", "ads", "adv", "adbox", "adslot", "adunit", "adsense", "dfp"))
# Marks of an article, and marks under which text is none even inside such a one.
TELLING = frozenset("tag:article tag:main role:main role:article class:article class:content class:post class:entry class:story class:main class:body class:text".split())
CONTRARY = frozenset("tag:nav tag:aside tag:footer tag:form class:ad class:advert class:sponsor class:comment class:respon class:nav class:menu class:sidebar class:footer class:form class:search hidden".split())
LONGEST_KEY = 300  # attributes up to this length are remembered with what they say

# Tags and comments as HTML reads them: a quote opens a value only after an equals sign, a name ends at white space,
# slash or bracket, and a comment ends at once at <!--> and <!--->, and at --!>. Nothing is tried twice.
_IN_TAG = r"""(?:(?>=\s*+(?:"[^"]*+"|'[^']*+'))|[^>])*+"""
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>|</(?![a-zA-Z])[^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)({_IN_TAG})>", re.S)
_UNFINISHED = re.compile(r"<[a-zA-Z/!?]")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in RAW}
_NESTED = {t: re.compile(rf"<(/?){t}(?=[\s/>])({_IN_TAG})>", re.I) for t in ("template", "svg")}  # these may hold others of their kind
_NAME_ENDS = ("", "/", " ", "\t", "\n", "\f", "\r")  # what follows a name; after anything else it is a custom element's
_TAG_PART = re.compile(r"[\s\"']")
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d")


class Block:
    __slots__ = ("features", "section", "container", "text", "linked")

    def __init__(self, features: frozenset[str], section: int, container: int) -> None:
        self.features, self.section, self.container, self.text, self.linked = features, section, container, [], 0


def _read_marks(attributes: str) -> frozenset[str]:
    out = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1:
            value = value[1:-1]
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower():
            out.add("hidden")
        elif name == "role":
            out.add(f"role:{value.lower()}")
        elif name in ("class", "id"):
            for w in _CLASS_WORD.findall(value):
                w = w.lower()
                if w in AD_WORDS:
                    out.add("class:ad")
                out.update(f"class:{s}" for s in STEMS if w.startswith(s))
    return frozenset(out)


_known_marks = lru_cache(8192)(_read_marks)


def _marks(attributes: str) -> frozenset[str]:
    return _known_marks(attributes) if len(attributes) <= LONGEST_KEY else _read_marks(attributes)


def self_closed(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not part of an unquoted value."""
    if not attributes.endswith("/"):
        return False
    tail = _TAG_PART.split(attributes)[-1]
    return "=" not in tail and not attributes[: -len(tail)].rstrip().endswith("=")


class Open:
    """The open elements: (tag, features, section, container), and where each tag and any block stands among them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, frozenset[str], int, int]] = []
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, tag: str, features: frozenset[str], section: int, container: int) -> None:
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, features, section, container))

    def last(self, *tags: str) -> int:
        """Depth of the innermost of these tags; -1 if none is open."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def close(self, depth: int) -> None:
        """Everything from ``depth`` on."""
        while len(self.stack) > depth:
            tag = self.stack.pop()[0]
            self.at[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def innermost(self) -> tuple[str, frozenset[str], int, int]:
        return self.stack[-1] if self.stack else ("", frozenset(), 0, 0)


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the text after a raw element goes on: after its own end tag, be there others of its kind inside, else at the page's end."""
    if tag not in _NESTED:
        end = _RAW_END[tag].search(page, at)
        return end.end() if end else len(page)
    depth = 1
    for m in _NESTED[tag].finditer(page, at):
        depth += -1 if m[1] else not (tag == "svg" and self_closed(m[2]))
        if not depth:
            return m.end()
    return len(page)


def leaf_blocks(page: str) -> list[tuple[str, frozenset[str], int, float, int]]:
    """(text, ancestor features, number of the nearest section, share of linked characters, number of the container) of each block with text."""
    nothing: frozenset[str] = frozenset()
    held = Open()
    out: list[Block] = []
    now, sections, containers, at = None, 0, 0, 0

    def add(text: str) -> None:
        nonlocal now
        if not text:
            return
        if now is None:
            if not text.strip():
                return
            _, features, section, container = held.innermost()
            inner = held.stack[held.blocks[-1]][0] if held.blocks else "none"
            now = Block(features | {f"in:{inner}"}, section, container)
            out.append(now)
        now.text.append(text)
        if held.at.get("a"):
            now.linked += len(text.strip())

    close = page.rfind(">")
    while m := _TOKEN.search(page, at) if at <= close else None:
        add(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _RAW_END and not m[1] and m[3][:1] in _NAME_ENDS:
            if tag != "svg" or not self_closed(m[3]):  # of these, only in svg a slash ends the element
                at = _raw_end(page, tag, at)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            now = None
        if m[1]:
            depth = held.last(tag)
            if depth >= 0 and (tag in BLOCKS or not held.blocks or held.blocks[-1] < depth):
                held.close(depth)
            continue
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        if tag in CLOSES_P and held.blocks and held.stack[held.blocks[-1]][0] == "p":
            held.close(held.blocks[-1])
        if tag in CLOSED_BY:
            depth = held.last(*CLOSED_BY[tag])
            if depth > held.last(*LISTS):
                held.close(depth)
        marks = _marks(m[3]) if m[3] else nothing
        _, above, section, container = held.innermost()
        if tag in SECTIONS or tag == "div" and marks:
            sections += 1
            section = sections
        if tag in CONTAINERS:
            containers += 1
            container = containers
        own = marks | {f"tag:{tag}"} if tag in BLOCKS else marks
        if tag == "article" and "tag:article" in above:
            own = own | {"nested:article"}
        held.push(tag, above if own <= above else above | own, section, container)
    cut = _UNFINISHED.search(page, max(at, close + 1))  # a tag that the page's end cuts off
    add(page[at : cut.start() if cut else len(page)])
    found = []
    for b in out:
        text = " ".join(entities.unescape("".join(b.text)).split())
        if text:
            found.append((text, b.features, b.section, min(1.0, b.linked / len(text)), b.container))
    return found


def text_features(text: str, linked: float) -> list[str]:
    words = text.count(" ") + 1
    out = [f"words:{min(words.bit_length(), 6)}", "links:all" if linked > 0.8 else "links:some" if linked > 0.2 else "links:few"]
    if text[-1] in ".!?…":
        out.append("ends")
    if "©" in text:
        out.append("copyright")
    if len(_DIGITS.findall(text)) * 5 > len(text):
        out.append("digits")
    return out


def page_features(blocks: list[tuple[str, frozenset[str], int, float, int]]) -> list[list[str]]:
    """Features of each block but for its ancestors'."""
    out = [text_features(text, linked) for text, _, _, linked, _ in blocks]
    size = [text.count(" ") + 1 for text, *_ in blocks]
    telling: dict[frozenset[str], bool] = {}
    marked = 0
    for n, (_, ancestors, *_) in zip(size, blocks, strict=True):
        if ancestors not in telling:
            telling[ancestors] = not TELLING.isdisjoint(ancestors) and CONTRARY.isdisjoint(ancestors)
        marked += n * telling[ancestors]
    total = sum(size)
    if marked * 5 >= total:
        return out
    # no marks, or on little text only: what the text and its container look like counts for more
    kind = "few" if marked else "bare"
    plain: dict[int, int] = {}  # words out of links in each container
    linked_words: dict[int, int] = {}
    for n, (*_, linked, container) in zip(size, blocks, strict=True):
        (linked_words if linked > 0.8 else plain)[container] = (linked_words if linked > 0.8 else plain).get(container, 0) + n
    first = next((k for k, f in enumerate(out) if "words:6" in f or "words:5" in f), len(out))
    last = next((k for k in range(len(out) - 1, -1, -1) if "words:6" in out[k] or "words:5" in out[k]), -1)
    for k, (own, (_, ancestors, *_, container)) in enumerate(zip(out, blocks, strict=True)):
        inner = next((f for f in ancestors if f.startswith("in:")), "in:none")
        near = [f"before:{min(size[k - 1].bit_length(), 6)}" if k else "before:none", f"after:{min(size[k + 1].bit_length(), 6)}" if k + 1 < len(size) else "after:none"]
        here, links = plain.get(container, 0), linked_words.get(container, 0)
        room = [f"room:{min(here.bit_length(), 8)}", f"share:{min(4, here * 5 // total)}", "room:linked" if links > here else "room:plain"]
        place = "place:inside" if first <= k <= last else "place:first" if k < first else "place:last"
        own += [f"{kind}/{f}" for f in (*own, inner, *near, *room, place, f"{inner}/{own[0]}", f"{inner}/{place}")] + [kind]
    return out


class Field:
    """Weights of a two-label chain: the score of label 1 against 0, and transitions inside and between sections."""

    def __init__(self, names: list[str], weights: np.ndarray, moves: np.ndarray) -> None:
        self.weight = dict(zip(names, weights.tolist(), strict=True))
        self.moves = moves.tolist()  # [same section][from][to]

    def decode(self, blocks: list[tuple[str, frozenset[str], int, float, int]]) -> list[bool]:
        """Viterbi."""
        a, b, back, before = 0.0, 0.0, [], None
        known: dict[frozenset[str], float] = {}
        weight, bias = self.weight, self.weight["bias"]
        for k, ((_, ancestors, section, *_), own) in enumerate(zip(blocks, page_features(blocks), strict=True)):
            if ancestors not in known:
                known[ancestors] = sum(weight.get(f, 0.0) for f in ancestors)
            score = bias + known[ancestors] + sum(weight.get(f, 0.0) for f in own)
            if k == 0:
                a, b = 0.0, score
            else:
                t = self.moves[section == before]
                to_0, to_1 = (a + t[0][0], b + t[1][0]), (a + t[0][1], b + t[1][1])
                back.append((to_0[1] > to_0[0], to_1[1] > to_1[0]))
                a, b = max(to_0), max(to_1) + score
            before = section
        if not blocks:
            return []
        labels = [b > a]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page) if page else []
    return "\n".join(b[0] for b, keep in zip(blocks, field.decode(blocks), strict=True) if keep)


def fit(pages: list[tuple[str, list[bool]]], steps: int = 150, rate: float = 0.15, decay: float = 2e-4) -> Field:
    """Maximum likelihood by Adam; gradients by forward-backward over all pages at once.

    pages: (html, label of each leaf block).
    """
    read = [(leaf_blocks(p), y) for p, y in pages]
    read = [(b, y) for b, y in read if b]
    lists = [[[*ancestors, *own, "bias"] for (_, ancestors, *_), own in zip(b, page_features(b), strict=True)] for b, _ in read]
    names = sorted({f for page in lists for block in page for f in block})
    number = {f: k for k, f in enumerate(names)}
    n, most = len(read), max(len(b) for b, _ in read)
    real, label, same = np.zeros((n, most), bool), np.zeros((n, most), int), np.zeros((n, most), int)
    flat = np.zeros((sum(map(len, lists)), len(names)), np.float32)
    at = 0
    for i, (blocks, y) in enumerate(read):
        real[i, : len(blocks)] = True
        label[i, : len(blocks)] = y
        same[i, 1 : len(blocks)] = [p[2] == q[2] for p, q in zip(blocks, blocks[1:], strict=False)]
        for block in lists[i]:
            flat[at, [number[f] for f in block]] = 1
            at += 1
    theta = np.zeros(len(names) + 8)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    step_real = real[:, 1:]
    for step in range(1, steps + 1):
        w, t = theta[:-8], theta[-8:].reshape(2, 2, 2)
        score = np.zeros((n, most, 2))
        score[real, 1] = flat @ w.astype(np.float32)
        forward, backward = np.zeros((n, most, 2)), np.zeros((n, most, 2))
        forward[:, 0] = score[:, 0]
        for k in range(1, most):
            new = np.logaddexp(forward[:, k - 1, 0, None] + t[same[:, k], 0], forward[:, k - 1, 1, None] + t[same[:, k], 1]) + score[:, k]
            forward[:, k] = np.where(real[:, k, None], new, forward[:, k - 1])
        for k in range(most - 2, -1, -1):
            ahead = backward[:, k + 1] + score[:, k + 1]
            new = np.logaddexp(t[same[:, k + 1], :, 0] + ahead[:, 0, None], t[same[:, k + 1], :, 1] + ahead[:, 1, None])
            backward[:, k] = np.where(real[:, k + 1, None], new, backward[:, k + 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        p1 = np.exp(np.clip(forward[:, :, 1] + backward[:, :, 1] - total[:, None], -50, 0))
        gradient = np.zeros_like(theta)
        gradient[:-8] = flat.T @ (label - p1)[real].astype(np.float32)
        pair = forward[:, :-1, :, None] + t[same[:, 1:]] + (score + backward)[:, 1:, None, :] - total[:, None, None, None]
        pair = np.exp(np.clip(pair, -50, 0))
        g = gradient[-8:].reshape(2, 2, 2)
        for s in (0, 1):
            here = step_real & (same[:, 1:] == s)
            g[s] -= pair[here].sum(0)
            np.add.at(g[s], (label[:, :-1][here], label[:, 1:][here]), 1)
        gradient = gradient / n - decay * theta * 10
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(names, theta[:-8], theta[-8:].reshape(2, 2, 2))


def labelled_pages(count: int = 900, seed: int = 4, plain: float = 0.3, unmarked: float = 0.2) -> list[tuple[str, list[bool]]]:
    """Pages of random layout with the label of each leaf block; a share of ``plain`` have no telling marks, or misleading ones, and of the rest ``unmarked`` mark all but the article."""
    r = random.Random(seed)
    syllables = "ka lo mi ter en sh un de ra ion ve st al qu é or ing ly ä ó".split()

    def word() -> str:
        w = "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
        return w.upper() if r.random() < 0.05 else w + r.choice(["", "", "", "", ",", "###", "&amp;", " |"] if r.random() < 0.2 else [""])

    def sentence(most: int = 14) -> str:
        return " ".join(word() for _ in range(r.randint(1, most))).capitalize() + r.choice([".", ".", ".", "", "!", "?"])

    def prose() -> str:
        return " ".join(sentence() for _ in range(r.choice([1, 1, 2, 4, 8])))

    def pick(options: str) -> str:
        return r.choice(options.split())

    def link(text: str) -> str:
        return f'<a href="/{word().strip("#| ")}">{text}</a>'

    def build() -> tuple[str, list[bool]]:
        out: list[str] = []
        labels: list[bool] = []

        def put(markup: str, *keep: bool) -> None:
            out.append(markup)
            labels.extend(keep)

        def links(n: int) -> None:
            out.append("<ul>" if r.random() < 0.8 else "<ol>")
            for _ in range(n):
                put(f"<li>{link(word())}</li>", False)
            out.append("</ul>")

        def around(kind: str, attribute: str = "") -> None:
            tag = {"nav": pick("nav nav div ul"), "ad": pick("div div aside section"), "side": pick("aside aside div"), "notice": pick("div div section dialog"), "form": "form", "comments": pick("section div section"), "foot": pick("footer footer div"), "head": pick("header header div"), "share": "div"}[kind]
            words = {
                "nav": "menu nav navbar main-nav topmenu breadcrumbs pagination", "ad": "ad ads advert ad-slot sponsored promo banner-ad adsbox", "side": "sidebar side-bar widget right-rail related-posts recommended", "notice": "cookie-notice consent cookie-banner gdpr notice alert newsletter popup modal",
                "form": "search-form signup newsletter login contact-form", "comments": "comments comment-list user-comments discussion responses replies", "foot": "footer site-footer page-footer copyright legal", "head": "header site-header masthead topbar page-header", "share": "share social share-buttons social-links tags",
            }[kind]
            plain = {"nav": tag in ("nav",), "side": tag == "aside", "foot": tag == "footer", "head": tag == "header", "form": True}.get(kind, False)
            mark = attribute or ("" if plain and r.random() < 0.6 else f' {pick("class class id")}="{pick(words)}{r.choice(["", " x", " block"])}"')
            if not mark and r.random() < 0.1:
                mark = {"nav": ' role="navigation"', "side": ' role="complementary"', "foot": ' role="contentinfo"', "head": ' role="banner"'}.get(kind, "")
            out.append(f"<{tag}{mark}>")
            if kind == "nav":
                links(r.randint(1, 8))
            elif kind in ("foot",):
                put(f"&copy; {word()} &middot; {sentence()}" if r.random() < 0.6 else f"<p>{prose()}</p>", False)
                if r.random() < 0.3:
                    links(3)
            elif kind == "head":
                put(f"<{(t := pick('h1 h2 div p'))}>{link(sentence(4)) if r.random() < 0.6 else sentence(4)}</{t}>", False)
                if r.random() < 0.4:
                    out.append("<nav>")
                    links(r.randint(2, 6))
                    out.append("</nav>")
            elif kind == "form":
                put(f"<label>{word()}</label>", False)
                out.append('<input name="q">')
                put(f"<button>{word()}</button>", False)
                if r.random() < 0.4:
                    put(f"<p>{sentence()}</p>", False)
            elif kind == "comments":
                put(f"<{(t := pick('h2 h3 h4'))}>{sentence(3)}</{t}>", False)
                for _ in range(r.randint(1, 4)):
                    inner = pick("div article li")
                    out.append(f'<{inner} class="{pick("comment comment-body reply user-comment")}">')
                    for _ in range(r.randint(1, 2)):
                        put(f"<p>{prose()}</p>", False)
                    out.append(f"</{inner}>")
            elif kind == "side":
                if r.random() < 0.6:
                    put(f"<h3>{sentence(3)}</h3>", False)
                links(r.randint(1, 5)) if r.random() < 0.6 else put(f"<p>{prose()}</p>", False)
            elif kind == "share":
                for _ in range(r.randint(1, 3)):
                    put(f"<p>{link(word())}</p>" if r.random() < 0.5 else f"<span>{link(word())}</span><hr>", False)
            else:  # ad, notice
                put(f"<p>{prose()}</p>" if r.random() < 0.4 else prose(), False)
                if r.random() < 0.2:
                    put(f"<button>{word()}</button>", False)
            out.append(f"</{tag}>")

        def body() -> None:
            """Article blocks, now and then interrupted."""
            if r.random() < 0.85:
                put(f"<h1>{sentence(8)}</h1>", True)
            for _ in range(r.choice([1, 2, 3, 5, 9])):
                x = r.random()
                if x < 0.6:
                    put(f"<p>{prose()}" + ("</p>" if r.random() < 0.8 else ""), True)
                elif x < 0.68:
                    put(f"<p><b>{sentence()}<br>" if r.random() < 0.6 else f"<p>{sentence()} {link(word())} {sentence()}</p>", True)
                elif x < 0.76:
                    put(f"<{(t := pick('h2 h3 h4'))}>{sentence(5)}</{t}>", True)
                elif x < 0.84:
                    out.append("<ul>")
                    for _ in range(r.randint(1, 4)):
                        put(f"<li>{sentence()}</li>", True)
                    out.append("</ul>")
                elif x < 0.9:
                    put(f"<blockquote>{prose()}</blockquote>" if r.random() < 0.5 else f"<pre>{prose()}</pre>", True)
                elif x < 0.95:
                    out.append("<table><tr>")
                    for _ in range(r.randint(1, 4)):
                        put(f"<td>{word()}</td>", True)
                    out.append("</tr></table>")
                else:
                    put(f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>", True)
                if r.random() < 0.12:
                    around(pick("ad ad share side form notice nav"))

        put(f"<!DOCTYPE html><html><head><title>{sentence(8)}</title><style>p{{margin:0}}</style></head><body>", False)
        for kind in ("notice", "head", "nav", "ad", "form"):
            if r.random() < {"nav": 0.8, "ad": 0.5, "head": 0.5}.get(kind, 0.25):
                around(kind)
        if r.random() < 0.2:
            around("side")
        frame = pick("main div none none")
        out.append({"main": "<main>", "div": f'<div class="{pick("container wrapper page layout")}">', "none": ""}[frame])
        shape = pick("article article article article div section main")
        if r.random() < unmarked:  # the rest of the page is marked, the article is not
            shape = pick("div div section")
            out[-1], frame, bare = "", "none", r.choice(["", "", ' class="row"', ' class="col-8 left"', ' id="x1"'])
        else:
            bare = None
        mark = bare if bare is not None else "" if shape in ("article", "main") and r.random() < 0.7 else f' {pick("class id")}="{pick("content article post-content entry-content story-body main-text article-body")}"'
        out.append(f"<{shape}{mark}>")
        body()
        if r.random() < 0.25:
            around(pick("comments share foot form side"))
        out.append(f"</{shape}>")
        for kind in ("comments", "side", "ad", "form", "notice"):
            if r.random() < {"comments": 0.35, "side": 0.35}.get(kind, 0.15):
                around(kind)
        out.append({"main": "</main>", "div": "</div>", "none": ""}[frame])
        if r.random() < 0.85:
            around("foot")
        return "".join(out) + ("</body></html>" if r.random() < 0.9 else ""), labels

    def build_plain() -> tuple[str, list[bool]]:
        """Fragments, unmarked divs, layout tables, and wrappers whose marks speak of something else."""
        out: list[str] = []
        labels: list[bool] = []

        def put(markup: str, *keep: bool) -> None:
            out.append(markup)
            labels.extend(keep)

        def links(n: int) -> None:
            x = r.random()
            if x < 0.5:
                out.append("<ul>")
                for _ in range(n):
                    put(f"<li>{link(word())}</li>", False)
                out.append("</ul>")
            elif x < 0.8:
                put(f"<{(t := pick('div p'))}>{pick('| &gt; &middot; <br>').join(f' {link(word())} ' for _ in range(n))}</{t}>", False)
            else:
                for _ in range(n):
                    put(f"<div>{link(word())}</div>", False)

        def text(n: int) -> str:
            return " ".join(sentence() for _ in range(n))

        def article(heads: str) -> None:
            if r.random() < 0.8:
                put(f"<{(t := pick(heads))}>{sentence(8)}</{t}>", True)
            if r.random() < 0.15:
                put(f"<p>{sentence(4)} {r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}</p>", True)
            if r.random() < 0.12:  # one block with line breaks
                put(f"<div>{'<br><br>'.join(text(r.choice([1, 3, 6])) for _ in range(r.randint(1, 5)))}</div>", True)
                return
            for _ in range(r.choice([1, 2, 2, 3, 5, 9])):
                x = r.random()
                if x < 0.72:
                    put(f"<p>{text(r.choice([1, 2, 4, 8]))}" + ("</p>" if r.random() < 0.8 else ""), True)
                elif x < 0.78:
                    put(f"<p>{sentence()} {link(word())} {sentence()}</p>", True)
                elif x < 0.86:
                    put(f"<{(t := pick('h2 h3 h4'))}>{sentence(5)}</{t}>", True)
                    put(f"<p>{text(r.choice([1, 2, 4]))}</p>", True)
                elif x < 0.92:
                    out.append("<ul>")
                    for _ in range(r.randint(1, 4)):
                        put(f"<li>{sentence()}</li>", True)
                    out.append("</ul>")
                elif x < 0.96:
                    put(f"<blockquote>{text(2)}</blockquote>", True)
                else:
                    put(f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>", True)
            if r.random() < 0.6:
                put(f"<p>{text(r.choice([2, 4, 8]))}</p>", True)

        def top() -> None:
            if r.random() < 0.5:
                put(f"<{(t := pick('div h1 h2 p'))}>{link(sentence(3))}</{t}>" if r.random() < 0.7 else f"<div>{word()}</div>", False)
            if r.random() < 0.7:
                links(r.randint(2, 8))

        def bottom() -> None:
            if r.random() < 0.3:
                put(f"<h3>{word()} {word()}</h3>", False)
                out.append("<ul>")
                for _ in range(r.randint(2, 6)):
                    put(f"<li>{link(sentence(5))}</li>", False)
                out.append("</ul>")
            if r.random() < 0.6:
                put(f"<{(t := pick('div p'))}>&copy; {r.randint(1995, 2030)} {word()}. {sentence(6) if r.random() < 0.5 else ''}</{t}>", False)
            if r.random() < 0.3:
                links(r.randint(2, 5))
            if r.random() < 0.1:
                put(f"<footer><p>{sentence()}</p></footer>", False)

        shape = pick("fragment fragment bare bare bare table table misled misled misled")
        if shape == "fragment":
            out.append(tag := pick("<div> <div> <body> <section> <center>") if r.random() < 0.8 else "")
            article("h1 h2")
            return "".join(out) + tag.replace("<", "</"), labels
        odd = "has-sidebar sidebar-left with-menu nav-open menu-layout header-fixed comments-open form-page ad-free no-ads widget-area modal-open tagged share-on promo-off social"
        attribute = f' class="{pick(odd)}"' if shape == "misled" else r.choice(["", "", ' class="row"', ' id="x1"', ' class="col-8 left"', ' class="wrapper"', ' style="width:80%"'])
        put("<html><head>" + f"<title>{sentence(8)}</title></head><body" + (f' class="{pick(odd)}"' if shape == "misled" and r.random() < 0.5 else "") + ">", False)
        whole = "<form>" if shape == "misled" and r.random() < 0.2 else ""
        out.append(whole)
        if shape == "table":
            out.append("<table><tr><td colspan=3>")
            top()
            out.append("</td></tr><tr><td>")
            side = r.random() < 0.5
            if side:
                if r.random() < 0.3:
                    put("<br>".join(link(word()) for _ in range(r.randint(2, 6))), False)
                for _ in range(r.randint(1, 7)):
                    put(f"{link(word())}<p>" if r.random() < 0.3 else f"<div>{link(word())}</div>", False)
                out.append("</td><td>")
            article("h1 h2 h3")
            if not side and r.random() < 0.5:
                out.append("</td><td>")
                links(r.randint(2, 6))
            out.append("</td></tr><tr><td>")
            bottom()
            out.append("</td></tr></table>")
        else:
            out.append(tag := pick("<div> <div> <header>") if r.random() < 0.5 else "")
            top()
            out.append(tag.replace("<", "</"))
            inner = "" if shape == "bare" and r.random() < 0.25 else pick("div div div section")
            out.append(f"<{inner}{attribute}>" if inner else "")
            article("h1 h1 h2")
            out.append(f"</{inner}>" if inner else "")
            out.append(tag := pick("<div> <footer>") if r.random() < 0.5 else "")
            bottom()
            out.append(tag.replace("<", "</"))
        return "".join(out) + whole.replace("<", "</") + "</body></html>", labels

    pages = []
    for _ in range(count):
        page, labels = build_plain() if r.random() < plain else build()
        if len(leaf_blocks(page)) == len(labels):  # a layout that reads otherwise than it was meant is no example
            pages.append((page, labels))
    return pages


@cache
def trained(count: int = 900, seed: int = 4) -> Field:
    return fit(labelled_pages(count, seed))


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page. Narrow: one pass, no shuffle."""
    shared = pages.sparkSession.sparkContext.broadcast(field or trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                found = [main_text(p, shared.value) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, TEXTS)
