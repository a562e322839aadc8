"""Main text of HTML pages by a tree-structured graphical model over the DOM.

Every block element is a binary variable, content or not. A node's own evidence (tag, class and id words, text length,
links, punctuation, what its subtree holds) makes its unary potential; each parent-child edge has a two-by-two
potential that depends on the kind of child. Sum-product messages run from the leaves up and from the root down, which
is exact on a tree, and give every node's content marginal. Both potentials are fitted by likelihood on labelled pages,
whose gradient the same messages provide. The labelled pages are composed here from a seed: layouts with menus,
headers, sidebars, notices, adverts, forms and reader comments around and inside an article.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(r"</?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
#: A tag that ends at the first ``>``, quoted or not.
_PLAIN = re.compile(r"</?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>")
_COMMENT_END = re.compile(r"--!?>")
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_MAY_HIDE = re.compile(r"hidden|style", re.I)
#: Elements whose text is never shown as text of the page, and fields of forms.
_RAW = frozenset("script style template textarea title iframe select datalist".split())
_RAW_END = {x: re.compile(rf"</{x}\b", re.I) for x in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr picture source input nobr center "
    "object canvas audio video noscript noframes svg g text tspan path rect circle line math mi mo mn ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mspace semantics annotation".split()
)
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_GROUPS = [
    "p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu", "td th caption", "table tr tbody thead tfoot", "blockquote pre", "article", "main", "section", "div", "nav",
    "header", "footer", "aside dialog", "form fieldset label button legend output", "figure", "figcaption", "body html", "head", "#text", "address", "details summary",
]
_GROUP = {t: i for i, ts in enumerate(_GROUPS) for t in ts.split()}
_OTHER = _GROUP["div"]
#: Words in class, id and role values, one feature each.
_KEYS = [
    "nav|menu|breadcrumb|crumbs?|pagination|pager|toc|tabs?", "header|masthead|topbar|top-bar|brand|logo|hero", "foot|footer|colophon|copyright|legal|contentinfo", "side|sidebar|aside|rail|widget|complementary",
    "ad|ads|advert\\w*|adv|sponsor\\w*|promo\\w*|adsense|dfp|outbrain|taboola|affiliate", "cookie\\w*|consent|gdpr|notice|notification|alert|banner|popup|modal|overlay|paywall|toast|disclaimer", "comment\\w*|disqus|repl(?:y|ies)|respond|discussion|reviews?|feedback",
    "form|newsletter|subscri\\w*|signup|sign-up|login|search|searchbox|contact|register", "share|sharing|social|follow|tweet|facebook|like|tools|toolbar|actions|buttons?", "related|recommend\\w*|more|also|popular|trending|latest|teaser|readmore|links|tags?|categories",
    "article\\w*|post|entry|story|articlebody|single", "content|main|body|text|prose|copy|maincontent|page-content", "byline|author|meta|date|time|published|bio", "skip|hidden|sr-only|visually-hidden|screen-reader\\w*|noprint|print",
]
_KEY = [re.compile(rf"(?:^|[^a-z])(?:{k})(?:$|[^a-z])") for k in _KEYS]
_HIDDEN = len(_KEYS)
_FEATURES = len(_GROUPS) + len(_KEYS) + 1 + 16
_CONTENT = ""  # marks labelled content in composed pages only
_masks: dict[str, int] = {}


def _mask(attrs: str) -> int:
    """Bits of the class words of a start tag; hidden elements have the last bit."""
    if not attrs or attrs.isspace():
        return 0
    found = _masks.get(attrs)
    if found is None:
        found, words = 0, []
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found |= 1 << _HIDDEN
            elif name in ("class", "id", "role", "itemprop", "aria-label"):
                words.append(value)
        text = re.sub(r"([a-z])([A-Z])", r"\1-\2", " ".join(words)).lower()
        for i, k in enumerate(_KEY):
            if k.search(text):
                found |= 1 << i
        if len(_masks) < 20_000:
            _masks[attrs] = found
    return found


@dataclass
class Dom:
    """Block nodes of pages in order of their start; ``texts`` holds (node, text) in page order.

    Without ``keep_hidden``, text inside elements that ``hidden`` or their style keep from being shown is left out.
    """

    labelled: bool = False
    keep_hidden: bool = True
    group: list[int] = field(default_factory=list)
    mask: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    stats: list[tuple] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)
    page: list[int] = field(default_factory=list)

    def node(self, page: int, tag: str, mask: int, parent: int) -> int:
        self.group.append(_GROUP.get(tag, _OTHER))
        self.mask.append(mask)
        self.parent.append(parent)
        self.depth.append(0 if parent < 0 else self.depth[parent] + 1)
        self.stats.append((0, 0, 0, 0, 0))
        self.marked.append(False)
        self.page.append(page)
        return len(self.group) - 1

    def add(self, page: int, html: str) -> None:
        """Parses one page; its root is a node of its own, so a page without any tag is one node with text.

        Time is linear in the page, however deep its elements and whatever is left open: open elements are found by
        name, a tag without an end makes the rest text, and after one whose quotes never close none is trusted.
        """
        root = self.node(page, "html", 0, -1)
        stack, tags, open_at = [root], ["html"], {"html": [0]}
        used, pieces, linked, links = {root}, [], 0, 0
        pos, size, tag_at, shape = 0, len(html), html.find, _TAG
        unseen, unseen_inline = -1, []  # depth of the outermost hidden block; open hidden inline elements

        def flush() -> None:
            nonlocal linked
            if not pieces:
                return
            raw = "".join(pieces)
            pieces.clear()
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            in_links, linked = linked, 0
            if not text:
                return
            at = stack[-1]
            if at in used:
                at = self.node(page, "#text", 0, at)
            used.add(at)
            if self.labelled and text.startswith(_CONTENT):
                self.marked[at], text = True, text[1:]
            words = text.count(" ") + 1
            self.stats[at] = (len(text), min(in_links, len(text)), words, text.count(",") + text.count(". "), 2 * (text[-1] in ".!?…\"'”»:;") + ("©" in text or "opyright" in text))
            self.texts.append((at, text))

        def shown(piece: str) -> None:
            nonlocal linked
            if unseen < 0 and not unseen_inline:
                pieces.append(piece)
                if links:
                    linked += len(piece)

        def close(k: int) -> None:
            nonlocal unseen
            for name in tags[k:]:
                open_at[name].pop()
            del stack[k:], tags[k:]
            if unseen >= k:
                unseen = -1

        def last(names: Iterable[str]) -> int:
            return max((open_at[x][-1] for x in names if open_at.get(x)), default=-1)

        while pos < size:
            at = tag_at("<", pos)
            if at < 0:
                shown(html[pos:])
                break
            if at > pos:
                shown(html[pos:at])
            after = html[at + 1 : at + 3]
            first = after[:1]
            if not (first.isascii() and first.isalpha() or first == "/" and after[1:].isascii() and after[1:].isalpha()):
                if html.startswith("<!--", at):
                    end = _COMMENT_END.search(html, at + 2)
                    pos = end.end() if end else size
                elif first and first in "!?/":
                    gt = html.find(">", at)
                    pos = gt + 1 if gt >= 0 else size
                    if gt < 0:
                        shown(html[at:])
                else:
                    shown("<")
                    pos = at + 1
                continue
            m = shape.match(html, at)
            if m is None and shape is _TAG:
                shape = _PLAIN
                m = shape.match(html, at)
            if m is None:  # no > follows
                shown(html[at:])
                break
            pos, name, ends = m.end(), m["name"].lower(), first == "/"
            if name in _INLINE:
                if name == "a":
                    links = 0 if ends else 1
                elif name == "br":
                    shown(" ")
                if not ends:
                    if not self.keep_hidden and name not in _VOID and (name in unseen_inline or _MAY_HIDE.search(m["attrs"]) and _mask(m["attrs"]) >> _HIDDEN & 1):
                        unseen_inline.append(name)
                elif unseen_inline and name == unseen_inline[0]:
                    unseen_inline.remove(name)
                continue
            if name in _RAW:
                if not ends:
                    close_at = _RAW_END[name].search(html, pos)
                    gt = html.find(">", close_at.end()) if close_at else -1
                    pos = gt + 1 if gt >= 0 else size
                continue
            flush()
            links, unseen_inline = 0, []
            if ends:
                if open_at.get(name) and (k := open_at[name][-1]):
                    close(k)
                continue
            if name in _CLOSES_P and open_at.get("p"):
                close(open_at["p"][-1])
            if name in _SAME:
                same, stop = _SAME[name]
                if (k := last(same)) > last(stop):
                    close(k)
            if name in _VOID or name == "html":
                continue
            used.add(stack[-1])
            mask = _mask(m["attrs"])
            stack.append(self.node(page, name, mask, stack[-1]))
            open_at.setdefault(name, []).append(len(tags))
            tags.append(name)
            if unseen < 0 and not self.keep_hidden and mask >> _HIDDEN & 1:
                unseen = len(tags) - 1
        flush()


class Tree:
    """Arrays of a :class:`Dom` for message passing, all pages at once, level by level."""

    def __init__(self, dom: Dom) -> None:
        self.n = n = len(dom.group)
        parent, self.group, mask = np.array(dom.parent, dtype=np.int64), np.array(dom.group), np.array(dom.mask, dtype=np.int64)
        # a plain wrapper of one element is no variable of its own: however often an element is wrapped, it hangs on the
        # first element around it that says something
        thin = (np.bincount(parent[parent >= 0], minlength=n) == 1) & (mask == 0) & (self.group == _OTHER) & (parent >= 0) & np.array([s[2] == 0 for s in dom.stats], dtype=bool)
        depth = np.array(dom.depth)
        if thin.any():
            up = np.where(thin, parent, np.arange(n))
            while (up[up] != up).any():
                up = up[up]
            parent = np.where(parent >= 0, up[parent], -1)
            deep: list[int] = []
            for p in parent.tolist():
                deep.append(0 if p < 0 else deep[p] + 1)
            depth = np.array(deep)
        self.parent, self.live = parent, ~thin
        order = np.argsort(depth, kind="stable")
        order = order[self.live[order]]
        cuts = np.searchsorted(depth[order], np.arange(1, depth.max() + 2)) if n else np.zeros(0, int)
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]  # without the roots
        own = np.array(dom.stats, dtype=float).reshape(n, 5)
        below, paragraphs, forms = own.copy(), (self.group == 0) * (own[:, 2] > 0) * 1.0, (self.group == _GROUP["form"]) * 1.0
        for level in reversed(self.levels):
            np.add.at(below, self.parent[level], below[level])
            np.add.at(paragraphs, self.parent[level], paragraphs[level])
            np.add.at(forms, self.parent[level], forms[level])
        page = np.array(dom.page, dtype=np.int64)
        first = np.searchsorted(page, page)
        last = np.searchsorted(page, page, side="right")
        place = (np.arange(n) - first) / np.maximum(last - first, 1)
        x = np.zeros((n, _FEATURES))
        x[np.arange(n), self.group] = 1
        g = len(_GROUPS)
        x[:, g : g + len(_KEYS) + 1] = (mask[:, None] >> np.arange(len(_KEYS) + 1)) & 1
        g += len(_KEYS) + 1
        chars, linked, words, stops, marks = own.T
        has = words > 0
        values = [
            np.ones(n), has, np.log1p(words) / 3, has * (words < 5), linked / np.maximum(chars, 1), has * (linked > 0.8 * chars), (marks >= 2), marks % 2,
            np.minimum(stops / np.maximum(words, 1), 0.5) * 2, np.log1p(below[:, 2]) / 5, below[:, 1] / np.maximum(below[:, 0], 1), np.log1p(paragraphs) / 2, np.minimum(forms, 3) / 3,
            place, place > 0.9, below[:, 2] / np.maximum(below[:, 2][first], 1),
        ]
        for i, v in enumerate(values):
            x[:, g + i] = v
        self.x, self.own, self.below = x, own, below

    def messages(self, unary: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Log beliefs of the nodes, of each node with its parent (rows parent, columns child), and log Z."""
        got = np.zeros((self.n, 2))
        got[:, 1] = unary
        up = np.zeros((self.n, 2))
        for level in reversed(self.levels):
            up[level] = np.logaddexp.reduce(got[level][:, None, :] + edge[self.group[level]], axis=2)
            np.add.at(got, self.parent[level], up[level])
        full = got.copy()
        pair = np.zeros((self.n, 2, 2))
        for level in self.levels:
            rest = full[self.parent[level]] - up[level]
            pair[level] = rest[:, :, None] + edge[self.group[level]] + got[level][:, None, :]
            full[level] = got[level] + np.logaddexp.reduce(rest[:, :, None] + edge[self.group[level]], axis=1)
        roots = np.flatnonzero(self.parent < 0)
        return full, pair, float(np.logaddexp.reduce(got[roots], axis=1).sum())


@dataclass
class Model:
    weights: np.ndarray
    edge: np.ndarray

    def marginals(self, tree: Tree) -> np.ndarray:
        if not tree.n:
            return np.zeros(0)
        full, _, _ = tree.messages(tree.x @ self.weights, self.edge)
        return 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -50, 50)))


def _words(rng: Random, least: int, most: int) -> str:
    parts = "an re the on ti wh ou er in st ed ing tion é ü ción lo mi que ver sch zu".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(least, most)))


def _sentence(rng: Random, least: int, most: int) -> str:
    text = _words(rng, least, most)
    text = re.sub(r" ", lambda _: ", " if rng.random() < 0.08 else ". " if rng.random() < 0.07 else " ", text).capitalize()
    if rng.random() < 0.06:
        return text.upper().replace(" ", "!! ")
    if rng.random() < 0.06:
        return text.replace(" ", rng.choice([" | ", "*** ", "&amp;&amp;&amp; ", "### "]))
    return text + rng.choice([".", ".", ".", "!", "?", ""])


def compose(seed: int) -> str:
    """One labelled page: blocks of the article start with a mark, all other text is boilerplate."""
    rng = Random(seed)
    semantic = rng.random() < 0.6
    short = rng.random() < 0.35

    def box(tag: str, names: str, inner: str, sure: bool = False) -> str:
        """An element of the given tag, or a plain one told by its class or id."""
        name = rng.choice(names.split())
        if semantic and (rng.random() < 0.8 or not names):
            return f"<{tag}{rng.choice(['', '', f' class={chr(34)}{name}{chr(34)}'])}>{inner}</{tag}>" if tag not in ("div", "section", "p") or sure else f'<{tag} class="{name}">{inner}</{tag}>'
        return f'<{rng.choice(["div", "div", "section"])} {rng.choice(["class", "class", "id"])}="{rng.choice(["", "site-", "js "])}{name}{rng.choice(["", "", "-wrap", " box"])}">{inner}</div>'.replace("<section", "<div")

    def link_list(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{_words(rng, 1, 1)}">{_words(rng, 1, 3)}</a></li>' for _ in range(n)) + "</ul>"

    def text_block() -> str:
        return rng.choice(["<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "{}"]).format(_sentence(rng, 2, 40))

    def menu() -> str:
        return box("nav", "nav menu navbar breadcrumb topnav main-menu", rng.choice([link_list(rng.randint(2, 9)), " ".join(f'<a href="#">{_words(rng, 1, 2)}</a>' for _ in range(4))]))

    def header() -> str:
        return box("header", "header masthead topbar site-header", f"<{(t := rng.choice(['div', 'p', 'h1', 'h2']))}>{_words(rng, 1, 5)}</{t}>" + (menu() if rng.random() < 0.5 else ""))

    def footer() -> str:
        return box("footer", "footer site-footer colophon", rng.choice(["&copy; ", "Copyright 2020 ", ""]) + rng.choice([_sentence(rng, 2, 25), f"<p>{_sentence(rng, 2, 25)}</p>", link_list(4)]))

    def side() -> str:
        return box("aside", "sidebar side widget right-rail related popular", f"<h3>{_words(rng, 1, 3)}</h3>" + rng.choice([link_list(5), text_block(), "".join(text_block() for _ in range(3))]))

    def advert() -> str:
        return f'<{(t := rng.choice(["div", "div", "section", "p", "aside"]))} {rng.choice(["class", "id"])}="{rng.choice("ad ads advert advertisement sponsored promo ad-slot sponsor promoted".split())}">{rng.choice([_sentence(rng, 2, 40), _sentence(rng, 2, 40) if t == "p" else text_block()])}</{t}>'

    def notice() -> str:
        return f'<{(t := rng.choice(["div", "section", "aside", "dialog"]))} {rng.choice(["class", "id", "role"])}="{rng.choice("cookie cookie-notice consent notice banner alert popup gdpr newsletter-modal paywall".split())}">{text_block()}{rng.choice(["", "<button>" + _words(rng, 1, 2) + "</button>"])}</{t}>'

    def form() -> str:
        return f'<form action="/x"{rng.choice(["", " class=search", " class=newsletter", " id=login"])}>{rng.choice(["", "<p>" + _sentence(rng, 2, 12) + "</p>"])}<label>{_words(rng, 1, 3)}</label><input name="q"><button>{_words(rng, 1, 2)}</button></form>'

    def comments() -> str:
        each = "".join(rng.choice(['<div class="comment"><b>{}</b><p>{}</p></div>', "<li><p>{}: {}</p></li>", "<article class=comment><h4>{}</h4><p>{}</p></article>"]).format(_words(rng, 1, 2), _sentence(rng, 3, 50)) for _ in range(rng.randint(1, 5)))
        return f'<{(t := rng.choice(["div", "section", "section", "ol", "aside"]))} {rng.choice(["class", "id", "id"])}="{rng.choice("comments comment-list discussion replies disqus reader-comments user-comments".split())}">{rng.choice(["", f"<h3>{_words(rng, 1, 2)}</h3>"])}{each}</{t}>'

    def share() -> str:
        return f'<div class="{rng.choice("share social tags meta byline author-bio related more-links".split())}">{rng.choice([link_list(3), _words(rng, 1, 6), "<p>" + _sentence(rng, 2, 12) + "</p>"])}</div>'

    def say(least: int, most: int) -> str:
        return _CONTENT + _sentence(rng, least, most)

    def linked_words() -> str:
        return f'<a href="/{_words(rng, 1, 1)}">{_CONTENT}{_words(rng, 1, 5)}</a>'

    def part() -> str:
        """A piece of an article that is no plain paragraph."""
        kind = rng.choice([0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9])
        if kind == 0:
            return f"<details{rng.choice(['', ' open'])}><summary>{say(1, 6)}</summary>{rng.choice(['{}', '<p>{}</p>', '<div>{}</div>']).format(say(2, 30))}</details>"
        if kind == 1:
            return f"<{(t := rng.choice(['ul', 'ul', 'ol']))}>" + "".join(f"<li>{linked_words()}</li>" for _ in range(rng.randint(1, 6))) + f"</{t}>"
        if kind == 2:
            return f"<figure{rng.choice(['', ' class=image'])}><img src=x.png>" + rng.choice(["<figcaption>{}</figcaption>", "<figcaption><p>{}</p></figcaption>"]).format(say(1, 12)) + "</figure>"
        if kind == 3:
            return "<dl>" + "".join(f"<dt>{say(1, 3)}</dt><dd>{say(1, 12)}</dd>" for _ in range(rng.randint(1, 4))) + "</dl>"
        if kind == 4:
            return f"<p{rng.choice([' hidden', chr(32) + 'style=' + chr(34) + 'display:none' + chr(34), '', ''])}>{rng.choice([say(1, 25), linked_words()])}</p>"
        if kind in (5, 6):
            return f"<{(t := rng.choice(['section', 'section', 'div']))}{rng.choice(['', '', ' class=part', ' id=s1'])}><h{(h := rng.choice('234'))}>{_CONTENT}{_words(rng, 1, 6)}</h{h}>" + "".join(f"<p>{say(1, 40)}</p>" for _ in range(rng.randint(1, 4))) + f"</{t}>"
        if kind == 7:
            return "<ul>" + "".join(f"<li><p>{say(1, 15)}</p></li>" for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind == 8:
            return "<table>" + rng.choice(["", f"<caption>{say(1, 5)}</caption>"]) + "<tbody>" + "".join(f"<tr><th>{say(1, 2)}</th><td>{rng.choice([say(1, 6), linked_words()])}</td></tr>" for _ in range(rng.randint(1, 5))) + "</tbody></table>"
        return f"<{(t := rng.choice(['address', 'hgroup', 'blockquote', 'div']))}><p>{say(1, 20)}</p></{t}>"

    def content() -> str:
        out = []
        if rng.random() < 0.85:
            title = f"<h1>{_CONTENT}{_words(rng, 1, 10)}</h1>"
            out.append(f"<header>{title}</header>" if rng.random() < 0.12 else title)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 14])):
            kind = rng.random()
            if kind < 0.62:
                out.append(f"<p>{say(1, rng.choice([3, 6, 30, 80]) if not short else 8)}" + rng.choice(["</p>", "</p>", "</p>", ""]))
            elif kind < 0.68:
                out.append(f"<h2>{_CONTENT}{_words(rng, 1, 6)}</h2>")
            elif kind < 0.74:
                out.append("<ul>" + "".join(f"<li>{say(1, 15)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.77:
                out.append(f"<blockquote>{rng.choice(['<p>{}</p>', '{}']).format(say(3, 30))}</blockquote>")
            elif kind < 0.80:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{_CONTENT}{_words(rng, 1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(rng.randint(1, 4))) + "</table>")
            elif kind < 0.82:
                out.append(f"<pre>{say(3, 20)}</pre>")
            elif kind < 0.85:
                out.append(f"<p>{_CONTENT}<b>{_sentence(rng, 2, 60)}<br>")
            elif kind < 0.88:
                out.append(f"<div>{say(3, 40)}</div>")
            else:
                out.append(part())
        for extra in (advert, share, form, side, comments, notice):
            if rng.random() < 0.12:
                out.insert(rng.randint(1, len(out)) if out else 0, extra())
        return "".join(out)

    if semantic and rng.random() < 0.8:
        main = f"<article{rng.choice(['', '', ' class=post', ' id=story'])}>{content()}</article>"
    else:
        main = f'<{(t := rng.choice(["div", "div", "main", "section"]))} {rng.choice(["class", "id"])}="{rng.choice("content article post entry-content story main-content article-body post-body text".split())}">{content()}</{t}>'
    if rng.random() < 0.4:
        main = rng.choice(["<main>{}</main>", '<div id="wrapper">{}</div>', '<div class="container"><div class="row">{}</div></div>', "<table><tr><td>{}</td></tr></table>"]).format(main + (side() if rng.random() < 0.4 else ""))
    before = [f() for f in (notice, header, menu, advert, form) if rng.random() < 0.45]
    after = [f() for f in (side, comments, advert, form, share, footer, notice) if rng.random() < 0.4]
    rng.shuffle(before)
    head = f"<head><title>{_words(rng, 1, 5)}</title><script>var a='</p>';</script></head>" if rng.random() < 0.8 else ""
    page = f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{rng.choice(['', '<!-- x -->'])}{main}{''.join(after)}"
    return page + rng.choice(["</body></html>", ""])


def train(pages: int = 400, seed: int = 7, rounds: int = 200, ridge: float = 0.2) -> Model:
    """Maximum likelihood by Adam on composed pages; both potentials' gradients are observed minus expected counts."""
    dom = Dom(labelled=True)
    for i in range(pages):
        dom.add(i, compose(seed * 100_003 + i))
    tree = Tree(dom)
    words = tree.own[:, 2]
    good = words * np.array(dom.marked)
    for level in reversed(tree.levels):
        np.add.at(good, tree.parent[level], good[level])
    # the smallest element around all content is content, what is around that is not, what is below is if it has any
    roots = np.searchsorted(np.array(dom.page), np.array(dom.page))
    around = (good >= good[roots]) & (good > 0)
    y = (good > 0).astype(int)
    y[around & (words == 0)] = 0
    inmost = around.copy()
    for level in tree.levels:
        inmost[tree.parent[level[around[level] & (words[level] == 0)]]] = False
    y[inmost] = 1
    kids = (tree.parent >= 0) & tree.live
    seen = np.zeros((len(_GROUPS), 2, 2))
    np.add.at(seen, (tree.group[kids], y[tree.parent[kids]], y[kids]), 1)
    theta = [np.zeros(_FEATURES), np.zeros((len(_GROUPS), 2, 2))]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, rounds + 1):
        full, pair, _ = tree.messages(tree.x @ theta[0], theta[1])
        p = 1 / (1 + np.exp(np.clip(full[:, 0] - full[:, 1], -50, 50)))
        both = np.exp(pair[kids] - np.logaddexp.reduce(pair[kids].reshape(-1, 4), axis=1)[:, None, None])
        told = np.zeros_like(seen)
        np.add.at(told, tree.group[kids], both)
        for i, gradient in enumerate((tree.x.T @ ((y - p) * tree.live) - ridge * theta[0], seen - told - ridge * theta[1])):
            m[i] = 0.9 * m[i] + 0.1 * gradient
            v[i] = 0.999 * v[i] + 0.001 * gradient**2
            theta[i] = theta[i] + 0.08 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Model(*theta)


def main_texts(htmls: list[str | None], model: Model, threshold: float = 0.5, keep_hidden: bool = True) -> list[str]:
    """The main text of each page: its content blocks in page order, joined by an empty line."""
    dom = Dom(keep_hidden=keep_hidden)
    for i, html in enumerate(htmls):
        dom.add(i, html or "")
    content = model.marginals(Tree(dom)) >= threshold
    out: list[list[str]] = [[] for _ in htmls]
    for at, text in dom.texts:
        if content[at]:
            out[dom.page[at]].append(text)
    return ["\n\n".join(x) for x in out]


def extract(pages: DataFrame, model: Model, threshold: float = 0.5, pages_at_once: int = 64, keep_hidden: bool = True) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row.

    Null and empty pages give the empty text; a page of bare text is judged as one block. Repeated rows are extracted
    each; other columns are ignored. Text that ``hidden`` or its style keeps from being shown is judged like any other, or left
    out without ``keep_hidden``. Elements nest to any depth and time is linear in a page. Memory is that of
    ``pages_at_once`` pages.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, pages_at_once):
                batch = whole.slice(at, pages_at_once)
                texts = main_texts(batch.column(2).to_pylist(), model, threshold, keep_hidden)
                arrays = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
