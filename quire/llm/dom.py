"""A page as a tree of text blocks, with features of each node."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img br math mi mn mo ms mtext mrow mfrac msup msub "
                   "msubsup msqrt mroot mover munder munderover mstyle mspace mpadded mtable mtr mtd semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
HIDDEN = frozenset("script style noscript template head title svg iframe object canvas audio video select option "
                   "textarea button datalist annotation annotation-xml".split())
#: Hidden elements that a slash in the start tag does not end.
NEVER_EMPTY = frozenset("script style noscript template title textarea select".split())
#: A start tag that ends an open paragraph, or an open element of its own kind.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
                   "pre section table ul".split())
OWN_KIND = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

#: Kinds of elements and of words in class, id and role, by what they usually hold.
TAGS = {"article": "article main", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside",
        "form": "form fieldset input", "list": "ul ol li dl dt dd", "para": "p blockquote pre", "head": "h1 h2 h3 h4 h5 h6",
        "table": "table tr td th tbody thead", "box": "div section body html", "text": "#text"}
TOKENS = {"article": "article articlebody content contents entry post story text body main page prose copy",
          "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager toc skip links topbar",
          "header": "header head masthead banner branding logo title top",
          "footer": "footer foot copyright legal colophon bottom credits",
          "side": "side sidebar aside widget widgets rail secondary complementary column",
          "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner dfp adsbox commercial",
          "notice": "notice cookie cookies consent gdpr popup modal overlay alert warning message toast privacy announcement",
          "comment": "comment comments commentlist reply replies respond discussion disqus thread feedback reader",
          "form": "form search subscribe subscription newsletter signup login register contact input",
          "more": "share sharing social related recommended tags tag meta byline popular recent teaser"}
TAG_OF = {t: k for k, ts in TAGS.items() for t in ts.split()}
TOKEN_OF: dict[str, list[str]] = {}
for _k, _ts in TOKENS.items():
    for _t in _ts.split():
        TOKEN_OF.setdefault(_t, []).append(_k)
TAG_AT = {k: i for i, k in enumerate(TAGS)}
TOKEN_AT = {k: i for i, k in enumerate(TOKENS)}
FEATURES = ([f"tag_{k}" for k in TAGS] + [f"token_{k}" for k in TOKENS] + [f"above_{k}" for k in TAGS]
            + [f"above_token_{k}" for k in TOKENS]
            + "depth words chars_per_word link_share links_per_word words_per_block blocks stops share_of_page "
              "share_of_parent place siblings sibling_mean before_link after_link outside inside nearest outside_above".split())
#: Places in the first part of the features that speak against and for main text.
OUTSIDE = [TAG_AT[k] for k in ("nav", "header", "footer", "aside", "form")] + [
    len(TAGS) + TOKEN_AT[k] for k in TOKENS if k != "article"]
INSIDE = [TAG_AT["article"], len(TAGS) + TOKEN_AT["article"]]
_word = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "tokens", "parts", "linked", "links", "words", "chars", "stops",
                 "blocks", "size", "mark")

    def __init__(self, tag: str, parent: int, tokens: tuple = (), mark: str | None = None):
        self.tag, self.parent, self.tokens, self.mark = tag, parent, tokens, mark
        self.children: list[int] = []
        self.parts: list[str] = []
        self.linked = self.links = self.words = self.chars = self.stops = self.blocks = self.size = 0


class Page(HTMLParser):
    """``nodes`` in page order, the parent before its children; text is held
    by leaves only (runs beside block children become ``#text`` leaves)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1)]
        self.open: list[tuple[int, str, int]] = []  # number and tag of what is open, and the block it belongs to
        self.places: dict[str, list[int]] = {}  # the numbers of each open tag; "" for all blocks
        self.serial = 0
        self._push("#page", 0)
        self.hidden: list[str] = []  # an open hidden element and what is open in it
        self.within: dict[str, int] = {}  # how many of each tag these are
        self.anchors = 0
        self.run = -1  # leaf that takes the next text
        self.feed(html)
        self.close()
        self._sum()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...>`` outside markup that knows it is a comment, whatever it holds."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _push(self, tag: str, block: int) -> None:
        self.serial += 1
        self.open.append((self.serial, tag, block))
        for key in (tag,) if tag in INLINE else (tag, ""):
            self.places.setdefault(key, []).append(self.serial)

    def _hide(self, tag: str) -> None:
        self.hidden.append(tag)
        self.within[tag] = self.within.get(tag, 0) + 1

    def _last(self, tag: str) -> int:
        """Number of the last open ``tag``, 0 without one. So no end tag and no
        start tag ever looks through all that is open."""
        at = self.places.get(tag)
        return at[-1] if at else 0

    def _cut(self, number: int) -> None:
        """Everything from ``number`` on is closed."""
        while self.open[-1][0] >= number:
            serial, tag, _ = self.open.pop()
            for key in (tag,) if tag in INLINE else (tag, ""):
                at = self.places[key]
                if at and at[-1] == serial:  # not ended by itself before
                    at.pop()
                    self.anchors -= key == "a"

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden:
            if tag not in VOID:
                self._hide(tag)
            return
        if tag in HIDDEN:
            if tag != "head":  # only its known children are hidden: a page may never close it
                self._hide(tag)
            return
        if tag in INLINE:
            if tag == "br":
                self._text("\n")
            elif tag == "a":
                self.anchors += 1
                if self.run >= 0:
                    self.nodes[self.run].links += 1
                self._push(tag, self.open[-1][2])
            elif tag not in VOID:
                self._push(tag, self.open[-1][2])
            return
        if tag in VOID and tag != "hr":
            if tag == "input":
                self.run = -1
            return
        if tag in ENDS_P:
            self._close("p", stop=ENDS_P - {"p"})
        if tag in OWN_KIND:
            for t in (("td", "th", "tr") if tag == "tr" else ("td", "th") if tag in ("td", "th") else
                      ("dt", "dd") if tag in ("dt", "dd") else (tag,)):
                self._close(t, stop=OWN_KIND[tag])
        self.run = -1
        if tag == "hr":
            return
        words: list[str] = []
        mark = None
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                words += _word.findall(value.lower())
            elif name == "data-part":
                mark = value
        parent = self.open[-1][2]
        self.nodes.append(Node(tag, parent, tuple(words), mark))
        self.nodes[parent].children.append(len(self.nodes) - 1)
        self._push(tag, len(self.nodes) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if self.hidden or (tag in HIDDEN and tag not in NEVER_EMPTY):
            return
        self.handle_starttag(tag, attrs)

    def _close(self, tag: str, stop=frozenset()) -> None:
        at = self._last(tag)
        if at and all(self._last(t) < at for t in stop):
            self._cut(at)
            self.run = -1

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if self.within.get(tag):
                last = None
                while last != tag:
                    last = self.hidden.pop()
                    self.within[last] -= 1
                return
            if tag in INLINE or not self._last(tag):
                return
            self.hidden.clear()
            self.within.clear()  # the end of a block around it ends a hidden element too
        if tag in INLINE:
            at = self._last(tag)
            if at > self._last(""):
                # it may lie under other inline tags, which stay open
                self.places[tag].pop()
                self.anchors -= tag == "a"
                while self.open[-1][0] not in self.places.get(self.open[-1][1], ())[-1:]:
                    self.open.pop()
            return
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self._text(data)

    def _text(self, data: str) -> None:
        blank = not data.strip()
        if self.run < 0:
            if blank:
                return
            at = self.open[-1][2]
            self.nodes.append(Node("#text", at))
            self.nodes[at].children.append(len(self.nodes) - 1)
            self.run = len(self.nodes) - 1
        leaf = self.nodes[self.run]
        leaf.parts.append(data)
        if self.anchors and not blank:
            leaf.linked += len(data)
            leaf.links = max(leaf.links, 1)

    def _sum(self) -> None:
        for node in reversed(self.nodes):
            if node.parts:
                text = "".join(node.parts)
                words = text.split()
                node.parts = [" ".join(words)]
                node.words, node.chars, node.blocks = len(words), len(node.parts[0]), 1
                node.stops = sum(map(text.count, ".,;:!?"))
            node.size += 1
            if node.parent >= 0:
                up = self.nodes[node.parent]
                for k in ("linked", "links", "words", "chars", "stops", "blocks", "size"):
                    setattr(up, k, getattr(up, k) + getattr(node, k))

    def features(self) -> np.ndarray:
        """A row of FEATURES for each node."""
        nt, nk = len(TAGS), len(TOKENS)
        total = max(self.nodes[0].words, 1)
        own: list[list[float]] = []
        nearest: list[float] = []  # does the closest node that says anything speak for main text?
        out, above, depth = np.zeros((len(self.nodes), len(FEATURES))), [[0.0] * (nt + nk)], [0]
        places = {c: j for node in self.nodes for j, c in enumerate(node.children)}
        for i, node in enumerate(self.nodes):
            mine = [0.0] * (nt + nk)
            at = TAG_AT.get(TAG_OF.get(node.tag, ""), -1)
            if at >= 0:
                mine[at] = 1.0
            for t in node.tokens:
                for k in TOKEN_OF.get(t, ()):
                    mine[nt + TOKEN_AT[k]] = 1.0
            own.append(mine)
            against, favour = sum(mine[k] for k in OUTSIDE), sum(mine[k] for k in INSIDE)
            nearest.append(-1.0 if against else 1.0 if favour else nearest[node.parent] if node.parent >= 0 else 0.0)
            if node.parent < 0:
                up, place, siblings, level = node, 0, 1, 0
                over = [0.0] * (nt + nk)
            else:
                up = self.nodes[node.parent]
                siblings, level = len(up.children), depth[node.parent] + 1
                over = [max(a, b) for a, b in zip(above[node.parent], own[node.parent])]
            if i:
                above.append(over)
                depth.append(level)
            place = places.get(i, 0)
            link = node.linked / max(node.chars, 1)
            sides = []
            for j in (place - 1, place + 1):
                if node.parent >= 0 and 0 <= j < siblings:
                    s = self.nodes[up.children[j]]
                    sides.append(s.linked / max(s.chars, 1))
                else:
                    sides.append(-1.0)
            out[i] = mine + over + [
                float(level), math.log1p(node.words), node.chars / max(node.words, 1), min(link, 1.0),
                node.links / max(node.words, 1), node.words / max(node.blocks, 1), float(node.blocks),
                node.stops / max(node.words, 1), node.words / total, node.words / max(up.words, 1),
                place / siblings, float(siblings), up.words / siblings, *sides,
                against, favour, nearest[i], sum(over[k] for k in OUTSIDE)]
        return out


def decode(nodes: list[Node], odds: list[float], split_cost: float = 1.0) -> list[bool]:
    """Which nodes are main text: every subtree is wholly in, wholly out or
    split among its children, whichever has the largest sum of log odds (in:
    as they are, out: negated), so that no choice contradicts one above it."""
    n = len(nodes)
    whole, best = list(odds), [0.0] * n
    choice = [0] * n
    for i in range(n - 1, -1, -1):
        kids = nodes[i].children
        whole[i] += sum(whole[c] for c in kids)
        best[i], choice[i] = (whole[i], 1) if whole[i] > 0 else (-whole[i], -1)
        if kids:
            apart = sum(best[c] for c in kids) - split_cost
            if apart > best[i] or nodes[i].parent < 0:
                best[i], choice[i] = apart, 0
    for i in range(1, n):
        up = choice[nodes[i].parent]
        if up:
            choice[i] = up
    return [c == 1 for c in choice]
