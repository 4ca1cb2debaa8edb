"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a variable with three states: a shell around other
blocks, content, or matter set apart.  A node has evidence (what its tag and names say,
how much text it holds itself and with its descendants, how much of it is links) and a
potential with its parent.  Messages go from the leaves to the root and back; their
product gives each block's marginals exactly.  Text of blocks that are content more
likely than not is the page's text, in page order.

What tags and names say are log odds like all evidence, counted on labelled pages on
top of what is known beforehand of words such as ``comments`` or ``widget``; nothing but
scripts, styles and the controls of forms is left out by rule.  A name around the page's
content, or a loose name that most of its text bears, says nothing on that page.  Below
a block that is firmly set apart, prose is no evidence, reader comments are prose too; and
within ``article`` or ``main`` lists and short lines are none against it.
Blocks of pages are labelled by their tags: inside ``article`` or ``main``, inside
``nav``, ``footer`` and so on.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfall.llm.shared import lean, thinned

#: At most this many pages, of at most this many characters, are used to fit.
FIT_PAGES = 800
FIT_CHARS = 200_000

# --- Fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset(
    "head script style title textarea template svg math iframe object noscript select button input canvas audio video "
    "datalist noembed noframes xmp".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
LIMITS = frozenset("ul ol dl table body html".split())

# --- Fixed values: what pages call their parts
CONTENT_TAGS = frozenset(("article", "main"))
WHOLE_TAGS = frozenset(("html", "body", "article", "main"))
OTHER_TAGS = frozenset(("nav", "footer", "aside", "header", "form", "menu", "dialog"))
CONTENT_WORDS = frozenset("article content main post story entry body text".split())
LOOSE_WORDS = frozenset("alert header legal overlay rail search side tags toolbar widget widgets".split())
FIRM_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus footer foot footnav masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted promotion related recommended respond reply replies share sharing sidebar "
    "skyscraper social sponsor sponsored subscribe topbar disclaimer copyright gdpr signup login".split()
)
OTHER_WORDS = FIRM_WORDS | LOOSE_WORDS

#: States of a block.
SHELL, CONTENT, APART = 0, 1, 2
#: Log potential of what cannot be; the weight of evidence from text, whose parts overlap, and of what is said by names.
NEVER, TEMPER, SAID = -1000.0, 0.25, 2.0
#: Blocks that a word or tag is taken to have been seen on beforehand.
FIRM, LOOSE, KNOWN_CONTENT = 400, 30, 20
#: Log odds that a block which declares itself the content by its tag is it; and from where on it is firmly apart.
DECLARED, FIRMLY = 10.0, -8.0
#: Log potential of a shell's own text, and of the pairs parent, child.
OWN_TEXT = -4.0
EDGE = np.log(np.array([[0.5, 0.25, 0.25], [1e-4, 1.0, 1e-4], [1e-6, 1e-6, 1.0]]))
#: Text that counts when a name is learned as one of content: so much of it, and so little of it links.
PROSE_CHARS, PROSE_LINKS = 100, 0.3

NAME_START = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
TAG_NAME = re.compile(r"[^\s/>]+")
TAG_STEP = re.compile(r"[>=]")
NOT_SPACE = re.compile(r"\S")
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "names", "words", "own", "links", "below", "silent", "wraps", "inside")

    def __init__(self, tag: str, parent: int, names: tuple[tuple[str, ...], ...], silent: bool, inside: bool):
        self.tag, self.parent, self.names, self.silent, self.inside = tag, parent, names, silent, inside
        self.words = frozenset(word for name in names for word in name)
        self.own = self.links = self.below = 0
        self.wraps = False


def _names(rest: str) -> tuple[tuple[str, ...], ...]:
    """The words of each name in class, id and role."""
    if "=" not in rest:
        return ()
    found = [a or b or c for a, b, c in NAMED.findall(rest)]
    split = (tuple(word.lower() for word in WORD.findall(name)) for value in found for name in value.split())
    return tuple(words for words in split if words)


def _markup(page: str, at: int) -> tuple[int, str, str, str]:
    """What begins with the ``<`` at a place: where it ends, its kind, and for tags their name and the rest.

    Kinds are ``start``, ``end``, ``cdata`` (the rest is its text), ``none`` (comments and
    the like) and ``text`` for a ``<`` that begins nothing.  Every character is looked at a
    bounded number of times: what is not closed takes the rest of the page with it.
    """
    after = page[at + 1 : at + 2]
    if after == "!" or after == "?":
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4 if not page.startswith("<!-->", at) else at + 2)
            return (len(page) if end < 0 else end + 3), "none", "", ""
        if page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9)
            return (len(page), "none", "", "") if end < 0 else (end + 3, "cdata", "", page[at + 9 : end])
        end = page.find(">", at + 2)
        return (len(page) if end < 0 else end + 1), "none", "", ""
    closing = after == "/"
    start = at + 1 + closing
    if page[start : start + 1] not in NAME_START or start >= len(page):
        return at + 1, "text", "", ""
    name = TAG_NAME.match(page, start)
    here = name.end()
    # A quote counts after an equals sign only, as in browsers.
    while (step := TAG_STEP.search(page, here)) and step[0] == "=":
        here = step.end()
        value = NOT_SPACE.search(page, here)
        if value and value[0] in "\"'":
            here = page.find(value[0], value.end()) + 1
            if not here:
                return len(page), "none", "", ""
    if not step:
        return len(page), "none", "", ""
    return step.end(), "end" if closing else "start", name[0].lower(), page[name.end() : step.start()]


class _Open:
    """Open elements, with what is asked of them kept up to date, so that no tag has to look through them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = []  # and the block that was current before
        self.blocks: list[int] = []  # places of elements that are not inline
        self.inline: list[dict[str, int]] = [{}]  # inline elements since each of these
        self.scopes: list[dict[str, int]] = [{}]  # all elements since each one that list items and cells do not leave
        self.count: dict[str, int] = {}
        self.anchors = 0

    def push(self, tag: str, before: int) -> None:
        if tag in INLINE:
            self.inline[-1][tag] = self.inline[-1].get(tag, 0) + 1
        else:
            self.blocks.append(len(self.stack))
            self.inline.append({})
        if tag in LIMITS:
            self.scopes.append({})
        else:
            self.scopes[-1][tag] = self.scopes[-1].get(tag, 0) + 1
        self.count[tag] = self.count.get(tag, 0) + 1
        self.stack.append((tag, before))
        self.anchors += tag == "a"

    def pop(self) -> tuple[str, int]:
        tag, before = self.stack.pop()
        if tag in INLINE:
            self.inline[-1][tag] -= 1
        else:
            self.blocks.pop()
            self.inline.pop()
        if tag in LIMITS:
            self.scopes.pop()
        else:
            self.scopes[-1][tag] -= 1
        self.count[tag] -= 1
        self.anchors -= tag == "a"
        return tag, before


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Blocks in page order, parents before children, and runs of text with their block.

    Inline elements belong to their block; an inline element whose names speak of
    other matter is a block of its own.  A break inside a block parts its text.
    Missing and stray end tags are put up with as browsers do.  Takes time in
    proportion to the page, however broken it is.
    """
    nodes = [Node("html", -1, (), False, False)]
    runs: list[tuple[int, str]] = []
    open_ = _Open()
    current = 0

    def text(raw: str) -> None:
        node = nodes[current]
        if node.silent or not raw:
            return
        plain = html.unescape(raw) if "&" in raw else raw
        runs.append((current, plain))
        size = len(plain) - plain.count(" ")
        if not plain.isspace():
            node.own += size
            if open_.anchors:
                node.links += size

    def leave(*tags: str) -> None:
        """Closes elements up to the last open one of these."""
        nonlocal current
        while True:
            tag, current = open_.pop()
            if tag in tags:
                return

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            text(page[at:])
            break
        text(page[at:start])
        at, kind, tag, rest = _markup(page, start)
        if kind == "text":
            text("<")
        elif kind == "cdata":
            text(html.escape(rest))
        elif kind == "end":
            if (open_.inline[-1] if tag in INLINE else open_.count).get(tag):
                leave(tag)
            if tag not in INLINE:
                runs.append((current, " "))
        if kind != "start":
            continue
        if tag == "br" or tag == "hr":
            runs.append((current, " "))
        if tag in VOID:
            continue
        if tag in CLOSES_P and open_.blocks and open_.stack[open_.blocks[-1]][0] == "p":
            leave("p")
        if tag in SIBLINGS:
            while any(open_.scopes[-1].get(other) for other in SIBLINGS[tag]):
                leave(*SIBLINGS[tag])
        names = _names(rest)
        open_.push(tag, current)
        if tag not in INLINE or any(word in OTHER_WORDS for name in names for word in name):
            above = nodes[current]
            inside = above.inside or above.tag in CONTENT_TAGS
            nodes.append(Node(tag, current, names, above.silent or tag in SILENT, inside))
            current = len(nodes) - 1
            if tag not in INLINE:
                runs.append((current, " "))
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            at = end.start() if end else size
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        node.below += node.own
        if node.parent >= 0:
            nodes[node.parent].below += node.below
    _find_wrappers(nodes)
    return nodes, runs


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I)


def _find_wrappers(nodes: list[Node]) -> None:
    """Marks the blocks around the page's content: they are not set apart, whatever they are called.

    The content is the largest block that a tag or, without one, a name declares as
    such; where nothing is declared, whatever holds most of the page's text.
    """
    if not any(_set_apart(node) for node in nodes):
        return
    tagged = [i for i, node in enumerate(nodes) if node.tag in CONTENT_TAGS and node.below]
    named = [
        i for i, node in enumerate(nodes)
        if node.words & CONTENT_WORDS and node.tag not in ("html", "body") and not _set_apart(node) and node.below
    ]
    declared = tagged or named
    if declared:
        # The innermost of equals, so that all around it are wrappers.
        i = nodes[max(declared, key=lambda i: (nodes[i].below, i))].parent
        while i >= 0:
            nodes[i].wraps = True
            i = nodes[i].parent
    else:
        for node in nodes:
            node.wraps = 2 * node.below > nodes[0].below


def _set_apart(node: Node) -> bool:
    """Whether a tag or name speaks of other matter, before anything is weighed."""
    return node.silent or node.tag in OTHER_TAGS or any(_head(name) in OTHER_WORDS for name in node.names)


def _head(name: tuple[str, ...]) -> str | None:
    """The word that a name is taken by: of one with words of both kinds the last, else that of other matter, firm first."""
    if any(word in CONTENT_WORDS for word in name):
        return name[-1]
    return next((word for words in (FIRM_WORDS, LOOSE_WORDS) for word in name if word in words), name[-1])


def features_said(node: Node) -> list[str]:
    """What a block is called: its tag, and the word of each of its names."""
    tag = f"tag {node.tag}" + (" inside" if node.tag == "header" and node.inside else "")
    named = () if node.tag in WHOLE_TAGS else sorted({f"word {_head(name)}" for name in node.names})
    return [tag, *named]


#: What is known of tags and words beforehand: blocks of content and blocks apart that they were seen on.
KNOWN = {
    **{f"word {word}": (0, FIRM) for word in FIRM_WORDS},
    **{f"word {word}": (0, LOOSE) for word in LOOSE_WORDS},
    **{f"word {word}": (KNOWN_CONTENT, 0) for word in CONTENT_WORDS},
    **{f"tag {tag}": (0, FIRM) for tag in OTHER_TAGS},
    "tag header inside": (LOOSE, 0),
}
#: Tags that say something; of others only what they hold counts.
TELLING = frozenset(f"tag {tag}" for tag in OTHER_TAGS) | {"tag header inside"}


def labels(nodes: list[Node]) -> list[int]:
    """1 inside content, 0 inside other matter, -1 where tags say nothing.

    Other matter inside content is other matter, not the other way round.
    """
    found: list[int] = []
    for node in nodes:
        above = found[node.parent] if node.parent >= 0 else -1
        apart = (node.tag in OTHER_TAGS and not (node.tag == "header" and node.inside)) and not node.wraps
        if above == 0 or node.silent or apart:
            found.append(0)
        else:
            found.append(1 if above == 1 or node.tag in CONTENT_TAGS else -1)
    return found


def _bucket(value: int) -> int:
    return min(9, value.bit_length() - 3 if value >= 8 else 0)


def evidence(node: Node) -> tuple[str, ...]:
    """What a block holds."""
    share = 0 if not node.own else 1 + min(4, 5 * node.links // node.own)
    return f"holds {node.tag}", f"size {_bucket(node.own)}", f"links {share}", f"below {_bucket(node.below)}"


@dataclass(frozen=True)
class Model:
    evidence: dict[str, float]  # log odds of content against matter apart, by what a block holds
    said: dict[str, float]  # the same, by what it is called


def count(pages: list[str]) -> Model:
    """Tables from pages that label their blocks."""
    seen: dict[str, np.ndarray] = {f"holds {tag}": np.array([0.0, 30.0]) for tag in CONTENT_TAGS}
    said = {name: np.array([float(apart), float(content)]) for name, (content, apart) in KNOWN.items()}
    for page in pages:
        nodes, _ = parse(page)
        # Links below, for names: of a block with its descendants.
        links = [node.links for node in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            links[nodes[i].parent] += links[i]
        for node, label, linked in zip(nodes, labels(nodes), links):
            if label < 0 or node.silent:
                continue
            for name in evidence(node):
                seen.setdefault(name, np.zeros(2))[label] += 1
            if label == 1 and (node.below < PROSE_CHARS or linked > PROSE_LINKS * node.below):
                continue
            for name in features_said(node):
                if name.startswith("word") or name in TELLING:
                    said.setdefault(name, np.zeros(2))[label] += 1
    total = np.sum([v for k, v in seen.items() if k.startswith("size ")] or [np.zeros(2)], axis=0) + 1
    # A tag alone tells less than text does: lists are menus on some pages and content on others.
    odds = {}
    for name, n in seen.items():
        most = 3 if name.startswith("holds") else 6
        odds[name] = float(np.clip(np.log((n[1] + 0.5) / total[1]) - np.log((n[0] + 0.5) / total[0]), -most, most))
    return Model(odds, {name: float(np.clip(np.log((n[1] + 1) / (n[0] + 1)), -6, 6)) for name, n in said.items()})


def said_odds(nodes: list[Node], model: Model) -> list[float]:
    """Log odds of content by what each block is called, on its page."""
    bearing: dict[str, int] = {}
    above: list[frozenset[str]] = []
    for node in nodes:
        up = above[node.parent] if node.parent >= 0 else frozenset()
        own = frozenset(f"word {word}" for word in node.words & LOOSE_WORDS)
        for name in own - up:
            bearing[name] = bearing.get(name, 0) + node.below
        above.append(up | own if own - up else up)
    whole = max(1, nodes[0].below)
    found = []
    for node in nodes:
        if node.wraps:
            found.append(0.0)
            continue
        odds = [model.said.get(name, 0.0) * (1 - bearing.get(name, 0) / whole) ** 2 for name in features_said(node)]
        # The strongest word against it counts, or else the strongest for it.
        low = min(odds)
        found.append(SAID * (low if low < 0 else max(odds)))
    return found


def potentials(nodes: list[Node], model: Model) -> tuple[np.ndarray, list[bool]]:
    """Log potential of each block's states, ``[n, 3]``, and whether it is independent of the block around it.

    What is silent or called other matter firmly says nothing about what it stands in:
    an article is no less one for the adverts in it.
    """
    said = said_odds(nodes, model)
    found = np.zeros((len(nodes), 3))
    firm: list[bool] = []
    alone = [i == 0 or node.silent or said[i] <= FIRMLY for i, node in enumerate(nodes)]
    for i, node in enumerate(nodes):
        below_firm = node.parent >= 0 and firm[node.parent]
        firm.append(below_firm or alone[i] and i > 0)
        if node.silent:
            found[i] = NEVER, NEVER, 0.0
            continue
        # Firmly apart, prose is no evidence, and where a tag declares content, lists and short lines are none.
        shape = not (firm[i] or node.inside or node.tag in CONTENT_TAGS)
        held = TEMPER * sum(model.evidence.get(x, 0.0) for x in evidence(node)) if shape else 0.0
        found[i, SHELL] = OWN_TEXT if node.own else 0.0
        found[i, CONTENT] = held / 2 + max(0.0, said[i]) + (DECLARED if node.tag in CONTENT_TAGS else 0.0)
        found[i, APART] = -held / 2 + max(0.0, -said[i])
    return found, alone


def marginals(nodes: list[Node], model: Model) -> np.ndarray:
    """Probabilities of each block's states, ``[n, 3]``: messages up, then down."""
    own, alone = potentials(nodes, model)
    edge = EDGE.tolist()
    inner = own.tolist()
    up: list[list[float]] = [[0.0] * 3] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        if alone[i]:
            continue
        message = [_plus(*(edge[a][b] + inner[i][b] for b in range(3))) for a in range(3)]
        up[i] = message
        parent = inner[nodes[i].parent]
        for a in range(3):
            parent[a] += message[a]
    down: list[list[float]] = [[0.0] * 3] * len(nodes)
    out = np.empty((len(nodes), 3))
    for i, node in enumerate(nodes):
        if not alone[i]:
            p = node.parent
            from_above = [inner[p][a] + down[p][a] - up[i][a] for a in range(3)]
            top = max(from_above)
            down[i] = [_plus(*(from_above[a] - top + edge[a][b] for a in range(3))) for b in range(3)]
        out[i] = [x + y for x, y in zip(inner[i], down[i])]
    out = np.exp(out - out.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def _plus(a: float, b: float, c: float) -> float:
    high = max(a, b, c)
    return high + math.log(math.exp(a - high) + math.exp(b - high) + math.exp(c - high))


def main_text(page: str, model: Model) -> str:
    nodes, runs = parse(page)
    chance = marginals(nodes, model)[:, CONTENT].tolist()
    kept = []
    for block, part in runs:
        if chance[block] > 0.5 or part.isspace():
            kept.append(part)
        else:
            kept.append(" ")
    return " ".join("".join(kept).split())


def train(pages: DataFrame, limit: int = FIT_PAGES, longest: int = FIT_CHARS) -> Model:
    """Tables from a bounded sample of pages, chosen by a hash of their text."""
    usable = pages.where(F.length("html").between(1, longest)).select("html")
    rows = (
        thinned(usable, F.xxhash64("html"), limit, usable.count())
        .orderBy(F.xxhash64("html"))
        .limit(limit)
        .collect()
    )
    return count([row[0] for row in rows])


def extracted(pages: DataFrame, model: Model) -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``.

    Null, empty and textless pages give the empty text, an empty table no rows.  Very
    long pages are read whole, in time in proportion to them.  Repeated rows give
    repeated results; other columns are not read.
    """

    @F.pandas_udf("string")
    @lean
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in batches:
            yield pd.Series([main_text(page, model) for page in pages_.fillna("")], dtype=object)

    found = pages.select("page_id", "url", text("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
