"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level tags. A linear classifier over tag and class roles,
length, link share and likeness to the title gives each block a cost of being called boilerplate (the
capacity from the source) or content (to the sink). Neighbouring blocks, and the next block under the same
parent, are joined by smoothness edges that weaken with the distance of their places in the document tree, and where only one
of them lies in a boilerplate element.
The minimum cut (by maximum flow) is the labelling of least total cost; the source's side is the text.

Roles are evidence of different strength. Tags that are never content (menus, forms, asides) and hidden elements cost more than all
edges of a block together; so, a little less, does a container whose class, id or role has a boilerplate word as a whole token
(``comments``, ``sidebar``). A word that is only part of a hyphenated token (``right-sidebar``), or stands on a
paragraph, weighs little, and nothing once an ``article`` or ``main`` begins below; on ``html``, ``body``, ``main`` and ``article`` such words
say nothing. Adverts, buttons and hidden text inside a line are left out of it. The rest is decided by the cut.

Cases: NULL or empty html gives an empty text; broken markup (unclosed or stray tags, a cut-off end) is
read as far as it goes; repeated pages are read one by one; an empty table gives an empty result; a page
of any length is read whole; extra columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's own tag groups.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template iframe textarea title svg math object canvas audio video xmp noembed noframes".split())
CLOSES_P = BLOCK_TAGS - {"body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}, "p": {"article", "body", "div", "section", "td", "th", "li", "blockquote", "main"}}
# Roles by tag and by the words of class, id and role attributes.
NEVER_TAGS = frozenset("nav footer aside form menu button select dialog search head".split())
NEVER_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar footer ad ads advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored cookie cookies consent notice notification alert popup modal overlay share sharing social related recommended comment comments reply replies disqus discussion respond subscribe newsletter signup login pagination pager widget toolbar copyright legal masthead contentinfo complementary skip".split())
GOOD_TAGS = frozenset("article main".split())
GOOD_WORDS = frozenset("article articlebody content post entry story main maincontent body text prose".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?][^>]*(?:>|\Z)|<\Z|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TOKEN = re.compile(r"[^\s\"']+")
_PART = re.compile(r"[a-z]+")
#: Where words of class and id say nothing against the text; where they stand on the text itself and say little.
ROOT_TAGS = frozenset("html body main article".split())
TEXT_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li dd dt td th figcaption caption".split())
#: Left out of the line they stand in: elements by tag, and others by these words.
MUTED_TAGS = frozenset("button select datalist".split())
MUTED_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo".split())

SMOOTH, SURE, CLEAR, HINT = 1.2, 50.0, 12.0, 4.0
#: Distance in the tree from which edges weigh the same.
FAR = 64


@dataclass
class Node:
    tag: str
    parent: Node | None
    depth: int
    against: float  # of this or an element above, whatever stands below
    hint: float  # of this or an element above, up to the next article
    good: bool


@dataclass
class Block:
    node: Node
    text: str
    linked: int
    edges: list[int] = field(default_factory=list)


@dataclass
class Roles:
    """What an element's attributes say: hidden, its whole tokens, and the words within them."""

    hidden: bool
    tokens: set[str]
    parts: set[str]


def _roles(attributes: str) -> Roles:
    out = Roles(False, set(), set())
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "style":
            out.hidden |= bool(_HIDING.search(value))
        elif name == "hidden" or name == "aria-hidden":
            out.hidden |= name == "hidden" or "true" in value.lower()
        else:
            for token in _TOKEN.findall(value):
                out.tokens.add(token.lower())
                out.parts.update(_PART.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", token).lower()))
    return out


_PLAIN = Roles(False, set(), set())


def _child(tag: str, parent: Node, roles: Roles) -> Node:
    """The node of a block-level element, with what tags and words say for and against it."""
    good = tag in GOOD_TAGS or bool(roles.tokens & GOOD_WORDS)
    against, hint = parent.against, 0.0 if good else parent.hint
    if roles.hidden or tag in NEVER_TAGS or tag == "header" and not parent.good:
        against = SURE
    elif tag not in ROOT_TAGS:
        if tag in TEXT_TAGS:
            hint = max(hint, HINT / 2) if roles.tokens & NEVER_WORDS else hint
        elif roles.tokens & NEVER_WORDS:
            against = max(against, CLEAR)
        elif roles.parts & NEVER_WORDS and not good:
            hint = max(hint, HINT)
    return Node(tag, parent, parent.depth + 1, against, hint, parent.good or good or bool(roles.parts & GOOD_WORDS))


def parse(page: str) -> tuple[list[Block], str]:
    """Blocks in page order, and the title."""
    root = Node("#", None, 0, 0.0, 0.0, False)
    blocks: list[Block] = []
    title, pieces, linked, links, at, node = "", [], 0, 0, 0, root
    opened: Counter[str] = Counter()
    muted, inside = "", 0  # the element that is left out of its line, and how often its tag is open

    def flush():
        nonlocal pieces, linked, muted
        muted = ""
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append(Block(node, text, linked))
            pieces, linked = [], 0

    def leave(to: Node):
        nonlocal node
        while node is not to:
            opened[node.tag] -= 1
            node = node.parent

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        stop = m.start() if m else size
        if stop > at and not muted:
            text = page[at:stop]
            if "&" in text:
                text = entities.unescape(text)
            pieces.append(text)
            if links:
                linked += len(text)
        if not m:
            break
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if muted and name == muted and not attributes.rstrip().endswith("/"):
            inside += -1 if closing else 1
            if not inside:
                muted = ""
                pieces.append(" ")
            continue
        if closing:
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCK_TAGS and opened[name] > 0:
                up = node
                while up.tag != name:
                    up = up.parent
                flush()
                leave(up.parent)
            continue
        if name in RAW_TAGS:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if name == "title" and not title:
                title = " ".join(entities.unescape(page[at: end.start() if end else size]).split())
            if not attributes.rstrip().endswith("/") or name in ("script", "style", "title", "textarea"):
                at = end.end() if end else size
            continue
        if name == "br":
            pieces.append(" ")
            continue
        roles = _roles(attributes) if attributes.strip() else _PLAIN
        if name not in BLOCK_TAGS:
            if not muted and name not in VOID_TAGS and (name in MUTED_TAGS or roles.hidden or roles.tokens & MUTED_WORDS) and not attributes.rstrip().endswith("/"):
                muted, inside = name, 1
                pieces.append(" ")
            elif name == "a":
                links += 1
            continue
        flush()
        if name in CLOSES_P:
            leave(_close(node, {"p"}, SCOPES["p"], opened))
        if name in SIBLINGS:
            leave(_close(node, SIBLINGS[name], SCOPES[name], opened))
        if name not in VOID_TAGS:
            node = _child(name, node, roles)
            opened[name] += 1
    flush()
    return blocks, title


def _close(node: Node, tags: set[str], scope: set[str], opened: Counter[str]) -> Node:
    """The parent of the innermost open one of ``tags``, unless something of ``scope`` is in between."""
    up = node
    while any(opened[t] > 0 for t in tags) and up.tag != "#" and up.tag not in scope:
        if up.tag in tags:
            return up.parent
        up = up.parent
    return node


def evidence(block: Block, title: str) -> float:
    """Log-odds of being content."""
    if block.node.against >= SURE:
        return -SURE
    words = block.text.count(" ") + 1
    share = block.linked / max(1, len(block.text))
    score = (3.0 if block.node.good else -0.5) + min(3.0, math.log(words) - 1.0) - 5.0 * share
    if block.node.tag in ("p", "pre", "blockquote"):
        score += 0.5
    elif block.node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        score += 1.5 if title and (block.text in title or title in block.text) else 0.5
    if block.text.startswith(("©", "(c) ", "Copyright")) and words < 30:
        score -= 3.0
    return score - block.node.against - block.node.hint


def _distance(a: Node, b: Node) -> int:
    steps = 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


class Flow:
    """Maximum flow by shortest augmenting levels; edges are stored in pairs (edge, reverse)."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, forth: float, back: float = 0.0) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.room.append(forth)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                b = self.to[e]
                if level[b] < 0 and self.room[e] > 1e-9:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Fill the network and return which nodes the source still reaches."""
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            turn = [0] * len(self.out)
            path: list[int] = []
            at = source
            while True:
                if at == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    cut = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    at = self.to[path[cut] ^ 1]
                    del path[cut:]
                while turn[at] < len(self.out[at]):
                    e = self.out[at][turn[at]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[at] + 1:
                        path.append(e)
                        at = self.to[e]
                        break
                    turn[at] += 1
                else:
                    if not path:
                        break
                    at = self.to[path.pop() ^ 1]
                    turn[at] += 1


def label(blocks: list[Block], title: str) -> list[bool]:
    """True for content: the source's side of the minimum cut."""
    n = len(blocks)
    net, last = Flow(n + 2), {}
    for i, b in enumerate(blocks):
        score = evidence(b, title)
        net.edge(n, i, score) if score > 0 else net.edge(i, n + 1, -score)
        parent = id(b.node.parent)
        near = {i - 1} if i else set()
        if parent in last:
            near.add(last[parent])
        for j in near:
            weight = SMOOTH / max(1, _distance(blocks[j].node, b.node) - 1)
            if (blocks[j].node.against > 0) != (b.node.against > 0):
                weight /= 4  # a menu beside a headline says little about it
            net.edge(j, i, weight, weight)
        last[parent] = i
    return net.source_side(n, n + 1)[:n]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks, title = parse(page)
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks, title)) if keep) if blocks else ""


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b["html"].to_pylist()]
            yield pa.record_batch([b["page_id"].cast(pa.int64()), b["url"].cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
