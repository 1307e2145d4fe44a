"""HTML to a tree of blocks, and the features of its nodes.

A forgiving reader: unknown, unclosed and misnested tags never fail.  Inline elements are part of
the block they stand in; what is never shown (scripts, styles, head, comments) is left out.  A
text run that stands beside child blocks is a leaf of its own, so every text belongs to one leaf.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np

# Element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math xmp select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small"
    " span strike strong sub sup time tt u var".split()
)
BREAKS = frozenset("br hr".split())  # void, but they end a line
CLOSES = {  # a start tag ends these open elements, up to the nearest holder
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("td", "th", "tr", "thead", "tbody"), "tfoot": ("td", "th", "tr", "thead", "tbody"),
}
HOLDERS = frozenset("ul ol dl table select body html article section div".split())
TAGS = (  # element names with a feature of their own; inline ones are no nodes
    "nav header footer aside article main section div p h1 h2 h3 ul ol li form button table td"
    " blockquote pre figure figcaption dl dd body html #text"
).split()
GROUPS = {  # words of class, id and role by what they announce
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc tabs pager pagination",
    "foot": "footer foot copyright contentinfo legal imprint bottom colophon",
    "head": "header head masthead topbar top logo branding site",
    "side": "side sidebar aside widget widgets rail complementary related recommended more trending",
    "talk": "comment comments reply replies respond discussion disqus thread responses feedback",
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr privacy message newsletter"
    " subscribe signup paywall toast",
    "share": "share sharing social follow tags meta byline author tools actions search login form",
    "body": "content article post entry story body main text prose page copy",
}
GROUP_NAMES = list(GROUPS)
_GROUP_OF = {word: g for g, words in enumerate(GROUPS.values()) for word in words.split()}
_TAG_OF = {name: i for i, name in enumerate(TAGS)}
_HOLDING = ("nav", "header", "footer", "aside", "form", "article", "main")  # asked of ancestors

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([A-Za-z][^\s/>]*)((?:[^>\"']+|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}
_HEAD = ("head", "title", "meta", "link", "base")
_PUNCTUATION = ".,;:!?"


class Node:
    __slots__ = ("tag", "parent", "kids", "depth", "groups", "texts", "links", "mark", "start")

    def __init__(self, tag: str, parent: Node | None, groups: int, mark: str | None) -> None:
        self.tag, self.parent, self.kids, self.groups = tag, parent, [], groups
        self.depth = 0 if parent is None else parent.depth + 1
        self.texts: list[str] = []  # pieces; None is a line end
        self.links = 0  # characters inside links
        self.mark = mark
        self.start = 0


def _announced(attributes: str) -> int:
    """Bit mask of the groups whose words stand in class, id or role."""
    mask = 0
    if "=" in attributes:
        for found in _ATTRIBUTE.finditer(attributes):
            for word in _WORDS.findall(found[2] or found[3] or found[4] or ""):
                group = _GROUP_OF.get(word.lower())
                if group is not None:
                    mask |= 1 << group
    return mask


def parse(html: str | None) -> list[Node]:
    """Nodes in page order, the root first; every text is held by a node without children."""
    root = Node("html", None, 0, None)
    nodes, stack = [root], ["html"]  # open element names, inline ones included
    open_: list[Node] = [root]  # node of each name on the stack
    links, at, hidden = 0, 0, 0
    fresh = True  # whether a text starts a new run
    html = html or ""

    def put(text: str) -> None:
        nonlocal fresh
        holder = open_[-1]
        if holder.kids or holder.tag in ("html", "body"):
            last = holder.kids[-1] if holder.kids else None
            if fresh or last is None or last.tag != "#text":
                if not text.strip():
                    return
                last = Node("#text", holder, 0, holder.mark)
                holder.kids.append(last)
                nodes.append(last)
            holder = last
        holder.texts.append(text)
        if links:
            holder.links += len(text)
        fresh = False

    def close(to: int) -> None:
        nonlocal links, fresh, hidden
        for name in stack[to:]:
            links -= name == "a"
            hidden -= name == "head"
            fresh = fresh or name not in INLINE
        del stack[to:], open_[to:]

    while at < len(html):
        lt = html.find("<", at)
        found = _TOKEN.match(html, lt) if lt >= 0 else None
        while lt >= 0 and found is None:  # a bare <
            lt = html.find("<", lt + 1)
            found = _TOKEN.match(html, lt) if lt >= 0 else None
        text = html[at:] if found is None else html[at:lt]
        if text and not hidden:
            put(unescape(text))
        if found is None:
            break
        at = found.end()
        if found[1]:
            name = found[1].lower()
            if name in ("html", "body") or name not in stack:
                if name == "p":
                    open_[-1].texts.append(" ") if not open_[-1].kids else None
                    fresh = True
                continue
            to = len(stack) - 1 - stack[::-1].index(name)
            if name in INLINE and any(n not in INLINE for n in stack[to + 1 :]):
                continue  # an inline end does not end blocks
            close(to)
        elif found[2]:
            name, attributes = found[2].lower(), found[3] or ""
            if name == "html":
                continue
            if hidden and name not in _HEAD and name not in RAW:
                close(stack.index("head"))
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
                continue
            if name in VOID:
                if name in BREAKS and not open_[-1].kids:
                    open_[-1].texts.append(" ")
                elif name in BREAKS:
                    fresh = True
                continue
            if name not in INLINE and "p" in stack:  # no block lies in a paragraph
                close(len(stack) - 1 - stack[::-1].index("p"))
            for ended in CLOSES.get(name, ()):
                for to in range(len(stack) - 1, 0, -1):
                    if stack[to] == ended:
                        close(to)
                        break
                    if stack[to] in HOLDERS:
                        break
            holder = open_[-1]
            if name in INLINE:
                links += name == "a"
            elif name == "head":
                hidden += 1
            else:
                if any(t.strip() for t in holder.texts):  # its text becomes a leaf beside the block
                    leaf = Node("#text", holder, 0, holder.mark)
                    leaf.texts, leaf.links = holder.texts, holder.links
                    holder.kids.append(leaf)
                    nodes.append(leaf)
                holder.texts, holder.links = [], 0
                mark = holder.mark
                if "data-t" in attributes:
                    mark = "1" if 'data-t="1"' in attributes else "0"
                child = Node(name, holder, _announced(attributes), mark)
                holder.kids.append(child)
                nodes.append(child)
                holder = child
                fresh = True
            stack.append(name)
            open_.append(holder)
    return nodes


def block_text(node: Node) -> str:
    """Text of a leaf, white space (any that Unicode knows) turned into single spaces."""
    return " ".join("".join(node.texts).split())


# Columns of the matrix that features() gives, in order
FEATURES = (
    [f"tag {t}" for t in TAGS]
    + [f"says {g}" for g in GROUPS]
    + [f"within {g}" for g in GROUPS]
    + [f"in {t}" for t in _HOLDING]
    + ["depth", "chars", "links", "stops", "words a leaf", "leaves", "leaves a char", "share of page",
       "start", "end", "siblings", "place", "share of siblings", "same tag", "mean of siblings",
       "share of parent", "links of parent", "has h1", "has fields", "holds advert", "holds article"]
)


def features(nodes: list[Node]) -> tuple[np.ndarray, list[str]]:
    """A row of numbers for each node, and the text of each leaf (empty for others).

    Counts are of the subtree; siblings and ancestors are asked for theirs.
    """
    n, base = len(nodes), len(TAGS) + 2 * len(GROUPS) + len(_HOLDING)
    x = np.zeros((n, len(FEATURES)))
    index = {id(node): i for i, node in enumerate(nodes)}
    texts = [block_text(node) if not node.kids else "" for node in nodes]
    parents = [index[id(v.parent)] if v.parent is not None else -1 for v in nodes]
    parent = np.array(parents)
    order = np.array([len(t) for t in texts])
    before = np.concatenate(([0], np.cumsum(order)[:-1]))
    total = max(1, int(order.sum()))
    chars, links, stops, words, leaves, h1, fields, adverts, articles = (
        [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n,
    )
    for i in range(n - 1, -1, -1):  # children come after their parent
        node, text = nodes[i], texts[i]
        if text:
            chars[i] += len(text)
            links[i] += min(node.links, len(text))
            stops[i] += sum(map(text.count, _PUNCTUATION))
            words[i] += text.count(" ") + 1
            leaves[i] += 1
        h1[i] |= node.tag == "h1"
        fields[i] |= node.tag in ("form", "button", "fieldset")
        adverts[i] |= node.groups & 1
        articles[i] |= node.tag in ("article", "main")
        up = parents[i]
        if up >= 0:
            for counts in (chars, links, stops, words, leaves):
                counts[up] += counts[i]
            for flags in (h1, fields, adverts, articles):
                flags[up] |= flags[i]
    above, held = [0] * n, [0] * n
    bits = {t: 1 << i for i, t in enumerate(_HOLDING)}
    for i, up in enumerate(parents):
        if up >= 0:
            above[i] = above[up] | nodes[up].groups
            held[i] = held[up] | bits.get(nodes[up].tag, 0)
    kinds = np.array([_TAG_OF.get(v.tag, -1) for v in nodes])
    known = np.flatnonzero(kinds >= 0)
    x[known, kinds[known]] = 1
    own = len(TAGS)
    for masks, width in (([v.groups for v in nodes], len(GROUPS)), (above, len(GROUPS)), (held, len(_HOLDING))):
        x[:, own : own + width] = np.array(masks)[:, None] >> np.arange(width) & 1
        own += width
    up = np.where(parent >= 0, parent, np.arange(n))
    size, link, stop, word, leaf = (np.array(c, dtype=float) for c in (chars, links, stops, words, leaves))
    family = np.array([1 if v.parent is None else len(v.parent.kids) for v in nodes])
    some = np.maximum(1, size)
    x[:, base:] = np.stack(
        (
            np.array([v.depth for v in nodes]), np.log1p(size), link / some, stop / np.maximum(1, word),
            np.log1p(word / np.maximum(1, leaf)), np.log1p(leaf), leaf / some, size / total,
            before / total, (before + size) / total, np.log1p(family), *[np.zeros(n)] * 4,
            size / some[up], (link / some)[up], h1, fields, adverts, articles,
        ),
        axis=1,
    )
    for node in nodes:  # statistics among siblings, once for each parent
        if not node.kids:
            continue
        at, most = [index[id(k)] for k in node.kids], len(node.kids)
        sizes = [chars[i] for i in at]
        greatest, mean = max(1, *sizes), float(np.log1p(sum(sizes) / most))
        tags = [k.tag for k in node.kids]
        same = {t: tags.count(t) / most for t in set(tags)}
        x[at, base + 11 : base + 15] = [
            (place / most, chars[i] / greatest, same[tags[place]], mean) for place, i in enumerate(at)
        ]
    return x, texts
