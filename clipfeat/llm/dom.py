"""Block-level trees of web pages, and alignment of two of them.

Only elements that make blocks are nodes; inline markup stays in the text of its block. End tags that HTML lets out are
supplied. The skeleton of a page is its tree without texts, in which neighbours of the same shape are one node, so a long
article and a short one have the same skeleton; the nodes of a skeleton, in their order, are the slots of the page.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

#: Elements that run inside the text of a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose whole content is no text of the page; those of RAW hold no markup either.
RAW = frozenset("script style textarea title xmp noframes noembed iframe noscript".split())
UNSEEN = RAW | frozenset("template svg math select datalist canvas audio video object button".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag closes, and the elements in which it looks for it.
CLOSES = {
    "li": ({"li"}, {"address", "div", "p"}), "dt": ({"dt", "dd"}, {"address", "div", "p"}), "dd": ({"dt", "dd"}, {"address", "div", "p"}),
    "td": ({"td", "th"}, PROSE | {"div"}), "th": ({"td", "th"}, PROSE | {"div"}), "tr": ({"tr"}, PROSE | {"div"}),
    **{t: ({"tbody", "thead", "tfoot"}, PROSE | {"div", "tr"}) for t in ("tbody", "thead", "tfoot")},
}
#: Parts of a page that are not its article: by element, by role, and by words in class and id.
ASIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies".split())
ASIDE_WORDS = COMMENT_WORDS | frozenset(
    "nav navbar navigation menu sidebar footer masthead banner topbar ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login search breadcrumb breadcrumbs pagination pager share sharing social related recommended recommendations widget widgets toolbar copyright".split()
)
#: A class that says what is beside an element or not there tells nothing of the element.
NOT_OWN = frozenset("with has no without not".split())
MOST_LEVELS = 100
#: Neighbours of the same shape that make a list, if they have children.
SEVERAL = 4

_TOKEN = re.compile(r"<!--(?:.*?)(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>?|<[!?/][^>]*+>?", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_CASES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    tag: str
    parent: int
    label: str
    aside: bool = False
    main: bool = False
    hidden: bool = False
    head: bool = False
    children: list = field(default_factory=list)


@dataclass
class Page:
    """Nodes in the order of their start tags, and blocks (node, text, characters inside links)."""

    nodes: list
    blocks: list
    skeleton: str = ""
    slots: list = field(default_factory=list)


@lru_cache(4096)
def _described(tag: str, attrs: str) -> tuple[str, bool, bool, bool, bool]:
    """(label, is it beside the article, does it say that it is the article, is it hidden, is it a header) of a start tag."""
    found = {}
    for m in _ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = f"{found.get('id', '')} {found.get('class', '')}".split()
    words = [[w.lower() for w in _CASES.findall(n)] for n in names]
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I) is not None
    known = COMMENT_WORDS if tag == "article" else frozenset() if tag in ("html", "body", "main") else ASIDE_WORDS
    aside = tag in ASIDE_TAGS or role in ASIDE_ROLES or any(known.intersection(w) and not NOT_OWN.intersection(w) for w in words)
    head = tag == "header" or tag not in ("html", "body", "main", "article") and any("header" in w and not NOT_OWN.intersection(w) for w in words)
    main = tag in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    label = ".".join([tag, *("-".join(w)[:40] for w in words if w)])
    return label, aside, main and not aside, hidden, head


def parse(html: str) -> Page:
    """The tree of a page, in one pass over its markup. Markup that is cut off or wrongly nested loses no text; elements nested
    deeper than MOST_LEVELS make blocks, but no further nodes."""
    nodes, blocks = [Node("html", -1, "html")], []
    stack, held, links = [0], [], 0
    link, muted, never = 0, None, set()  # link: levels that are open where a link began; muted: (tag, how many are open, levels)
    at = 0

    def close_block():
        nonlocal held, links
        if held and (text := " ".join("".join(held).split())):
            blocks.append((stack[-1], text, min(links, len(text))))
        held, links = [], 0

    def leave(level):
        nonlocal link, muted
        close_block()
        del stack[level:]
        link = link if link <= len(stack) else 0
        muted = muted if muted and muted[2] <= len(stack) else None

    def say(raw):
        nonlocal links
        if raw and not muted:
            text = unescape(raw) if "&" in raw else raw
            held.append(text)
            if link:
                links += len(text.strip())

    while m := _TOKEN.search(html, at):
        say(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag, attrs = tag.lower(), m[3]
        if m[1]:
            if muted and tag == muted[0]:
                muted = (tag, muted[1] - 1, muted[2]) if muted[1] > 1 else None
            elif tag == "a":
                link = 0
            elif tag not in INLINE and tag not in VOID:
                for level in range(len(stack) - 1, 0, -1):
                    if nodes[stack[level]].tag == tag:
                        leave(level)
                        break
                else:
                    close_block()
            continue
        if tag in UNSEEN and not attrs.endswith("/"):
            end = None if tag in never else re.compile(rf"</{tag}[^>]*>?", re.I).search(html, at)
            if end:
                at = end.end()
            elif tag in RAW:
                at = len(html)
            else:
                never.add(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                close_block()
            else:
                held.append(" ")
            continue
        if tag in INLINE:
            if muted:
                muted = (tag, muted[1] + 1, muted[2]) if tag == muted[0] else muted
            elif attrs and (d := _described(tag, attrs)) and (d[3] or d[1]):
                muted = (tag, 1, len(stack))
            elif tag == "a":
                link = len(stack)
            continue
        close_block()
        if tag in ("html", "body", "head"):
            if tag == "body" and attrs:
                nodes[0].label = _described(tag, attrs)[0]
            continue
        if nodes[stack[-1]].tag == "p" or tag in HEADINGS and nodes[stack[-1]].tag in HEADINGS:
            leave(len(stack) - 1)
        if tag in CLOSES:
            closed, through = CLOSES[tag]
            for level in range(len(stack) - 1, 0, -1):
                name = nodes[stack[level]].tag
                if name in closed:
                    leave(level)
                    break
                if name not in through:
                    break
        if len(stack) < MOST_LEVELS:
            label, aside, main, hidden, head = _described(tag, attrs.strip()) if attrs else (tag, tag in ASIDE_TAGS, tag in ("article", "main"), False, tag == "header")
            nodes.append(Node(tag, stack[-1], label, aside, main, hidden or muted is not None, head))
            nodes[stack[-1]].children.append(len(nodes) - 1)
            stack.append(len(nodes) - 1)
    say(html[at:])
    close_block()
    page = Page(nodes, blocks)
    _shape(page)
    return page


def _shape(page: Page) -> None:
    """The skeleton of a page, and the slot of each node."""
    nodes = page.nodes
    shape, size, runs = [""] * len(nodes), [1] * len(nodes), [[] for _ in nodes]
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        for c in n.children:
            if runs[i] and shape[runs[i][-1][0]] == shape[c]:
                runs[i][-1].append(c)
            else:
                runs[i].append([c])
        runs[i] = [part for r in runs[i] for part in ([r] if len(r) >= SEVERAL or not nodes[r[0]].children else [[c] for c in r])]
        name = "T" if not n.children and n.label in PROSE else n.label
        shape[i] = f"{name}({','.join(shape[r[0]] for r in runs[i])})" if n.children else name
        size[i] = 1 + sum(size[r[0]] for r in runs[i])
    page.skeleton, page.slots = shape[0], [0] * len(nodes)
    for i in range(len(nodes)):
        at = page.slots[i] + 1
        for r in runs[i]:
            for c in r:
                page.slots[c] = at
            at += size[r[0]]


def read_skeleton(skeleton: str) -> tuple[list[str], list[list[int]], list[int]]:
    """(labels, children, ends) of the slots of a skeleton; a slot's subtree is the slots up to its end."""
    labels, children, ends, stack = [], [], [], []
    for m in re.finditer(r"[^(),]+|[(),]", skeleton):
        if m[0] == "(":
            stack.append(len(labels) - 1)
        elif m[0] == ")":
            ends[stack.pop()] = len(labels)
        elif m[0] != ",":
            if stack:
                children[stack[-1]].append(len(labels))
            labels.append(m[0])
            children.append([])
            ends.append(len(labels))
    return labels, children, ends


#: Two lists of children whose lengths multiply to more than this are matched from left to right.
MOST_CELLS = 1_000_000


@lru_cache(2048)
def matched(a: str, b: str) -> tuple[int, ...]:
    """Simple tree matching of two skeletons: for each slot of ``a`` its slot of ``b``; for a slot without one, -1 - the slot of its
    nearest ancestor that has one. The match keeps the order of neighbours and has as many pairs as can be.
    Nothing is matched if the roots differ."""
    la, ca, _ = read_skeleton(a)
    lb, cb, _ = read_skeleton(b)
    weights: dict = {}

    def table(i, j):
        x, y = ca[i], cb[j]
        if len(x) * len(y) > MOST_CELLS:
            return None
        rows = [[0] * (len(y) + 1)]
        for p in x:
            last, row = rows[-1], [0]
            for k, q in enumerate(y):
                best = row[-1] if row[-1] > last[k + 1] else last[k + 1]
                if la[p] == lb[q] and (w := last[k] + weight(p, q)) > best:
                    best = w
                row.append(best)
            rows.append(row)
        return rows

    def greedy(i, j):
        pairs, k = [], 0
        for p in ca[i]:
            q = next((q for q in range(k, min(k + 1000, len(cb[j]))) if lb[cb[j][q]] == la[p]), None)
            if q is not None:
                pairs.append((p, cb[j][q]))
                k = q + 1
        return pairs

    def weight(p, q):
        if not ca[p] or not cb[q]:
            return 1
        if (p, q) not in weights:
            rows = table(p, q)
            weights[p, q] = 1 + (rows[-1][-1] if rows else len(greedy(p, q)))
        return weights[p, q]

    out = [-1] * len(la)
    if la[0] != lb[0]:
        return tuple(out)
    out[0], todo = 0, [(0, 0)]
    while todo:
        i, j = todo.pop()
        pairs, rows = [], table(i, j)
        if rows is None:
            pairs = greedy(i, j)
        else:
            m, n = len(ca[i]), len(cb[j])
            while m and n:
                p, q = ca[i][m - 1], cb[j][n - 1]
                if la[p] == lb[q] and rows[m][n] == rows[m - 1][n - 1] + weight(p, q):
                    pairs.append((p, q))
                    m, n = m - 1, n - 1
                elif rows[m][n] == rows[m - 1][n]:
                    m -= 1
                else:
                    n -= 1
        for p, q in pairs:
            out[p] = q
            todo.append((p, q))
    for i, x in enumerate(ca):
        for p in x:
            if out[p] < 0:
                out[p] = -1 - out[i] if out[i] >= 0 else out[i]
    return tuple(out)
