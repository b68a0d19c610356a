"""Main text of web pages by composite text density.

Every node of the page's tree has C characters, T tags, LC characters and LT
tags in links below it; its density is C/T, adjusted for links:

    C/T · log_b( C·T / (LC·LT) ),   b = ln( C·LC/(C-LC) + LCB·C/CB + e )

(LCB, CB: the body's; zero counts are 1).  Each node's sum is the densities of
its block children (a node without any: its own); inline elements count as
tags only.  The node with the largest
sum is the article's body; the least density on the path from it to the
body is the threshold.  The main text is that node, every block and bare text beside the path at or above the
threshold, and the headings directly before what is taken.  Where the whole body is the node, blocks that are
mostly links go.

Elements that never hold an article's text (menus, asides, scripts, …), and blocks that names say are
comments, adverts, cookie notices and the like, are taken out before densities are measured; headers only outside
an article, forms only where they hold less than half of the page's text.  Names that may mean anything (side, social,
notice, …) decide where density doesn't: such a block goes if it is below the threshold, or stands in the body itself.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements and names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
DROPPED = frozenset(("script style noscript template svg math iframe object embed nav footer aside "
                     "button select option textarea input dialog menu canvas audio video head title").split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option "
                   "p pre section summary table tbody td tfoot th thead tr ul caption").split())
CLOSES_P = BLOCK - frozenset("dd dt li td th tr tbody thead tfoot caption legend option optgroup summary body html".split())
SAME_LEVEL = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dd dt", {"dl"}), "dd": ("dd dt", {"dl"}),
              "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
              "option": ("option", {"select"})}
#: Parts of class and id names of blocks that are no article, whatever their density …
STRONG = re.compile(r"(?:ads?|advert\w*|adsense|breadcrumbs?|comments?|commentlist|disqus|cookies?|consent|gdpr|newsletters?|popups?|modal|promos?|"
                    r"promotions?|sponsor\w*|subscribe|subscription|sidebar|navbar|navigation|masthead|respond)", re.I)
#: … and names that say so only together with a low density, or beside the article.
WEAK = frozenset(("alert banner footer header menu nav notice notices related replies share sharing side social toolbar widget widgets").split())
#: Parts that may stand with the weak ones in a name.
FILLER = frozenset(("area bar block box bottom bottomside button buttons col column container content count global icons inner item items left link links list "
                    "main outer page panel post posts right row section site stories story top wrap wrapper").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "kids", "dropped", "weak", "parent", "chars", "tags", "link_chars", "link_tags", "density", "total", "inner")

    def __init__(self, tag: str, parent: "Node | None", dropped: bool, weak: bool = False):
        self.tag, self.parent, self.dropped, self.weak = tag, parent, dropped, weak
        self.kids: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.inner: list[Node] = []


def _named(value: str) -> tuple[bool, bool]:
    """(strongly, weakly) unwanted by a class or id: its names one by one, each by its parts."""
    strong = weak = False
    for name in value.lower().split():
        parts = [x for x in re.split(r"[_-]+", name) if x]
        # "ad" only at an end of a name, and never in "ad-hoc"
        strong |= any(STRONG.fullmatch(x) and (x != "ad" or i in (0, len(parts) - 1)) for i, x in enumerate(parts)) and "hoc" not in parts
        weak |= any(x in WEAK for x in parts) and all(x in WEAK or x in FILLER or x.isdigit() for x in parts)
    return strong, weak


def _unwanted(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """(dropped, weakly named) by element and attributes."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True, False
    weak = False
    if tag in ("html", "body", "article", "main") or not attrs.strip():
        return False, False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name == "role" and value.lower() in ROLES:
            return True, False
        if name in ("class", "id"):
            strong, more = _named(value)
            if strong:
                return True, False
            weak |= more
    return False, weak


def parse(page: str) -> Node:
    """The page's tree; dropped subtrees keep their place but no text.  Missing and crossing end tags are tolerated."""
    root = Node("#root", None, False)
    at, node = 0, root
    is_open: Counter[str] = Counter()  # elements from the root down to the node

    def text(piece: str) -> None:
        if piece and not node.dropped:
            node.kids.append(html_lib.unescape(piece))

    def up_to(names: tuple[str, ...] | set[str], stop: frozenset | set = frozenset()) -> Node | None:
        if not any(is_open[t] for t in names):
            return None
        x = node
        while x.tag not in names:
            if x.tag in stop:
                return None
            x = x.parent
        return x

    def back_to(x: Node) -> Node:
        n = node
        while n is not x:
            is_open[n.tag] -= 1
            n = n.parent
        return x

    while m := _TAG.search(page, at):
        if m[2] is None or (m.end() == m.start()):
            text(page[at:m.start()])
            at = m.end()
            continue
        text(page[at:m.start()])
        at, tag = m.end(), m[2].lower()
        if m[1]:
            found = up_to((tag,), () if tag in ("body", "html", "div", "section", "article") else {"td", "th", "table"} - {tag})
            if found is not None:
                node = back_to(found.parent)
            elif tag in ("p", "br"):
                node.kids.append(Node(tag, node, node.dropped))
            continue
        if tag in CLOSES_P and (p := up_to(("p",), {"td", "th", "table", "li", "button", "object"})) is not None:
            node = back_to(p.parent)
        if tag in SAME_LEVEL:
            names, stop = SAME_LEVEL[tag]
            if (x := up_to(tuple(names.split()), stop)) is not None:
                node = back_to(x.parent)
                if tag == "tr" and node.tag == "tr":
                    node = back_to(node.parent)
        if tag in ("html", "body") and up_to((tag,)) is not None:
            continue
        if tag == "body" and (h := up_to(("head",))) is not None:
            node = back_to(h.parent)
        dropped, weak = _unwanted(tag, m[3] or "", bool(is_open["article"] or is_open["main"]))
        child = Node(tag, node, node.dropped or dropped, weak)
        node.kids.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end is None:
                at = len(page) if tag in ("script", "style") else at
                continue
            at = end.end()
            continue
        is_open[tag] += 1
        node = child
    text(page[at:])
    return root


def _post_order(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack += [k for k in n.kids if isinstance(k, Node) and not k.dropped]
    return out[::-1]


def measure(root: Node) -> Node:
    """Fills in counts, densities and sums; returns the body (or the root)."""
    order = _post_order(root)
    for n in order:
        n.chars = n.link_chars = n.tags = n.link_tags = 0
        for k in n.kids:
            if isinstance(k, str):
                n.chars += len(_WHITE.sub(" ", k).strip())
            elif not k.dropped:
                n.chars += k.chars
                n.tags += k.tags + 1
                n.link_chars += k.chars if k.tag == "a" else k.link_chars
                n.link_tags += k.link_tags + (k.tag == "a")
    body = next((n for n in reversed(order) if n.tag == "body"), root)
    share = body.link_chars / max(1, body.chars)
    for n in order:
        c, t = n.chars, max(1, n.tags)
        if c == 0:
            n.density = 0.0
        else:
            lc, lt = max(1, n.link_chars), max(1, n.link_tags)
            base = math.log(c * n.link_chars / max(1, c - n.link_chars) + share * c + math.e)
            n.density = c / t * max(0.0, math.log(c * t / (lc * lt)) / math.log(base + 1e-9)) if base > 1.0000001 else c / t * math.log(c * t / (lc * lt) + 1)
        # children for the sum: blocks, also those inside inline elements (which only count as tags)
        n.inner = []
        for k in n.kids:
            if isinstance(k, Node) and not k.dropped and k.chars:
                n.inner += [k] if k.tag in BLOCK else k.inner
        n.total = sum(k.density for k in n.inner) if n.inner else n.density
    return body


def drop_forms(root: Node) -> None:
    """Forms with less than half of the page's text go."""
    order = _post_order(root)
    forms = [n for n in order if n.tag == "form"]
    if not forms:
        return
    body = measure(root)
    for n in reversed(forms):  # outer ones first
        if 2 * n.chars < body.chars or not n.chars:
            n.dropped = True


def _is_heading(n: Node) -> bool:
    """A heading, or a header or block that holds nothing else."""
    while True:
        if n.tag in HEADINGS:
            return True
        kids = [k for k in n.kids if not (isinstance(k, Node) and (k.dropped or not k.chars)) and not (isinstance(k, str) and not k.strip())]
        if n.tag not in ("header", "div") or len(kids) != 1 or isinstance(kids[0], str):
            return False
        n = kids[0]


def main_nodes(root: Node) -> list[Node | str]:
    """The largest-sum node and what stands beside its path to the body and belongs to it, in page order."""
    drop_forms(root)
    body = measure(root)
    if not body.chars:
        return []
    inside = [n for n in reversed(_post_order(body)) if n is body or n.tag in BLOCK]
    best = max(inside, key=lambda n: n.total)  # ties: the first in page order, so the outermost
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    for n in _post_order(best):
        if n is not best and ((n.weak and (n.density < threshold or (n.parent is body and n.tag != "p" and not _is_heading(n))))
                              or (best is body and n.tag in BLOCK and n.link_tags >= 3 and 2 * n.link_chars > n.chars)):
            n.dropped = True
    chosen: list[Node | str] = [best]
    for low, up in zip(path, path[1:]):
        kids = [k for k in up.kids if (k.strip() if isinstance(k, str) else not k.dropped and k.chars)]
        at = next(i for i, k in enumerate(kids) if k is low)
        taken = [k is low or (len(_WHITE.sub(" ", k).strip()) >= threshold if isinstance(k, str) else k.density >= threshold and not k.weak)
                 for k in kids]
        for i in range(len(kids) - 2, -1, -1):
            if taken[i + 1] and not taken[i] and isinstance(kids[i], Node) and _is_heading(kids[i]):
                taken[i] = True
        chosen = [k for k, t in zip(kids[:at], taken) if t] + chosen + [k for k, t in zip(kids[at + 1:], taken[at + 1:]) if t]
    return chosen


def blocks(node: Node | str) -> list[str]:
    """Texts of the blocks below a node (or of bare text), in page order; white space inside a block is one blank."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if t := _WHITE.sub(" ", "".join(line)).strip():
            out.append(t)
        line.clear()

    stack: list[tuple[Node | str, bool]] = [(node, False)]
    while stack:
        n, leaving = stack.pop()
        if isinstance(n, str):
            line.append(n)
        elif leaving:
            end()
        elif n.dropped:
            if n.tag in BLOCK:
                end()
        elif n.tag == "br":
            line.append(" ")
        else:
            if n.tag in BLOCK:
                end()
                stack.append((n, True))
            stack += [(k, False) for k in reversed(n.kids)]
    end()
    return out


def main_text(page: str | None) -> str:
    """The article's text, one block per line; '' where there is none."""
    if not page:
        return ""
    return "\n".join(b for n in main_nodes(parse(page)) for b in blocks(n))


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``: the main text of each whole page ('' for NULL, empty or textless pages).

    Other columns stay as they are; a column named ``out`` must not exist yet.
    Repeated rows each give a row.
    """
    if out in pages.columns:
        raise ValueError(f"column {out} exists")

    @F.arrow_udf("string")
    def run(col: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py()) for x in col], pa.string())

    return pages.withColumn(out, run(F.col(html_col)))
