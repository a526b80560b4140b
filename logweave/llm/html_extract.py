"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements; every run of text between block boundaries
is a leaf.  Each node is content or not.  Element nodes have potentials for their kind of
tag and for hints in class, id and role; leaves for the tag that holds them, their length,
link share and sentence ends; parent-child potentials couple the states along every edge.
Sum-product messages go up from the leaves and down from the root, and a leaf is kept
when its marginal says content.

Potentials are trained from labelled pages: those with exactly one ``article`` or ``main``
element say which nodes are content.  A bounded sample of pages (``TRAIN_PAGES``) is
counted; the tags of ``DECLARED`` kinds (navigation, footers, asides, forms) get a fixed
strong potential besides, so that they hold on pages unlike the sample.

Names in class, id and role are bounded potentials, counted on the same pages over a prior.
A name whose head is a negative word ("sidebar", "post-comments", "ad-slot") marks its
element; names of state ("with-sidebar", "comments-open", "post-share-target") are a weak
hint only.  Every leaf also has the potential of its nearest mark, so a negative mark holds
for any length of text, while a positive name or a main element below it lifts it.  A main
element below a negative mark counts only when the page has no other.

Blocks: white space inside becomes one space, blocks are joined by an empty line.

Defined cases: null or empty html gives an empty text; unclosed or misnested tags are
closed where HTML would; a page without markup is one block; pages without labelled
examples use the fixed potentials alone; repeated rows get equal results; extra columns
are ignored.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 2000
#: Log odds of a declared kind, far beyond what the texts below it can add up to.
STRONG = -400.0
_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
#: Elements whose content is not text of the page.
RAW = frozenset("script style title textarea noscript template iframe svg math object select datalist canvas audio video xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GROUPS = {
    "article": "main", "main": "main", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer",
    "aside": "aside", "form": "form", "fieldset": "form", "button": "form", "dialog": "aside", "head": "head",
    "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading",
    "p": "p", "blockquote": "p", "pre": "p", "ul": "list", "ol": "list", "dl": "list", "li": "item", "dd": "item",
    "dt": "item", "table": "table", "tbody": "table", "thead": "table", "tfoot": "table", "tr": "table", "td": "cell",
    "th": "cell", "caption": "cell", "html": "root", "body": "root",
} | dict.fromkeys("div section center address figure figcaption hgroup details summary legend".split(), "box")
DECLARED = frozenset(("nav", "header", "footer", "aside", "form", "head"))
NEGATIVE = frozenset("""ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies
    consent notice gdpr popup modal overlay sidebar aside widget related recommended recommendations share sharing social
    comment comments disqus reply replies nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead
    newsletter subscribe subscription signup login search toolbar complementary contentinfo dialog alert""".split())
POSITIVE = frozenset("article content main post entry story text body".split())
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}


#: Words that make a name tell a state or purpose, not what the element is.
STATE = frozenset("with without has no open opened closed enabled disabled on off target active visible".split())


def _name_hint(name: str) -> str:
    """Hint of one name: '-' when it is negative, '~' when it only mentions a negative word, '+', or ''."""
    words = [w.lower() for w in _WORD.findall(name)]
    negative, positive = NEGATIVE.intersection(words), POSITIVE.intersection(words)
    if negative:
        plain = STATE.isdisjoint(words) and (not positive or words[-1] in NEGATIVE)
        return "-" if plain else "~"
    return "+" if positive else ""


def _hint(attrs: str) -> str:
    """'-', '~', '+' or '' for the names in class, id and role; hidden elements are '-'."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return ""
    found = set()
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() != "false":
            return "-"
        if name == "role" and value.lower() in ("banner", "search", "form"):
            found.add("-")
        elif name in ("class", "id", "role"):
            found.update(map(_name_hint, value.split()))
    if {"-", "+"} <= found:
        return "~"
    return next((h for h in "-+~" if h in found), "")


class Tree:
    """Nodes in document order: parent index, feature names, text (leaves), tag."""

    def __init__(self):
        self.parent, self.features, self.text, self.tag = [-1], [("tag:root",)], [None], ["html"]


def parse(source: str) -> Tree:
    t = Tree()
    stack = [0]
    run: list[str] = []
    linked = links = 0
    odd: set[str] = set()  # inline names that became nodes for their hints

    def add(parent, features, text, tag):
        t.parent.append(parent)
        t.features.append(features)
        t.text.append(text)
        t.tag.append(tag)
        return len(t.tag) - 1

    def flush():
        nonlocal linked
        if run:
            text = " ".join(_html.unescape("".join(run)).split())
            run.clear()
            if text:
                n = len(text)
                size = min(n.bit_length(), 12)
                share = min(int(4 * linked / n), 3) if linked else 0
                ends = min(sum(text.count(c) for c in ".!?"), 3)
                add(stack[-1], (f"in:{GROUPS.get(t.tag[stack[-1]], 'box')}", f"size:{size}", f"links:{share}", f"ends:{ends}"), text, "#text")
        linked = 0

    def text(s):
        nonlocal linked
        if s:
            run.append(s)
            if links:
                linked += len(s)

    def close_to(i):
        flush()
        del stack[i:]

    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at:m.start()])
        at = m.end()
        slash, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if slash:
            if name == "a":
                links = max(0, links - 1)
            elif name in GROUPS or name in odd:
                for i in range(len(stack) - 1, 0, -1):
                    if t.tag[stack[i]] == name:
                        close_to(i)
                        break
                else:
                    if name in GROUPS:
                        flush()
            continue
        if name in ("svg", "math") and attrs.endswith("/"):  # self-closed, unlike elements of HTML itself
            text(" ")
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
            text(" ")
            continue
        if name in VOID:
            text(" ")
            if name == "hr":
                flush()
            continue
        hint = _hint(attrs)
        if name == "a":
            links += 1
        if name in ("html", "body"):
            if name == "body":
                close_to(1)
            continue
        if name not in GROUPS and hint != "-":
            continue  # inline
        if attrs.endswith("/") and name not in GROUPS:
            continue
        flush()
        if name in GROUPS:
            if t.tag[stack[-1]] == "p" and len(stack) > 1:
                close_to(len(stack) - 1)
            if t.tag[stack[-1]] == "head" and len(stack) > 1:
                close_to(len(stack) - 1)
            same, stop = _CLOSES.get(name, ((), ()))
            for i in range(len(stack) - 1, 0, -1):
                if t.tag[stack[i]] in stop:
                    break
                if t.tag[stack[i]] in same:
                    close_to(i)
                    break
        else:
            odd.add(name)
        group = GROUPS.get(name, "inline")
        stack.append(add(stack[-1], (f"tag:{group}",) + ((f"hint{hint}",) if hint else ()), None, name))
    flush()
    for leaf, mark in enumerate(marks(t)):
        if mark == "-" and t.tag[leaf] == "#text":
            t.features[leaf] += ("near:-",)
    return t


def marks(t: Tree) -> list[str]:
    """Mark of every node, '-', '+' or '': its own or that of its nearest marked ancestor."""
    def spread(reset: bool) -> list[str]:
        out = [""] * len(t.tag)
        for i in range(1, len(t.tag)):
            above, main = out[t.parent[i]], "tag:main" in t.features[i]
            if main and (reset or above != "-" and "hint-" not in t.features[i]):
                out[i] = "+"
            else:
                out[i] = "-" if "hint-" in t.features[i] else "+" if "hint+" in t.features[i] and not main else above
        return out

    out = spread(False)
    mains = [i for i, f in enumerate(t.features) if "tag:main" in f]
    return spread(True) if mains and all(out[i] == "-" for i in mains) else out


def labels(t: Tree) -> list[int] | None:
    """State of every node of a labelled page: inside its only main element, below nothing declared or marked '-'."""
    inside, top = [False] * len(t.tag), []
    for i, tag in enumerate(t.tag):
        main = tag in ("article", "main")
        if main and not (i and inside[t.parent[i]]):
            top.append(i)
        inside[i] = main or i > 0 and inside[t.parent[i]]
    if len(top) != 1:
        return None
    state, mark = [0] * len(t.tag), marks(t)
    for i in range(1, len(t.tag)):
        out = mark[i] == "-" or any(f.removeprefix("tag:") in DECLARED for f in t.features[i])
        state[i] = int((i == top[0] or state[t.parent[i]] == 1) and not out)
    return state


def _edges(t: Tree) -> list[str]:
    """Kind of the edge above every node: 'under' for what is declared or lies below it, 'in' for leaves, else 'tag'."""
    declared, out = [False] * len(t.tag), [""] * len(t.tag)
    for i in range(1, len(t.tag)):
        above = declared[t.parent[i]]
        declared[i] = above or any(f.removeprefix("tag:") in DECLARED for f in t.features[i])
        out[i] = "under" if declared[i] else "in" if t.tag[i] == "#text" else "tag"
    return out


#: Fixed pseudo-counts (not content, content) that hold without any labelled page.
PRIOR = {"tag:box": (30, 20), "tag:list": (30, 10), "tag:item": (40, 15), "tag:table": (20, 10), "tag:cell": (30, 10), "tag:main": (0.05, 60), "hint+": (0.5, 60), "hint~": (20, 14), "hint-": (60, 0.1), "near:-": (1000, 1e-7), "tag:p": (4, 25), "tag:heading": (4, 16), "in:p": (5, 40), "in:heading": (4, 20),
         "in:box": (10, 12), "in:item": (12, 10), "links:0": (10, 20), "links:3": (40, 1), "links:2": (20, 3), "ends:0": (20, 15),
         "ends:1": (8, 20), "ends:2": (4, 15), "ends:3": (2, 20)}
#: Least and greatest log odds of a feature, -3 and 3 of the others, so that no single weak one outvotes a page.  That of
#: a leaf's negative mark exceeds what the leaf's four other features and the element around it can add up to.
BOUNDS = {"tag:main": (-3.0, 8.0), "hint+": (-3.0, 8.0), "hint-": (-8.0, 3.0), "near:-": (-20.0, 3.0)}
EDGE_PRIOR = {("tag", 0): (80, 20), ("tag", 1): (1, 99), ("in", 0): (999, 1), ("in", 1): (1, 199)}


class Potentials:
    def __init__(self, counts: dict[str, list[float]] | None = None):
        """``counts`` of 'feature' -> [not content, content] and '>edge|parent state' -> [0, 1] of the child."""
        counts = counts or {}
        tot = {"tag": [1.0, 1.0], "in": [1.0, 1.0]}
        merged = {}
        for f in set(PRIOR) | {k for k in counts if not k.startswith(">")}:
            a, b = PRIOR.get(f, (1, 1))
            x, y = counts.get(f, (0, 0))
            merged[f] = (a + x, b + y)
            kind = "tag" if f.startswith(("tag:", "hint")) else "in"
            if f.startswith(("tag:", "in:")):
                tot[kind][0] += a + x
                tot[kind][1] += b + y
        self.unary = {}
        for f, (a, b) in merged.items():
            t = tot["tag" if f.startswith(("tag:", "hint")) else "in"]
            low, top = BOUNDS.get(f, (-3.0, 3.0))
            self.unary[f] = max(low, min(top, math.log((b / t[1]) / (a / t[0]))))
        for f in DECLARED:
            self.unary[f"tag:{f}"] = STRONG
        self.edge = {("under", s): (0.0, STRONG) for s in (0, 1)}
        for (e, s), (a, b) in EDGE_PRIOR.items():
            x, y = counts.get(f">{e}|{s}", (0, 0))
            a, b = a + x, b + y
            self.edge[e, s] = (math.log(a / (a + b)), math.log(b / (a + b)))


def _lse(a: float, b: float) -> float:
    m = a if a > b else b
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def marginals(t: Tree, pot: Potentials) -> list[float]:
    """Probability of content of every node: one pass of messages up the tree and one down."""
    n = len(t.tag)
    own = [sum(pot.unary.get(f, 0.0) for f in fs) for fs in t.features]
    up0, up1 = [0.0] * n, own[:]  # evidence at and below a node, by its state
    msg, edges = [(0.0, 0.0)] * n, _edges(t)
    for i in range(n - 1, 0, -1):
        e = edges[i]
        to = tuple(_lse(pot.edge[e, s][0] + up0[i], pot.edge[e, s][1] + up1[i]) for s in (0, 1))
        msg[i] = to
        up0[t.parent[i]] += to[0]
        up1[t.parent[i]] += to[1]
    b0, b1, out = [0.0] * n, [0.0] * n, [0.0] * n
    b0[0], b1[0] = up0[0] + math.log(0.99), up1[0] + math.log(0.01)
    for i in range(n):
        if i:
            p = t.parent[i]
            r0, r1 = b0[p] - msg[i][0], b1[p] - msg[i][1]  # the parent without this child
            e0, e1 = pot.edge[edges[i], 0], pot.edge[edges[i], 1]
            b0[i] = up0[i] + _lse(r0 + e0[0], r1 + e1[0])
            b1[i] = up1[i] + _lse(r0 + e0[1], r1 + e1[1])
        m = max(b0[i], b1[i])
        b0[i] -= m
        b1[i] -= m
        out[i] = math.exp(b1[i]) / (math.exp(b0[i]) + math.exp(b1[i]))
    return out


def main_text(source: str | None, pot: Potentials) -> str:
    if not source:
        return ""
    t = parse(source)
    p = marginals(t, pot)
    return "\n\n".join(s for s, q in zip(t.text, p) if s and q > 0.5)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c: Counter = Counter()
    for batch in batches:
        for source in batch.column(0):
            t = parse(source.as_py() or "")
            state = labels(t)
            if state is None:
                continue
            edges = _edges(t)
            for i in range(1, len(state)):
                if edges[i] != "under":  # settled by the fixed potentials
                    c.update((f, state[i]) for f in t.features[i])
                    c[f">{edges[i]}|{state[t.parent[i]]}", state[i]] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in c], pa.string()), pa.array([s for _, s in c], pa.int32()), pa.array(list(c.values()), pa.int64())],
        names=["name", "state", "n"])


def train(pages: DataFrame, html: str = "html", key: str = "page_id", sample: int = TRAIN_PAGES) -> Potentials:
    """Potentials counted on about ``sample`` pages, chosen by a hash of the key."""
    rows = max(pages.count(), 1)
    u = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.col(html))), F.lit(1_000_000)) / 1_000_000.0
    some = pages.where(u * rows < sample).select(html)
    counts: dict[str, list[float]] = {}
    # One row per feature and state: a few dozen whatever the input.
    for name, state, n in some.mapInArrow(_count, "name string, state int, n long").groupBy("name", "state").agg(F.sum("n")).collect():
        counts.setdefault(name, [0, 0])[state] += n
    return Potentials(counts)


def extract(pages: DataFrame, pot: Potentials, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):  # bounded output batches
                part = batch.slice(a, 256)
                out = [main_text(s.as_py(), pot) for s in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(s) for s in out], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = p.schema["page_id"].dataType.simpleString()
    return p.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
