"""Main text of web pages by wrapper induction.

Each page becomes a small tree: siblings with one tag and class fold into one
node, text leaves keep a digest. Trees of one host are aligned by simple tree
matching with a running template; a node whose text is the same on every page
is template, one whose text varies is a slot. Every page takes part: tasks fold
the pages they hold, and the partial templates of a host are matched again. The
wrapper is the path of the lowest node that holds every varying text, text that
only some pages have included; blocks below it are the page's text. Nodes that are boilerplate by tag, class, id or
role are never content, and inside the wrapper all text is content, constant or
not. A page without its host's path falls back to its article, main or body.

Elements more than ``DEPTH`` deep stand beside each other, as in browsers; no
text is lost by it. Child lists of any length get the same exact alignment.

Cases: null or empty html and pages without text give an empty text; repeated
rows each get a row; null url belongs to the host ""; extra columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthledger.llm.common import materialize, ship, table

ship(__name__)

#: Elements that end or hold no text, and words of class, id or role that mark boilerplate.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIP = {"head", "title", "script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "button", "select", "textarea", "iframe", "svg", "menu", "dialog", "object", "canvas"}
BLOCK = {"address", "article", "blockquote", "body", "dd", "details", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "html", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "hr"}
STEPS = BLOCK - {"p", "h1", "h2", "h3", "h4", "h5", "h6"}  # a wrapper is none of these
NOISE = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice\w*|popup|modal|newsletter|subscribe|sidebar|menu|nav\w*|breadcrumb\w*|footer|header|comment\w*|disqus|share|social|related|widget)(?:$|[\s_-])", re.I)
SALTS = 64
#: Elements within each other, and child pairs beyond which the same table is made row by row.
DEPTH = 150
PAIRS = 40_000
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog", "alert"}


class Node:
    __slots__ = ("tag", "key", "skip", "kids")

    def __init__(self, tag, key, skip):
        self.tag, self.key, self.skip, self.kids = tag, key, skip, []


class Dom(HTMLParser):
    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", "#", False)
        self.stack, self.raw = [self.root], ""
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        names = f"{a.get('class', '')} {a.get('id', '')}"
        skip = tag in SKIP or "hidden" in a or a.get("role", "").lower() in ROLES or bool(names.strip() and tag not in ("html", "body", "article", "main") and NOISE.search(names))
        if tag in BLOCK and tag != "body":  # a block ends an open paragraph, and a list item or cell the one before
            ends = {"p"} | ({tag} if tag in ("li", "td", "th", "tr", "dd", "dt") else set())
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in ends:
                    del self.stack[i:]
                    break
                if self.stack[i].tag in BLOCK - {"p"}:
                    break
        if len(self.stack) >= DEPTH and tag not in VOID:  # as browsers do: no deeper, the next one stands beside
            skip = self.stack.pop().skip or skip
        node = Node(tag, f"{tag}.{a.get('class', '').strip()}", skip)
        self.stack[-1].kids.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def text(self, data):
        kids = self.stack[-1].kids
        if kids and isinstance(kids[-1], list):
            kids[-1].append(data)
        else:
            kids.append([data])

    handle_data = text


def blocks(node: Node, out: list | None = None, top: bool = True) -> list[str]:
    out = [[]] if out is None else out
    for kid in node.kids:
        if isinstance(kid, list):
            out[-1].append("".join(kid))
        elif not kid.skip:
            cut = kid.tag in BLOCK
            if kid.tag == "br":
                out[-1].append(" ")
            if cut:
                out.append([])
            blocks(kid, out, False)
            if cut:
                out.append([])
    if top:
        return [t for t in (" ".join("".join(b).split()) for b in out) if t]
    return out


def fold(node: Node) -> list:
    """[key, text digest, kids]: the digest is 0 without own text. A run of like
    siblings is one node without kids, its digest that of all its contents."""
    runs, crc = [], 0
    for kid in node.kids:
        if isinstance(kid, list):
            t = "".join(kid).strip()
            crc = zlib.crc32(t.encode("utf-8", "replace"), crc)
        elif not kid.skip and kid.tag not in VOID:
            f = fold(kid)
            if runs and runs[-1][0][0] == f[0]:
                runs[-1].append(f)
            else:
                runs.append([f])
    kids = [r[0] if len(r) == 1 else [r[0][0], zlib.crc32(json.dumps(r).encode()) if any(map(texted, r)) else 0, []] for r in runs]
    return [node.key, crc, kids]


def texted(t: list) -> bool:
    return t[1] != 0 or any(map(texted, t[2]))


def match(a: list, b: list) -> list[tuple[int, int]]:
    """Simple tree matching of two child lists: the heaviest ordered pairing."""
    if len(a) * len(b) > PAIRS:
        return match_rows(a, b)
    w = [[weight(x, y) for y in b] for x in a]
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + w[i][j])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if m[i][j] == m[i - 1][j]:
            i -= 1
        elif m[i][j] == m[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def match_rows(a: list, b: list) -> list[tuple[int, int]]:
    """The pairing of ``match``, a row of its table at a time: every so many rows
    are kept, and those between made again on the way back."""
    weights = row_weights(a, b)

    def below(row, i):
        out = np.zeros_like(row)
        out[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights(i)))
        return out

    step = math.isqrt(len(a)) + 1
    row, kept = np.zeros(len(b) + 1, dtype=np.int64), []
    for i in range(len(a)):
        if i % step == 0:
            kept.append(row)
        row = below(row, i)
    pairs, i, j = [], len(a), len(b)
    while i and j:
        top = (i - 1) // step * step
        m = [kept[top // step]]
        for k in range(top, i):
            m.append(below(m[-1], k))
        while i > top and j:
            if m[i - top][j] == m[i - top - 1][j]:
                i -= 1
            elif m[i - top][j] == m[i - top][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
    return pairs[::-1]


def row_weights(a: list, b: list):
    """A function of i: the weights of a[i] with each of b. Children of one
    shape weigh alike, so each two shapes are weighed once."""
    shapes_a, shapes_b = [shape(x) for x in a], [shape(y) for y in b]
    kinds = list(dict.fromkeys(shapes_b))
    number = {s: k for k, s in enumerate(kinds)}
    of = np.array([number[s] for s in shapes_b])
    one = dict(zip(shapes_b, b))
    like: dict[str, list[int]] = {}
    for s in kinds:
        like.setdefault(s[0], []).append(number[s])
    known: dict = {}

    def weights(i):
        s = shapes_a[i]
        if s not in known:
            known[s] = {k: weight(a[i], one[kinds[k]]) for k in like.get(s[0], [])}
        by_kind = np.zeros(len(kinds), dtype=np.int64)
        for k, w in known[s].items():
            by_kind[k] = w
        return by_kind[of]

    return weights


def shape(t: list) -> tuple:
    """Keys of a tree without its texts."""
    return (t[0], tuple(map(shape, t[2])))


def weight(a: list, b: list) -> int:
    if a[0] != b[0]:
        return 0
    return 1 + sum(weight(a[2][i], b[2][j]) for i, j in match(a[2], b[2])) if a[2] and b[2] else 1


def merge(a: list, b: list) -> list:
    """Template of both: a digest stays where the texts agree, else it is None.
    Text that only one of them has makes its parent a slot; the wrapper never
    goes below a slot, so a slot keeps no kids."""
    pairs = match(a[2], b[2])
    alone = [k for side, t in enumerate((a, b)) for i, k in enumerate(t[2]) if i not in {p[side] for p in pairs}]
    if a[1] is None or a[1] != b[1] or any(map(texted, alone)):
        return [a[0], None, []]
    return [a[0], a[1], [merge(a[2][i], b[2][j]) for i, j in pairs]]


def varying(t: list) -> bool:
    return t[1] is None or any(map(varying, t[2]))


def wrapper(t: list) -> list[str] | None:
    """Path to the lowest container of all varying text, None without any; an
    article or main is gone into no further."""
    if not varying(t):
        return None
    path = []
    while t[1] is not None and t[0].split(".")[0] not in ("article", "main"):
        slots = [k for k in t[2] if varying(k)]
        if len(slots) > 1 or slots[0][0].split(".")[0] not in STEPS:
            break
        t = slots[0]
        path.append(t[0])
    return path


def content(root: Node, path: list[str] | None) -> list[Node]:
    level = [root]
    for key in path or []:
        level = [k for n in level for k in n.kids if isinstance(k, Node) and not k.skip and k.key == key]
    if path is not None and level:
        return level
    for tag in ("article", "main", "body"):
        found, todo = [], [root]
        while todo:
            n = todo.pop()
            if n.tag == tag and not n.skip:
                found.append(n)
            else:
                todo += [k for k in reversed(n.kids) if isinstance(k, Node) and not k.skip]
        if found:
            return found
    return [root]


def _induce(batches):
    held = {}
    for b in batches:
        for host, page in zip(b["host"], b["html"]):
            t = fold(Dom(page).root)
            held[host] = merge(held[host], t) if host in held else t
            if len(held) >= 1000:
                yield pd.DataFrame({"host": list(held), "tree": [json.dumps(x) for x in held.values()]})
                held = {}
    if held:
        yield pd.DataFrame({"host": list(held), "tree": [json.dumps(x) for x in held.values()]})


def _join(batches):
    """One tree of every host of the partition, which is sorted by host."""
    host, tree = None, None
    for b in batches:
        for name, x in zip(b["host"], b["tree"]):
            if tree is not None and name != host:
                yield pd.DataFrame({"host": [host], "tree": [json.dumps(tree)]})
                tree = None
            host, tree = name, merge(tree, json.loads(x)) if tree is not None else json.loads(x)
    if tree is not None:
        yield pd.DataFrame({"host": [host], "tree": [json.dumps(tree)]})


def _meet(g):
    trees = [json.loads(x) for x in sorted(g["tree"])]
    t = trees[0]
    for x in trees[1:]:
        t = merge(t, x)
    return pd.DataFrame({"host": [g["host"].iloc[0]], "path": [json.dumps(wrapper(t))]})


def _extract(batches):
    for b in batches:
        out = []
        for page, path in zip(b["html"], b["path"]):
            found = content(Dom(page).root, json.loads(path) if path else None)
            out.append("\n\n".join(x for n in found for x in blocks(n)))
        yield b[["page_id", "url"]].assign(text=out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text."""
    host = F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    p = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    trees = p.select("host", "html").mapInPandas(_induce, "host string, tree string")
    # equal trees are one; those of a host meet in SALTS tasks first, then in one
    trees = trees.distinct().withColumn("salt", F.pmod(F.xxhash64("tree"), F.lit(SALTS)))
    trees = trees.repartition("host", "salt").sortWithinPartitions("host", "tree").select("host", "tree").mapInPandas(_join, "host string, tree string")
    paths = materialize(trees.distinct().groupBy("host").applyInPandas(_meet, "host string, path string"), "wrappers")
    both = p.join(paths, "host", "left").select("page_id", "url", "html", "path")
    return both.mapInPandas(_extract, "page_id long, url string, text string")


def op5(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
