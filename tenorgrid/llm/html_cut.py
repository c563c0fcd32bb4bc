"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into blocks, the runs of text between block-level tags. A classifier of fixed weights gives each block
a score from its containers, class and id words, length, link share and punctuation; a positive score is the capacity
from the content terminal, a negative one that to the boilerplate terminal. Neighbours in page order and blocks of
one parent are joined by smoothness edges, weaker the further apart they are in the document tree. A maximum flow
saturates the cheapest cut, and the blocks on the content side are the text, in page order.

Null or empty html gives an empty text, and so does a page without content blocks. Repeated rows are extracted alike.
Extra columns are not read. Whole pages are read, whatever their length. An empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = "script|style|noscript|template|svg|math|textarea|select|iframe|object|title|canvas|audio|video"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*>", re.DOTALL | re.IGNORECASE)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SMALL_PRINT = re.compile(r"©|\(c\)|copyright|all rights reserved|privacy policy|terms of (?:use|service)|cookie", re.IGNORECASE)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                     "nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WEIGHT = {"nav": -8.0, "menu": -7.0, "footer": -7.0, "aside": -7.0, "form": -7.0, "dialog": -7.0, "button": -8.0, "header": -5.0,
          "label": -3.0, "article": 4.0, "main": 3.0}
ROLE = {"navigation": -8.0, "banner": -5.0, "contentinfo": -7.0, "complementary": -7.0, "search": -7.0, "form": -7.0, "alert": -6.0,
        "alertdialog": -7.0, "dialog": -7.0, "menu": -7.0, "main": 3.0, "article": 4.0}
AGAINST = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner
    sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments commentlist
    disqus reply replies respond discussion cookie cookies consent gdpr notice notices alert warning popup modal overlay toast paywall
    newsletter subscribe subscription signup login share sharing social follow related recommended recommendations trending popular
    widget pagination pager tags taglist copyright disclaimer legal search form teaser outbrain taboola hidden""".split())
FOR = frozenset("article articlebody content entry post story main body text prose".split())
BOILER_HEADING = frozenset("""comments|reader comments|leave a reply|leave a comment|responses|replies|related posts|related articles|
    related|recommended|share this|follow us|newsletter|subscribe|about the author|advertisement|more stories|read more""".replace("\n", "").replace("    ", "").split("|"))
NEAR, SAME_PARENT, FAR = 0.5, 1.0, 0.1


class Node:
    __slots__ = ("tag", "parent", "depth", "score", "dropped", "link", "article", "boiler")

    def __init__(self, tag: str, parent: "Node | None", own: float = 0.0, dropped: bool = False):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.score = max(-9.0, min(5.0, (parent.score if parent else 0.0) + own))
        self.dropped = dropped or bool(parent and parent.dropped)
        self.link = tag == "a" or bool(parent and parent.link)
        self.article = tag in ("article", "main") or bool(parent and parent.article)
        self.boiler = 0


def _own(tag: str, attrs: str, parent: Node) -> tuple[float, bool]:
    """An element's own weight, and whether it is not shown."""
    own = WEIGHT.get(tag, 0.0)
    if tag == "header" and parent.article:
        own = 0.0
    if not attrs or attrs.isspace():
        return own, False
    hidden, against, good = False, False, False
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            own += ROLE.get(value.strip().lower(), 0.0)
        elif name == "hidden" or name == "aria-hidden":
            hidden = hidden or name == "hidden" or value.lower() == "true"
        elif name == "style":
            hidden = hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE))
        else:
            found = {w.lower() for w in NAME_WORD.findall(value)}
            against = against or bool(found & AGAINST)
            good = good or bool(found & FOR)
    if tag not in ("html", "body"):
        own += -7.0 if against else 2.0 if good else 0.0
    return own, hidden


def blocks(page: str) -> list[tuple[str, float, Node]]:
    """Blocks in page order: text, score, the element that holds it."""
    here = root = Node("#root", None)
    out: list[tuple[str, float, Node]] = []
    parts: list[tuple[str, bool]] = []
    holder = root

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(p) for p, a in parts if a) / max(1, sum(len(p) for p, _ in parts))
                out.append((text, _score(text, linked, holder), holder))
            parts = []

    def add(text: str) -> None:
        nonlocal holder
        if here.dropped:
            return
        if not parts:
            if text.isspace():
                return
            holder = here
            while holder.tag in INLINE and holder.parent:
                holder = holder.parent
        parts.append((text, here.link))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at: m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            node = here
            while node.parent and node.tag != tag:
                node = node.parent
            if tag not in INLINE:
                flush()
            if node.parent:
                here = node.parent
            continue
        if tag in INLINE:
            if tag in VOID:
                parts and parts.append((" ", here.link))
                continue
        else:
            flush()
            # Elements that the new one ends.
            if tag in CLOSES_P or tag in SAME or tag == "body":
                ends = SAME.get(tag, set()) | ({"p"} if tag in CLOSES_P else set()) | ({"head"} if tag == "body" else set())
                node = here
                while node.parent and (node.tag in INLINE or node.tag in ends or (node.tag not in SCOPES and tag != "p")):
                    if node.tag in ends:
                        here = node.parent
                        break
                    node = node.parent
            if tag in VOID:
                continue
        own, hidden = _own(tag, m["attrs"], here)
        here = Node(tag, here, own, hidden or tag == "head")
    if at < len(page):
        add(page[at:])
    flush()
    return out


def _score(text: str, linked: float, holder: Node) -> float:
    n = text.count(" ") + 1
    score = holder.score + 0.6 * math.log1p(n) - 0.9 - 5.0 * linked
    if text[-1] in ".!?…。！？:;\"”»":
        score += 0.7
    parent = holder.parent or holder
    if holder.tag in HEADINGS:
        score += 1.0
        parent.boiler = text.lower().strip(" :.!0123456789()") in BOILER_HEADING
    if parent.boiler:
        score -= 8.0
    if n < 40 and SMALL_PRINT.search(text):
        score -= 2.0
    return score


def _apart(a: Node, b: Node) -> tuple[int, Node]:
    """Steps between two elements through their nearest common ancestor, and that ancestor."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps, a


def smoothness(found: list[tuple[str, float, Node]]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, (_, _, node) in enumerate(found):
        parent = id(node.parent)
        if i:
            steps, common = _apart(found[i - 1][2], node)
            edges.append((i - 1, i, SAME_PARENT if steps <= 2 else FAR if common.tag in ("body", "html", "#root") else NEAR / (steps - 1)))
        if parent in last and last[parent] != i - 1:
            edges.append((last[parent], i, NEAR))
        last[parent] = i
    return edges


def content_side(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Blocks on the content side of a minimum cut.

    What one block could push to both terminals is settled by its score's sign; flow runs from blocks with capacity left
    from the content terminal, over smoothness edges, to blocks with capacity left to the other one, along shortest paths.
    """
    n = len(score)
    supply, demand = [max(0.0, s) for s in score], [max(0.0, -s) for s in score]
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > 1e-9)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or demand[i] > 1e-9
            for j, w in near[i].items():
                if w > 1e-9 and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        tries = [list(near[i]) for i in range(n)]
        for start in range(n):
            while supply[start] > 1e-9:
                path, i = [start], start
                while path and demand[i] <= 1e-9:
                    while tries[i]:
                        j = tries[i][-1]
                        if near[i][j] > 1e-9 and level[j] == level[i] + 1:
                            break
                        tries[i].pop()
                    if tries[i]:
                        i = tries[i][-1]
                        path.append(i)
                    else:
                        path.pop()
                        if path:
                            tries[path[-1]].pop()
                            i = path[-1]
                if not path:
                    break
                flow = min([supply[start], demand[i], *(near[a][b] for a, b in zip(path, path[1:]))])
                supply[start] -= flow
                demand[i] -= flow
                for a, b in zip(path, path[1:]):
                    near[a][b] -= flow
                    near[b][a] += flow


def main_text(page: str | None) -> str:
    """The blocks on the content side, joined by an empty line."""
    found = blocks(page or "")
    if not found:
        return ""
    side = content_side([s for _, s, _ in found], smoothness(found))
    return "\n\n".join(text for (text, _, _), keep in zip(found, side) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for k in range(0, len(whole), 512):
            batch = whole.slice(k, 512)
            texts = [main_text(p) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars."""
    return pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html")).mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint").withColumnsRenamed({"page_id": id, "url": url})


def op2_html_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
