"""HTML extraction by consensus host paths.

1. Each page's containers are scored by the text of the blocks in them that
   isn't link or furniture text; the page votes for its best container's path,
   generalised to tags and classes without digits.
2. Spark sums the votes by host and path (combined before the shuffle); a
   host's path with the most votes wins.
3. Each page is extracted again from the containers on its host's path, or
   from its own best container if the path isn't in it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import Scratch, bounded_batches

#: Most hosts whose paths are broadcast (about 100 bytes each); beyond it the pages are shuffled by host.
BROADCAST_HOSTS = 100_000

#: Fixed values of HTML: elements without an end tag, whose content is no markup, that
#: begin a block, and whose start ends an open paragraph or list item.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
INLINE_CONTAINERS = frozenset("b i u em strong a span font small big s strike tt code".split())

#: Elements and class words of what isn't main text.
FURNITURE = frozenset("nav header footer aside form script style noscript template button select option textarea iframe svg head title menu dialog object audio video canvas".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice alert popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget related recommended share sharing social "
    "comment comments disqus respond reply replies newsletter subscribe subscription signup login search pagination pager toolbar skip".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CONTAINERS = frozenset("article main section div td body".split())

#: Words that may follow a furniture word in the name of furniture (``sidebar-left``), unlike those of
#: article parts named by what they are about (``share-price``).
STRUCTURE_WORDS = frozenset(
    "left right top bottom main inner outer wrap wrapper container content box block area section list item items link links bar "
    "panel group row col column columns body text title head unit slot button buttons icon icons form inline mobile desktop sticky "
    "primary secondary global site page widget widgets".split()
)

#: A quote opens a value behind an equals sign only.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("end", "furniture", "link", "mark", "parent", "path", "start", "tag", "text")

    def __init__(self, tag, path, parent, furniture, start):
        self.tag, self.path, self.parent, self.furniture, self.start = tag, path, parent, furniture, start
        self.end, self.text, self.link, self.mark = None, 0, 0, False


def names_furniture(value: str) -> bool:
    """Whether one of the names in a class or id attribute is that of furniture: its last word is a
    furniture word, or its first one is and only words of structure follow."""
    for name in value.split():
        words = WORD.findall(name)
        if words and (words[-1] in FURNITURE_WORDS or words[0] in FURNITURE_WORDS and STRUCTURE_WORDS.union(FURNITURE_WORDS).issuperset(words[1:])):
            return True
    return False


def _opened(tag: str, attributes: str, parent: Node | None, start: int) -> Node:
    classes, furniture = [], tag in FURNITURE
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = next(filter(None, values), "").lower()
            name = name.lower()
            if name == "role":
                furniture |= value in FURNITURE_ROLES
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                furniture = True
            else:
                if name == "class":
                    classes = sorted({c for c in re.sub(r"\d+", "", value).split() if c})
                furniture |= names_furniture(value)
    path = (parent.path if parent else "") + "/" + ".".join([tag, *classes])
    if tag in ("body", "html", "main", "article"):  # the page's or the article's own element is never furniture
        furniture = False
    return Node(tag, path, parent, furniture or bool(parent and parent.furniture), start)


def parse(text: str) -> tuple[list[tuple[int, str, bool]], list[Node]]:
    """Blocks (their node's index, text, inside furniture) in page order, and all nodes.

    Tags that aren't closed end with their parent; paragraphs and list items
    also at the next block of their kind. A page cut off anywhere ends all.
    """
    root = _opened("html", "", None, 0)
    nodes, stack, blocks, buffer = [root], [root], [], []

    def flush():
        if buffer:
            plain = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if plain:
                top = stack[-1]
                blocks.append((top, plain, top.furniture))
                link = any(n.tag == "a" for n in stack)
                n = top
                while n is not None:
                    n.text += len(plain)
                    n.link += len(plain) * link
                    n = n.parent

    def close(upto: int):
        while len(stack) > upto:
            stack.pop().end = len(blocks)

    at, size = 0, len(text)
    while at < size:
        m = TOKEN.search(text, at)
        if not m:
            buffer.append(text[at:])
            break
        if m.start() > at:
            buffer.append(text[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag
            if tag in BLOCKS:
                flush()
            elif tag == "br":
                buffer.append(" ")
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth and not (tag in INLINE_CONTAINERS and any(n.tag in BLOCKS for n in stack[depth + 1 :])):
                if stack[depth].furniture and not (stack[depth].parent and stack[depth].parent.furniture):
                    flush()
                close(depth)
            continue
        if tag == "html" or tag == "body" and any(n.tag == "body" for n in stack):
            continue
        if tag in BLOCKS:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends at any block, an item at the next one
                if stack[k].tag == "p" or stack[k].tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    close(k)
                    break
                if stack[k].tag in BLOCKS:
                    break
        elif tag == "br":
            buffer.append(" ")
        if tag in VOID:
            continue
        node = _opened(tag, m[3] or "", stack[-1], len(blocks))
        if node.furniture and not stack[-1].furniture:
            flush()
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]", re.I).search(text, at)
            at = size if not stop else text.find(">", stop.end() - 1) + 1 or size
            continue
        nodes.append(node)
        stack.append(node)
    flush()
    close(0)
    return blocks, nodes


def best_container(blocks, nodes) -> Node | None:
    """The container with the most running text of its own kind; the innermost on near ties."""
    weight: dict[int, float] = {}
    for node, plain, furniture in blocks:
        if furniture:
            continue
        n, link = node, False
        while n is not None and n.tag not in CONTAINERS:
            link |= n.tag == "a"
            n = n.parent
        worth = 0.0 if link else float(len(plain))
        share = 1.0
        while n is not None:  # what surrounds a container counts a little less at each level
            if n.tag in CONTAINERS:
                weight[id(n)] = weight.get(id(n), 0.0) + worth * share
                share *= 0.9 if n.tag in ("article", "main") else 0.95
            n = n.parent
    scored = [(weight[id(n)] * (1.5 if n.tag in ("article", "main") else 1.0), -k, n) for k, n in enumerate(nodes) if weight.get(id(n))]
    return max(scored, key=lambda x: x[:2])[2] if scored else None


def extract(text: str, path: str | None) -> str:
    """Main text of a page from the containers on ``path``, or from its best container."""
    blocks, nodes = parse(text)
    chosen = [n for n in nodes if path and n.path == path and not n.furniture]
    if not any(not f and any(c is a for a in chain(node) for c in chosen) for node, _, f in blocks):
        best = best_container(blocks, nodes)
        chosen = [best] if best else []
    keep = {id(n) for n in chosen}
    return "\n\n".join(plain for node, plain, f in blocks if not f and any(id(a) in keep for a in chain(node)))


def chain(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        votes: dict[tuple[str, str], int] = {}
        for host, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            best = best_container(*parse(page.as_py() or ""))
            if best is not None:
                votes[host, best.path] = votes.get((host, best.path), 0) + 1
        if votes:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()), pa.array(list(votes.values()), pa.int64())],
                ["host", "path", "votes"],
            )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(page.as_py() or "", path) for page, path in zip(b.column(2), b.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def host_of(url: str):
    """Host of a url column: behind ://, up to / ? # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (blocks joined by an empty line), n_chars.

    A null or empty html, or one without main text, gives the empty text. A
    null url's pages vote together as the host without a name. Ties between
    paths go to the longer path, then the alphabetically last. Repeated rows
    stay; an empty table gives an empty result; other columns are not read.
    """
    spark = pages.sparkSession
    rows = bounded_batches(pages).select("page_id", "url", "html", host_of("url").alias("host"))
    votes = rows.select("host", "html").mapInArrow(_votes, "host string, path string, votes long")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    winners = summed.groupBy("host").agg(F.max(F.struct("votes", F.length("path").alias("n"), "path"))["path"].alias("path"))
    winners = Scratch(spark, "html").write(winners)
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
