"""Main text of web pages by consensus paths of a host.

First pass: every page's containers are scored by the text of their paragraphs
(links count against them), and the best one's generalised tag-class path is a vote.
Votes are summed per host in Spark.  Second pass: a page is read again by the
path with most votes in its host that it has; a page that has none of them
gives its own best container.

Defined results: null or empty html gives an empty text; a page without a usable
container gives what its body holds outside menus and the like; tags that are
never closed end where the next block begins or the page ends; a null or odd url
belongs to the host ''; repeated rows each get a row; an empty table gives an empty
result; whole pages are read, whatever their length.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mise.llm.common import text_of, written
from mise.session import ship_library

#: Hosts' winning paths that are broadcast at most; beyond it a salted join.
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 16 << 20
SALT = 64
PATHS_PER_HOST = 8  # paths of a host that are kept with a single vote; all with more votes are

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|"
    r"<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*>", re.S)
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLASS_ONLY = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements whose content is never part of an article.
APART = frozenset("nav footer aside form script style noscript template button select option textarea title iframe svg math "
                  "dialog menu object canvas audio video head label input".split())
#: Whole class names, ids or roles that mark menus, adverts, notices and comments.
MARKED = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                   "notice notices popup modal overlay newsletter subscribe signup sidebar aside widget widgets menu nav "
                   "navbar navigation breadcrumb breadcrumbs pagination pager footer masthead share sharing social related "
                   "recommended comment comments commentlist disqus replies respond toolbar skip login "
                   "complementary contentinfo".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = BLOCK - {"html", "body"}
#: Opening one of these ends an open one of the same list, up to the nearest holder.
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "option": ({"option"}, {"select"})}


@dataclass
class Node:
    """An element; the blocks of text in it are those of the page from ``start`` to ``stop``."""

    tag: str
    path: int  # number of its path in the page
    apart: bool
    article: bool
    parent: Node | None
    start: int = 0
    stop: int = 0
    mark: int = 0  # where the tag ends of the marked element around it, if that is why it is apart
    score: float = 0.0
    holder: Node | None = None  # the nearest element around it, itself included, that isn't inline or a line


@dataclass
class Page:
    """The elements in order, the blocks of text outside menus and the like, and the paths: the
    number of a path by its parent's number and its last label (number 0 is the empty path)."""

    nodes: list[Node] = field(default_factory=list)
    blocks: list[str] = field(default_factory=list)
    paths: dict[tuple[int, str], int] = field(default_factory=dict)

    def text(self, nodes: Sequence[Node]) -> str:
        """The blocks of nodes that lie apart from one another, in page order."""
        return "\n\n".join(b for n in nodes for b in self.blocks[n.start: n.stop])

    def path_of(self, node: Node) -> str:
        """The path in words: one pass over its parents."""
        labels = {number: key for key, number in self.paths.items()}
        words, at = [], node.path
        while at:
            at, label = labels[at]
            words.append(label)
        return ">".join(reversed(words))

    def number_of(self, path: str) -> int | None:
        at: int | None = 0
        for label in path.split(">") if path else ():
            at = self.paths.get((at, label))
            if at is None:
                return None
        return at


def _marked(rest: str) -> bool:
    """Whether a class name, id or role (a number at its end aside) is one of the marked words."""
    return any(re.sub(r"[-_]?\d+$", "", w) in MARKED for m in _CLASS.finditer(rest) for w in (m[1] or m[2] or m[3] or "").lower().split())


def _hidden(rest: str) -> bool:
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _UNSEEN.search(value):
            return True
    return False


def _label(tag: str, rest: str) -> str:
    m = _CLASS_ONLY.search(rest) if rest else None
    if not m:
        return tag
    names = sorted({re.sub(r"\d+", "#", w) for w in (m[1] or m[2] or m[3] or "").lower().replace(">", ".").split()})
    return ".".join([tag, *names])


def parse(page: str) -> Page:
    """The page's elements in order, each with its score and the blocks of text in it (also in
    those below it) that are outside menus and the like.  Time and memory grow with the page and not
    with its depth: blocks and paths are kept once, open elements are found by their names.

    If all of a page's articles lie in elements that are marked or hidden, those that hold them
    are read like others; they are known by where their tags end."""
    plain: set[int] = set()
    while True:
        read, holders = _parse(page, plain)
        if not holders:
            return read
        plain |= holders


def _parse(page: str, plain: set[int]) -> tuple[Page, set[int]]:
    """The page, and the marked elements that hold articles if no article is elsewhere."""
    free, marked_holders = False, set()
    root = Node("", 0, False, False, None)
    root.holder = root
    read = Page([root])
    stack, nodes, blocks, paths = [root], read.nodes, read.blocks, read.paths
    opened: dict[str, list[int]] = defaultdict(list)  # places in the stack by name
    open_blocks: list[int] = []
    text: list[str] = []
    linked = [0, 0]  # characters of the block: all, in links
    in_link = 0

    def flush() -> None:
        nonlocal text
        if not text:
            return
        block = " ".join(html.unescape("".join(text)).split())
        text = []
        total, links = linked
        linked[0] = linked[1] = 0
        here = stack[-1]
        if not block or here.apart:
            return
        blocks.append(block)
        own = here.holder
        worth = max(0.0, len(block) * (1 - 2 * links / max(total, 1)))
        own.score += worth
        if own.parent is not None:
            own.parent.score += worth / 2

    def add(piece: str) -> None:
        if piece and not stack[-1].apart:
            text.append(piece)
            n = len(piece)
            linked[0] += n
            linked[1] += n if in_link else 0

    def pop_to(i: int) -> None:
        nonlocal in_link
        while len(stack) > i:
            gone = stack.pop()
            gone.stop = len(blocks)
            opened[gone.tag].pop()
            if gone.tag in BLOCK:
                open_blocks.pop()
            if gone.tag == "a":
                in_link = max(0, in_link - 1)

    def nearest(names) -> int:
        return max((opened[n][-1] for n in names if opened.get(n)), default=0)

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at: m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name, rest = name.lower(), m["rest"] or ""
        if m["end"] or m["end2"]:
            if name in BLOCK:
                flush()
            i = nearest((name,))
            if i and (name in BLOCK or not open_blocks or open_blocks[-1] < i):
                pop_to(i)
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCK:
            flush()
            if name in _CLOSES_P and open_blocks and stack[open_blocks[-1]].tag == "p":
                pop_to(open_blocks[-1])
        if name in _SIBLINGS:
            ends, holders = _SIBLINGS[name]
            i = nearest(ends)
            if i > nearest(holders):
                pop_to(i)
        if name in VOID:
            continue
        up = stack[-1]
        always = name in APART or (name == "header" and not up.article)
        marked = (not up.apart and not always and bool(rest) and name not in ("html", "body", "article", "main") and at not in plain
                  and (_marked(rest) or _hidden(rest)))
        apart = up.apart or always or marked
        if name in ("article", "main"):
            free = free or not apart
            if up.mark:
                marked_holders.add(up.mark)
        if name in BLOCK or apart != up.apart:
            path = paths.setdefault((up.path, _label(name, rest)), len(paths) + 1)
            node = Node(name, path, apart, up.article or name in ("article", "main"), up)
            if apart and not up.apart and name not in BLOCK:
                add(" ")
        else:
            node = Node(name, up.path, apart, up.article, up)
        nodes.append(node)
        node.start = node.stop = len(blocks)
        node.holder = up.holder if name in _INLINE_OR_LINE else node
        node.mark = at if marked else 0 if always else up.mark
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        opened[name].append(len(stack))
        if name in BLOCK:
            open_blocks.append(len(stack))
        stack.append(node)
        if name == "a":
            in_link += 1
    flush()
    for node in stack:
        node.stop = len(blocks)
    return read, set() if free else marked_holders


_INLINE_OR_LINE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre figcaption address".split()) | frozenset(
    "b i em strong a span u s small big sub sup mark code kbd samp var q cite abbr time font tt ins del dfn bdi bdo data center".split())


def _usable(node: Node) -> bool:
    return node.stop > node.start and not node.apart and node.tag in BLOCK and node.tag not in _INLINE_OR_LINE


def best(nodes: Sequence[Node]) -> Node | None:
    """The container with most paragraph text; the article around it, if any."""
    found = max((n for n in nodes if _usable(n)), key=lambda n: n.score, default=None)
    node = found
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node or found


def vote(page: str) -> tuple[str, float] | None:
    read = parse(page)
    node = best(read.nodes)
    return (read.path_of(node), max(node.score, 1.0)) if node else None


def extract(page: str, paths: Sequence[str] = ()) -> str:
    """The page's text by the first of the paths that it has, else its own best container."""
    read = parse(page)
    by_path: dict[int, list[Node]] = defaultdict(list)
    for n in read.nodes:
        if _usable(n):
            by_path[n.path].append(n)
    for path in paths:  # elements of one path are equally deep, so none lies in another
        number = read.number_of(path)
        if number in by_path:
            return read.text(by_path[number])
    node = best(read.nodes)
    if node is not None:
        return read.text(by_path.get(node.path, [node]))
    return read.text(read.nodes[:1])


def host_of(url) -> F.Column:
    rule = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), rule, 1))


def host_paths(pages: DataFrame, keep: int = PATHS_PER_HOST) -> DataFrame:
    """``host, paths``: each host's paths by votes, most first; all with two or more votes, and single
    ones up to ``keep`` paths."""
    ship_library(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: dict[tuple[str, str], list[float]] = {}
            for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
                cast = vote(page.as_py())
                if cast:
                    one = votes.setdefault((host.as_py(), cast[0]), [0, 0.0])
                    one[0] += 1
                    one[1] += cast[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()),
                 pa.array([v[0] for v in votes.values()], pa.int64()), pa.array([v[1] for v in votes.values()], pa.float64())],
                ["host", "path", "pages", "score"])

    cast = (pages.select(host_of(pages["url"]).alias("host"), text_of(pages, "html").alias("html"))
            .mapInArrow(run, "host string, path string, pages long, score double"))
    votes = cast.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum(F.round("score")).alias("score"))
    order = Window.partitionBy("host").orderBy(F.desc("pages"), F.desc("score"), "path")
    ranked = votes.withColumn("place", F.row_number().over(order)).filter((F.col("place") <= keep) | (F.col("pages") > 1))
    return ranked.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "path"))).alias("best")) \
        .select("host", F.col("best.path").alias("paths"))


def main_text(pages: DataFrame, keep: int = PATHS_PER_HOST) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    paths = written(host_paths(pages, keep), "host-paths")
    source = pages.select(pages["page_id"], pages["url"], text_of(pages, "html").alias("html"),
                          host_of(pages["url"]).alias("host"))
    held = paths.agg(F.coalesce(F.sum(F.size("paths")), F.lit(0)),
                     F.coalesce(F.sum(F.aggregate("paths", F.lit(0).cast("long"), lambda a, p: a + F.length(p))), F.lit(0))).first()
    if held[0] <= BROADCAST_ROWS and held[1] <= BROADCAST_CHARS:  # checked: paths and their characters
        joined = source.join(F.broadcast(paths), "host", "left")
    else:
        spread = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int")
        joined = source.withColumn("salt", salt).join(spread, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), own.as_py() or ()) for page, own in zip(batch.column("html"), batch.column("paths"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    out = joined.select("page_id", "url", "html", "paths").mapInArrow(run, f"{kinds}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
