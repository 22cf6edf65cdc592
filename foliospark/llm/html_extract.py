"""Main text of web pages by consensus of each host.

Every page scores its containers and votes for their paths, generalised to tags and class
names. Spark adds the votes of a host; the path that wins is then read on all its pages, and a
page that lacks it falls back to its own best container.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import cut_lineage, ship_code
from foliospark.llm.url_filter import url_parts
from foliospark.operators.skew import lookup_join

CONTAINERS = frozenset("article main section div td body blockquote".split())
#: Weight of a container's text by its tag; a plain wrapper counts 1.
PREFERENCE = {"article": 1.6, "main": 1.4, "body": 0.5, "td": 0.9, "blockquote": 0.3}
#: Elements whose content is never part of an article.
DROPPED = frozenset(
    "nav aside footer form script style noscript template iframe object svg canvas button select"
    " option textarea input label dialog menu head title audio video map".split()
)
#: Parts of class, id and role names that mark what stands around an article.
AROUND = frozenset(
    "nav navbar navigation sidenav subnav menu sidebar aside footer topbar ad ads advert adverts"
    " advertisement advertising adbox adslot adsense sponsor sponsored promo promotion banner alert"
    " cookie cookies cookiebar consent gdpr notice notices popup modal dialog share sharing social"
    " related recommended comment comments commentlist commentform respond reply replies discussion"
    " disqus newsletter subscribe signup login breadcrumb breadcrumbs pagination pager widget"
    " masthead skip toolbar search complementary contentinfo".split()
)
#: Those of them that may be about the content as well, and words that say nothing about it.
AMBIGUOUS = frozenset(
    "share sharing social alert notice notices promotion related recommended search discussion"
    " respond reply replies skip banner dialog consent menu login subscribe signup toolbar".split()
)
STRUCTURE = frozenset(
    "bar bars block blocks box boxes btn button buttons col container content group area inner item items"
    " left link links list lists main module outer page panel post posts right row section site small"
    " top bottom wrap wrapper wrappers x".split()
)
#: A name with one of these parts tells of its element's surroundings, not of its content.
MODIFIERS = frozenset("has have no not non with without is js hide show enable enabled disable disabled".split())
#: Elements that no name hides.
NEVER_BY_NAME = frozenset("article main html body".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol"
    " p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag closes these open elements, up to the nearest of the second list.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
RAW = frozenset("script style textarea title noscript iframe xmp".split())

_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DIGITS = re.compile(r"\d+")
_NAME = re.compile(r"[a-z]+")


#: A generalised path beyond so many characters is told by a digest of its beginning.
PATH_LENGTH = 200
#: So many hosts' paths go to every task, with their names at most 50 MB.
MOST_HOSTS = 100_000


@dataclass(slots=True)
class Node:
    """A container: its generalised path, and its blocks as a range of the page's."""

    path: str
    tag: str
    page: Page
    first: int  # block
    last: int = 0
    after: int = 0  # the first node that is not inside
    below: int = 0  # characters that names hide inside it

    @property
    def blocks(self) -> list[tuple[str, int]]:
        """(text, characters in links) in page order."""
        return self.page.blocks[self.first : self.last]

    @property
    def size(self) -> int:
        return self.page.sizes[self.last] - self.page.sizes[self.first]

    @property
    def linked(self) -> int:
        return self.page.links[self.last] - self.page.links[self.first]

    @property
    def score(self) -> float:
        return (self.size - self.linked) * PREFERENCE.get(self.tag, 1.0)


@dataclass(slots=True)
class Page:
    """What is read off a page: each block once, with running sums, and the containers."""

    blocks: list[tuple[str, int]] = field(default_factory=list)
    sizes: list[int] = field(default_factory=lambda: [0])
    links: list[int] = field(default_factory=lambda: [0])
    nodes: list[Node] = field(default_factory=list)
    #: Elements that their names hide: characters outside links, by the element's number, and the
    #: nearest article or main around each, by its place among the nodes (or -1).
    named: dict[int, tuple[int, int]] = field(default_factory=dict)
    #: All of those characters, those of nested elements once.
    hidden: int = 0


def _joined(path: str, step: str) -> str:
    whole = f"{path}/{step}"
    return whole if len(whole) <= PATH_LENGTH else "/#" + xxhash.xxh128_hexdigest(whole)


def _hidden(attributes: str) -> bool:
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _marks(token: str) -> bool:
    """Whether one class, id or role names what stands around an article. A word that may as well be
    about the content (`share-price`) does so alone or beside words that say nothing else."""
    parts = _NAME.findall(token)
    if AROUND.isdisjoint(parts) or not MODIFIERS.isdisjoint(parts):
        return False
    sure = any(p in AROUND and p not in AMBIGUOUS for p in parts)
    return sure or all(p in AROUND or p in STRUCTURE for p in parts)


def _marked_around(attributes: str) -> bool:
    """Whether a class, id or role names what stands around an article."""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role") and any(map(_marks, (a or b or c).lower().split())):
            return True
    return False


def _step(tag: str, attributes: str) -> str:
    classes: list[str] = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() == "class":
            classes = sorted(set(_DIGITS.sub("#", (a or b or c).lower()).split()))
    return ".".join([tag, *classes])


def containers(page: str | None) -> list[Node]:
    """The containers of a page that hold text, in page order. Menus, adverts and the like have
    no nodes and add no text; white space is one space, blocks are trimmed and not empty.

    Names alone do not hide an element that holds most of the unlinked text of the article or main
    around it; nor one that holds most of the page's, unless an article or main with such text stands
    elsewhere; and they hide nothing on a page that would be empty otherwise.
    """
    if not page:
        return []
    read = _read(page, lambda element: True)
    if not read.named:
        return [n for n in read.nodes if n.size]
    shown: set[int] = set()
    articles = any(n.tag in ("article", "main") and n.size > n.linked for n in read.nodes)
    whole = read.nodes[0]
    for element, (size, around) in read.named.items():
        holder = read.nodes[around] if around >= 0 else None if articles else whole
        if holder and 2 * size > holder.size - holder.linked + holder.below:
            shown.add(element)
    if shown:
        read = _read(page, lambda element: element not in shown)
    nodes = [n for n in read.nodes if n.size]
    return nodes or [n for n in _read(page, lambda element: False).nodes if n.size]


def _read(text: str, by_name: Callable[[int], bool]) -> Page:
    """The page, in time and space that grow with its length, however it is nested. `by_name`: whether
    the name of the element of that number may hide it."""
    page = Page()
    root = Node("", "body", page, 0)
    page.nodes.append(root)
    stack: list[tuple[str, bool, int]] = []  # open elements: tag, whether it hides, number if its name does
    places: dict[str, list[int]] = {}  # of the open elements of each tag, in `stack`
    open_blocks: list[int] = []  # places of open block elements
    inside: list[int] = [0]  # open containers
    articles: list[int] = []  # those of them that are an article or main
    begun: list[tuple[int, int]] = []  # of open elements that names hide: characters hidden before
    dropped = 0  # open elements that hide their content
    named = 0  # those of them that do so by name, while no other does
    element = 0
    links = 0
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            block = " ".join("".join(buffer).split())
            if block:
                page.blocks.append((block, min(linked, len(block))))
                page.sizes.append(page.sizes[-1] + len(block))
                page.links.append(page.links[-1] + min(linked, len(block)))
            buffer.clear()
        linked = 0

    def end_node(at: int) -> None:
        node = page.nodes[at]
        node.last, node.after = len(page.blocks), len(page.nodes)
        node.below = page.hidden - node.below
        if articles and articles[-1] == at:
            articles.pop()

    def close(to: int) -> None:
        """Close the innermost open elements, down to the one at this place of the stack."""
        nonlocal dropped, links, named
        while len(stack) > to:
            tag, hides, number = stack.pop()
            places[tag].pop()
            if tag in BLOCKS:
                open_blocks.pop()
                flush()
            if number:
                before, around = begun.pop()
                page.named[number] = (page.hidden - before, around)
                named -= 1
            if hides:
                dropped -= 1
            elif not dropped and tag in CONTAINERS:
                end_node(inside.pop())
            if tag == "a":
                links -= 1

    def write(some: str) -> None:
        nonlocal linked
        if some and not dropped:
            some = html.unescape(some) if "&" in some else some
            buffer.append(some)
            if links:
                linked += len(some)
        elif some and not links and dropped == named:
            page.hidden += len(" ".join(some.split()))

    def nearest(tags: tuple[str, ...]) -> int:
        """Place of the innermost open element of these tags, -1 if there is none."""
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    at, end = 0, len(text)
    while at < end:
        start = text.find("<", at)
        if start < 0:
            write(text[at:])
            break
        m = _TOKEN.match(text, start)
        if m is None:  # a bare sign
            write(text[at : start + 1])
            at = start + 1
            continue
        write(text[at:start])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if closing:
            if places.get(tag):
                close(places[tag][-1])
            elif tag in ("p", "br"):
                flush()
            continue
        if tag in ("html", "head", "body") and tag != "head":
            continue
        if tag in BLOCKS:
            flush()
            # a block ends an open paragraph, if no other block stands between
            if tag != "br" and open_blocks and stack[open_blocks[-1]][0] == "p":
                close(open_blocks[-1])
            if tag in CLOSES:
                ended, bounds = CLOSES[tag]
                bound = nearest(bounds)
                first = [place for t in ended if (place := _first_above(places.get(t, ()), bound)) is not None]
                if first:
                    close(min(first))
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}[\\s/>]", re.IGNORECASE).search(text, at)
            at = stop.start() if stop else end
            if stop:
                after = text.find(">", at)
                at = after + 1 if after >= 0 else end
            continue
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        heading = tag == "header" and not places.get("article") and not places.get("main")
        hides = tag in DROPPED or heading or _hidden(attributes)
        element += 1
        number = 0
        if not hides and tag not in NEVER_BY_NAME and _marked_around(attributes) and by_name(element):
            hides = True
            if dropped == named:
                number = element
                named += 1
                begun.append((page.hidden, articles[-1] if articles else -1))
        if not hides and not dropped and tag in CONTAINERS:
            path = _joined(page.nodes[inside[-1]].path, _step(tag, attributes))
            if tag in ("article", "main"):
                articles.append(len(page.nodes))
            inside.append(len(page.nodes))
            page.nodes.append(Node(path, tag, page, len(page.blocks), below=page.hidden))
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            open_blocks.append(len(stack))
        stack.append((tag, hides, number))
        dropped += hides
        links += tag == "a"
    close(0)
    flush()
    end_node(0)
    return page


def _first_above(places: list[int], bound: int) -> int | None:
    at = bisect_right(places, bound)
    return places[at] if at < len(places) else None


def best(nodes: list[Node]) -> Node | None:
    """The container with the highest score; of equal ones the innermost, then the first."""
    top = None
    for n in nodes:
        # nodes are in page order: one that begins before the end of another is inside it
        inner = top is not None and n.first < top.last and n.after <= top.after
        if top is None or n.score > top.score or (n.score == top.score and inner):
            top = n
    return top


def text_at(nodes: list[Node], path: str | None) -> str:
    """Blocks of the outermost containers on `path`, or of the page's best one without it."""
    chosen, taken = [], None
    for n in nodes:
        if n.path == path:
            chosen.append(n)
    if not chosen and (taken := best(nodes)):
        chosen = [taken]
    return "\n".join(text for n in chosen for text, _ in n.blocks)


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes): added over the pages of a host. Each page gives its best container 1
    and the others on their way to half its score their share."""
    ship_code(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths, shares = [], [], []
            for host, page in zip(b.column(0), b.column(1)):
                nodes = containers(page.as_py())
                top = best(nodes)
                if top is None or top.score <= 0:
                    continue
                given: dict[str, float] = {}
                for n in nodes:
                    share = n.score / top.score
                    if share >= 0.5:
                        given[n.path] = max(given.get(n.path, 0.0), 1.0 if n is top else share * 0.9)
                for path, share in given.items():
                    hosts.append(host.as_py())
                    paths.append(path)
                    shares.append(round(share, 6))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.float64())],
                ["host", "path", "share"],
            )

    slim = pages.select(url_parts(F.col("url"))["host"].alias("host"), "html")
    each = slim.mapInArrow(run, "host string, path string, share double")
    # whole millionths, so that the order of adding does not matter
    return each.groupBy("host", "path").agg(F.sum(F.round(F.col("share") * 1e6).cast("long")).alias("votes"))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes; of equal ones the first by name."""
    return (
        votes(pages)
        .groupBy("host")
        .agg(F.min(F.struct(-F.col("votes"), F.col("path"))).alias("top"))
        .select("host", F.col("top")["path"].alias("path"))
    )


def extract(pages: DataFrame, most_hosts: int = MOST_HOSTS) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars.

    Null, empty and tag-only pages have an empty text. Rows with a null or malformed url vote
    as the host ''. Repeated rows stay, other columns are not read, an empty table gives no rows.
    Pages stay where they are as long as the paths of all hosts are small enough for every task
    (`MOST_HOSTS`). Beyond that they are shuffled, and the path of a host, whatever share of the
    pages it has, is copied to the sub-keys over which its pages are spread.
    """
    ship_code(pages)
    slim = pages.select("page_id", "url", "html", url_parts(F.col("url"))["host"].alias("host"))
    winning = cut_lineage(winning_paths(pages))
    if winning.count() <= most_hosts:
        routed = slim.join(F.broadcast(winning), "host", "left")
    else:
        routed = lookup_join(slim, winning, ["host"], ["page_id", "url"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [text_at(containers(p.as_py()), w.as_py()) for p, w in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return routed.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "path").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
