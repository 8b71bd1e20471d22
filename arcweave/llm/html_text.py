"""HTML extraction: a style tree for each site.

Every page becomes blocks of text, each with the branch of elements it stands
in. The pages of a host are merged into one tree, its nodes keyed by their path
of tags and classes. A node's importance combines the entropy of its presentation
(the child elements it has on different pages) with the entropy of the content
below it (how evenly the same text spreads over pages), as in style trees:

    importance = (1 - g^s) presentation + g^s content

with s styles seen and g = 0.9. Branches below ``LEAST`` are removed from each page.

What the markup says weighs in: elements that are menus, headers, footers,
sidebars, notices, adverts, forms or comments by tag, role, class or id are
unimportant, and on a page with an article or main element so is all outside it.
Names count as whole tokens only; a page whose articles all lie in boxes that
only a name makes clutter has them as its articles.
On pages that do not mark their article the tree alone decides the rest. Inside
an article it needs more: a block is removed if its own text stands in at least
``MANY`` different articles of the host, and either a branch around it (inside the
article) is below ``LEAST`` or the text stands in ``EVERY`` of the host's articles.
Pages with the same article count once, and an article of which more than half
would go stays whole, so copies and versions of an article are not taken for boxes.

Pages are parsed twice, for statistics and for their text, so that no text is
stored in between. Statistics are sums of narrow rows counted within each page
and combined before the shuffle; a host with a third of all pages is spread over
its paths and texts. Texts are shuffled only if the pages with branches to
remove are too many to broadcast.

Defined results: null html is empty and has the text ""; a null or odd url
belongs to the host ""; rows repeated are extracted each, and count as
pages each; on a host with a single page everything unmarked is important.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.words import column, slices
from arcweave.scratch import Scratch

LEAST = 0.3
GAMMA = 0.9
#: Different articles of a host that a text inside an article must stand in to be removed, and the share that is enough alone.
MANY = 3
EVERY = 0.8
#: Pages with branches to remove are broadcast up to this many (of about 100 bytes).
BROADCAST_PAGES = 100_000
DEEPEST = 32

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title|iframe|svg|textarea|object)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|</?[a-z][^>]*(?:>|\Z)"
    r"|[^<]+|<",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter output picture progress q "
    "rb rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key ends an open element of the value, up to the nearest container.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
CONTAINERS = frozenset("ul ol dl table body html article main section div nav aside footer header form".split())
ARTICLE = frozenset(("article", "main"))
CLUTTER = frozenset("nav header footer aside form menu dialog button select head fieldset".split())
CLUTTER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Whole tokens of a class or id (with _ as -); a word in a longer token, as in no-sidebar or article-header, says nothing.
CLUTTER_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget ad ads advert adverts"
    " advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notification alert popup modal"
    " overlay newsletter subscribe subscription signup login search share sharing social related recommended comment comments reply replies"
    " respond disqus pagination pager copyright disclaimer toolbar"
    " main-nav main-navigation main-menu nav-bar nav-menu site-nav site-navigation site-header site-footer site-menu post-navigation"
    " side-bar left-sidebar right-sidebar sidebar-left sidebar-right widget-area ad-banner ad-box ad-container ad-slot ad-unit google-ad"
    " google-ads banner-ad adsbygoogle cookie-banner cookie-bar cookie-consent cookie-notice gdpr-banner consent-banner"
    " newsletter-form newsletter-signup search-box search-form login-box login-form share-bar share-buttons social-buttons social-icons"
    " social-links social-share related-articles related-posts recommended-posts comment-body comment-form comment-list comments-area"
    " comments-section disqus-thread".split()
)

#: In an article inside a box that only its name makes clutter.
LIFTED = -1

Block = tuple[str, int | None, tuple[str, ...]]  # text, 1 kept or 0 removed by the markup, path of branches


def _is_clutter(tag: str, attributes: str) -> int:
    """2 for clutter by tag, role or attribute, 1 by a name, which an article inside overrides, else 0."""
    if tag in CLUTTER:
        return 2
    if tag in ("html", "body") or not attributes.strip():
        return 0
    named = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.lower() in CLUTTER_ROLES:
            return 0 if tag in ARTICLE else 2
        if name in ("class", "id"):
            named |= not CLUTTER_NAMES.isdisjoint(value.lower().replace("_", "-").split())
        if name == "aria-hidden" and value.lower() == "true":
            return 0 if tag in ARTICLE else 2
    hidden = tag not in ARTICLE and re.search(r"(?i)(?:^|\s)hidden(?:\s|=|/|$)", attributes)
    return 2 if hidden else int(named)


def _key(tag: str, attributes: str) -> str:
    found = next((m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() == "class"), "")
    return ".".join([tag, *sorted(found.split())]) if found else tag


def parse(page: str) -> tuple[list[Block], list[tuple[str, str]], list[int]]:
    """The blocks of a page in order, (path, child elements) of each element, and where each block's branch enters the article."""
    # An open element: tag, depth of the article around it or 0, in clutter (or LIFTED), path, child keys.
    stack: list[tuple[str, int, int, str, list[str]]] = [("", 0, 0, "", [])]
    blocks: list[tuple[str, int, int, tuple[str, ...]]] = []
    elements: list[tuple[str, str]] = []
    held: list[str] = []
    marked = clean = False
    inline_clutter = 0
    inline_open: list[tuple[str, int]] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            _, article, clutter, _, _ = stack[-1]
            blocks.append((text, article, clutter, tuple(s[3] for s in stack[1:])))

    def pop() -> None:
        _, _, _, path, children = stack.pop()
        elements.append((path, ",".join(children)))

    raw: list[str] = []

    def text_done() -> None:
        if raw:
            held.append(html.unescape("".join(raw)))
            raw.clear()

    for m in _TOKEN.finditer(page):
        tag = m[3]
        if tag is None:
            if m[1] is None and page[m.start()] != "<":
                if not inline_clutter:
                    raw.append(m[0])
            elif m[0] == "<":
                raw.append("<")
            continue
        text_done()
        tag, closing, attributes = tag.lower(), bool(m[2]), m[4] or ""
        if tag == "br":
            held.append(" ")
            continue
        if tag in INLINE:
            if tag in VOID:
                continue
            if closing:
                if any(name == tag for name, _ in inline_open):
                    while inline_open:
                        name, clutter = inline_open.pop()
                        inline_clutter -= clutter
                        if name == tag:
                            break
            else:
                clutter = int(_is_clutter(tag, attributes) > 0)
                inline_open.append((tag, clutter))
                inline_clutter += clutter
            continue
        flush()
        inline_open, inline_clutter = [], 0
        if closing:
            if any(s[0] == tag for s in stack[1:]):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if stack[-1][0] == "p":
            pop()
        if tag in ENDS:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at][0] in ENDS[tag]:
                    while len(stack) > at:
                        pop()
                    break
                if stack[at][0] in CONTAINERS:
                    break
        if tag in VOID:
            continue
        _, article, clutter, path, children = stack[-1]
        key = _key(tag, attributes)
        children.append(key)
        own = _is_clutter(tag, attributes)
        starts = tag in ARTICLE or bool(re.search(r"""(?i)\brole\s*=\s*["']?main\b""", attributes))
        if starts and own < 2:
            # An article in a named box counts unless its own name says what it is, as comments do.
            if clutter == 1 and not own:
                clutter, article = LIFTED, len(stack)
            own = 0
        if starts and not article:
            article = len(stack)
        clutter = max(clutter, own) if own else clutter
        if article and clutter <= 0:
            marked = True
            clean |= tag == "article" and not clutter
        path = f"{path}/{key}" if len(stack) <= DEEPEST else path
        stack.append((tag, article, clutter, path, []))
    text_done()
    flush()
    while len(stack) > 1:
        pop()
    decided: list[Block] = []
    for text, article, clutter, path in blocks:
        # Articles in named boxes are the page's own only if it has no others.
        prior = 0 if clutter > 0 or clutter == LIFTED and clean else 1 if article else 0 if marked else None
        decided.append((text, prior, path))
    return decided, elements, [article for _, article, _, _ in blocks]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class _Paths:
    """Hashes of paths, most of which repeat from page to page."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __getitem__(self, path: str) -> int:
        if path not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[path] = _hash(path)
        return self.known[path]


def _inside(blocks: list[Block], depths: list[int], paths: _Paths) -> list[tuple[int, list[tuple[int, int]]]]:
    """(block, its cells) of the blocks in the article: (path, text) for each branch inside it, and (0, text)."""
    found = []
    for at, ((text, prior, branch), depth) in enumerate(zip(blocks, depths, strict=True)):
        if prior == 1:
            what = _hash(text)
            found.append((at, [(0, what), *((paths[p], what) for p in branch[depth:])]))
    return found


def _statistics(pages: DataFrame) -> DataFrame:
    """(key, host, elements, leaves, open, article, inside) of rows (key, host, html), counted within each page.

    ``open`` are the paths of the blocks that the markup does not decide, ``inside``
    the cells of those in the article, and ``article`` is its text's hash or null.
    """
    counted = pa.list_(pa.struct([("path", pa.int64()), ("what", pa.int64()), ("n", pa.int32())]))
    cell = pa.list_(pa.struct([("path", pa.int64()), ("what", pa.int64())]))

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = _Paths()
        for batch in slices(batches, "html"):
            rows = []
            for page in column(batch, "html").to_pylist():
                blocks, elements, depths = parse(page or "")
                shapes = Counter((paths[p], _hash(s)) for p, s in elements)
                leaves = Counter((paths[p], h) for t, _, branch in blocks for h in (_hash(t),) for p in set(branch))
                open_ = sorted({paths[p] for _, prior, branch in blocks if prior is None for p in branch})
                inside = sorted({c for _, cells in _inside(blocks, depths, paths) for c in cells})
                article = _hash("\n\n".join(t for t, prior, _ in blocks if prior)) if inside else None
                rows.append(([(*k, n) for k, n in shapes.items()], [(*k, n) for k, n in leaves.items()], open_, article, inside))
            columns = list(zip(*rows, strict=True))
            arrays = [column(batch, "key"), column(batch, "host")]
            for found in columns[:2]:
                arrays.append(pa.array([[dict(zip(("path", "what", "n"), x, strict=True)) for x in row] for row in found], counted))
            arrays += [pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.int64())]
            arrays.append(pa.array([[{"path": p, "what": w} for p, w in row] for row in columns[4]], cell))
            yield pa.RecordBatch.from_arrays(arrays, ["key", "host", "elements", "leaves", "open", "article", "inside"])

    cells = "array<struct<path: long, what: long, n: int>>"
    return pages.select("key", "host", "html").mapInArrow(
        statistics,
        f"key binary, host long, elements {cells}, leaves {cells}, open array<long>, article long, inside array<struct<path: long, what: long>>",
    )


def _left(page: str, poor: set[int], dropped: set[tuple[int, int]], paths: _Paths) -> str:
    """The text of a page without its ``poor`` branches and the ``dropped`` cells of its article."""
    blocks, _, depths = parse(page)
    gone = set()
    if dropped:
        inside = _inside(blocks, depths, paths)
        gone = {at for at, cells in inside if not dropped.isdisjoint(cells)}
        if 2 * sum(len(blocks[at][0]) for at in gone) > sum(len(blocks[at][0]) for at, _ in inside):
            gone = set()
    kept = []
    for at, (text, prior, branch) in enumerate(blocks):
        if at not in gone and (prior == 1 or prior is None and not any(paths[p] in poor for p in branch)):
            kept.append(text)
    return "\n\n".join(kept)


def _texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of rows (page_id, url, html, poor, dropped)."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = _Paths()
        for batch in slices(batches, "html"):
            rows = zip(*(column(batch, n).to_pylist() for n in ("html", "poor", "dropped")), strict=True)
            found = [_left(page or "", set(poor or ()), {(d["path"], d["what"]) for d in dropped or ()}, paths) for page, poor, dropped in rows]
            yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(found, pa.string())], ["page_id", "url", "text"])

    types = dict(pages.dtypes)
    return pages.select("page_id", "url", "html", "poor", "dropped").mapInArrow(texts, f"page_id {types['page_id']}, url {types['url']}, text string")


def _entropy(total: str, weighted: str, pages: str):
    """Entropy of counts with the sum ``total`` and the sum of n log n ``weighted``, to the base of ``pages``."""
    spread = F.log(total) - F.col(weighted) / F.col(total)
    return F.when(F.col(pages) > 1, F.greatest(F.lit(0.0), spread / F.log(pages))).otherwise(F.lit(0.0))


def importance(statistics: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, path, importance) of every node of every host's tree.

    ``statistics`` has host, elements and leaves, counted within each page.
    """
    n = F.col("n").cast("double")
    spread = F.sum(n).alias("total"), F.sum(n * F.log(n)).alias("weighted")
    shapes = statistics.select("host", F.inline("elements")).groupBy("host", "path", "what").agg(*spread)
    # The entropy of styles needs the counts over all pages, that of content those on each page.
    whole = F.col("total")
    shape = shapes.groupBy("host", "path").agg(
        F.sum("total").alias("total"), F.sum(whole * F.log(whole)).alias("weighted"), F.count("*").alias("styles")
    )
    seen = (
        statistics.select("host", F.explode(F.array_distinct("elements.path")).alias("path"))
        .groupBy("host", "path")
        .agg(F.count("*").alias("pages"))
    )
    node = scratch.save(
        seen.join(shape, ["host", "path"]).select(
            "host",
            "path",
            "pages",
            "styles",
            F.when(F.col("pages") > 1, _entropy("total", "weighted", "pages")).otherwise(F.lit(1.0)).alias("presentation"),
        ),
        "nodes",
    )
    texts = statistics.select("host", F.inline("leaves")).groupBy("host", "path", "what").agg(*spread)
    content = (
        texts.join(node.select("host", "path", "pages"), ["host", "path"])
        .withColumn("evenness", F.least(_entropy("total", "weighted", "pages"), F.lit(1.0)))
        .groupBy("host", "path")
        .agg((1 - F.avg("evenness")).alias("content"))
    )
    share = F.pow(F.lit(GAMMA), F.least("styles", F.lit(100)))
    whole = (1 - share) * F.col("presentation") + share * F.coalesce("content", F.lit(1.0))
    return node.join(content, ["host", "path"], "left").select("host", "path", F.when(F.col("pages") > 1, whole).otherwise(1.0).alias("importance"))


def _boxes(statistics: DataFrame, low: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, path, what) of the cells inside articles that are the site's own text; path 0 is any."""
    articles = statistics.where(F.col("article").isNotNull())
    cells = articles.select("host", "article", F.inline("inside")).distinct()
    repeated = scratch.save(
        cells.groupBy("host", "path", "what").agg(F.count("*").alias("articles")).where(F.col("articles") >= MANY), "repeated"
    )
    hosts = articles.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("of"))
    everywhere = repeated.where("path = 0").join(hosts, "host").where(F.col("articles") >= EVERY * F.col("of"))
    branches = repeated.join(low, ["host", "path"])
    return everywhere.select("host", "path", "what").unionByName(branches.select("host", "path", "what"))


def extract(pages: DataFrame, scratch: Scratch, least: float = LEAST) -> DataFrame:
    """(page_id, url, text) of rows (page_id, url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))
    given = pages.select(
        "page_id",
        "url",
        "html",
        F.xxhash64(host).alias("host"),
        # Equal pages of a host are treated alike, so they may share a key.
        F.unhex(F.md5(F.concat(host, F.lit("\n"), F.coalesce("html", F.lit(""))).cast("binary"))).alias("key"),
    )
    statistics = scratch.save(_statistics(given), "statistics")
    nodes = scratch.save(importance(statistics, scratch), "importance")
    low = nodes.where(F.col("importance") < least)
    branches = statistics.where(F.size("open") > 0).select("key", "host", F.explode("open").alias("path"))
    poor = branches.join(low, ["host", "path"]).groupBy("key").agg(F.collect_set("path").alias("poor"))
    boxes = scratch.save(_boxes(statistics, low, scratch), "boxes")
    boxes = F.broadcast(boxes) if boxes.count() <= BROADCAST_PAGES else boxes.hint("merge")
    cells = statistics.where(F.size("inside") > 0).select("key", "host", F.inline("inside"))
    dropped = cells.join(boxes, ["host", "path", "what"]).groupBy("key").agg(F.collect_set(F.struct("path", "what")).alias("dropped"))
    # A page with an article has no branches that the markup leaves open, so no key is in both.
    removed = scratch.save(poor.unionByName(dropped, allowMissingColumns=True), "removed")
    few = removed.count() <= BROADCAST_PAGES
    return _texts(given.select("page_id", "url", "html", "key").join(F.broadcast(removed) if few else removed, "key", "left"))
