"""HTML extraction by site template removal.

Each page is parsed once into a tree whose elements carry a hash of their subtree (tag, class and id, text, children). Spark counts
the different pages of a host that hold each subtree (pages with one and the same tree count once, so an article is no template for being
served at many addresses); those that recur on at least MIN_PAGES pages and on SHARE of the host's pages (beyond
SMALL pages, SHARE of sqrt(SMALL * pages), so that the bar grows slowly) are templates, and the extraction deletes them: a page of
nothing but its site's frame is empty. Elements that say by tag, role, class or id that they are not the article are
deleted as well. Where a page marks its article (article, main, role=main), only that counts, and prose in it (paragraphs, headings,
lists, quotes and the like) is not taken for a template, as articles may quote each other, and judged by its class only if it is a list or a table or
its class names an advert. Of articles side by side the one with the most text counts; the others are another page's.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_PAGES, SHARE, SMALL = 5, 0.3, 100
#: Templates (host and hash) up to which they go to the tasks as one table of at most some 10 MB; beyond, pages are joined with theirs.
MOST_TEMPLATES = 200_000

# Elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROP = frozenset("head nav footer aside form script style noscript template iframe svg canvas button select textarea dialog menu object audio video title annotation annotation-xml".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big blink cite code data del dfn em font i img input ins kbd label mark nobr output q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u
    var wbr math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics""".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th caption figure figcaption".split()) | INLINE
LISTS = frozenset("ul ol dl table".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
#: A class or id says so if it is made of these words and, beside one of them, of BESIDE.
NOT_ARTICLE = frozenset(
    """ad ads adv advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies
    disqus footer gdpr menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion recommended
    related replies reply respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
BESIDE = frozenset(
    """area article bar blog block bottom box btn button buttons center col column container content form global group holder inner item items left link links
    list main mobile outer overlay page panel post primary reader readers right row secondary section side site slot sticky top unit user users wrap wrapper""".split()
)
#: Words that mark an advert even where they are said of prose.
ADVERT = frozenset("ad ads adv advert adverts advertisement advertising adbox adsense sponsored".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?=\s|/|$))""", re.IGNORECASE)
_NAMES = re.compile(r"[a-z]+")


@lru_cache(maxsize=1 << 14)
def _no_article(names: str) -> int:
    """1 if one of the names of a class or id consists of words that mark what is not the article, 2 if one of these marks an advert, else 0."""
    found = 0
    for name in names.split():
        words = set(_NAMES.findall(name))
        if words & NOT_ARTICLE and words <= NOT_ARTICLE | BESIDE:
            found = max(found, 2 if words & ADVERT else 1)
    return found


class Node:
    __slots__ = ("tag", "named", "drop", "items", "hash", "article", "classed")

    def __init__(self, tag: str, named: str = "", drop: bool = False, article: bool = False, classed: int = 0):
        """classed: what its class or id says, as _no_article tells."""
        self.tag, self.named, self.drop, self.article, self.classed = tag, named, drop, article, classed
        self.items: list[str | Node] = []
        self.hash = 0


def _opened(tag: str, attributes: str) -> Node:
    drop, main, named, classed = tag in DROP, tag in ("article", "main"), "", 0
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, *value in _ATTRIBUTE.findall(attributes):
            name, text = name.lower(), "".join(value).lower()
            named += f"{name}={text};"
            if name in ("class", "id"):
                classed = classed if tag in ("html", "body") else max(classed, _no_article(text))
            elif name == "role":
                drop |= text in ROLES
                main |= text == "main"
            else:
                drop |= name == "hidden" or text == "true"
    return Node(tag, named, drop, main and not drop and not classed, classed)


def _close(node: Node) -> None:
    h = xxhash.xxh64(f"{node.tag} {node.named}")
    for x in node.items:
        h.update(" ".join(x.split()) if isinstance(x, str) else x.hash.to_bytes(8, "little"))
    node.hash = h.intdigest()


def parse(page: str) -> Node:
    """The tree of a page; unclosed, crossing and stray tags never fail."""
    root = Node("#root")
    stack = [root]
    held: Counter = Counter()  # open elements by tag, so that a stray end tag costs no search

    def push(node: Node) -> None:
        stack.append(node)
        held[node.tag] += 1

    def up_to(names: tuple[str, ...], stop: tuple[str, ...] = ()) -> None:
        if not any(held[x] for x in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                while len(stack) > depth:
                    held[stack[-1].tag] -= 1
                    _close(stack.pop())
                return
            if stack[depth].tag in stop:
                return

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        m = _TAG.search(page, at) if at < last else None
        if not m:  # no tag can follow the last ">", but an unclosed comment can
            stack[-1].items.append(page[at:].partition("<!--")[0])
            break
        if m.start() > at:
            stack[-1].items.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            # an inline end tag doesn't reach out of its block; others reach any open element
            if tag in INLINE and not held[tag]:
                continue
            if tag in INLINE:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        up_to((tag,))
                        break
                    if stack[depth].tag not in INLINE:
                        break
            elif tag == "p":
                up_to(("p",), ("article", "main", "body", "td", "div", "section", "li"))
            elif tag != "br":
                up_to((tag,))
            else:
                stack[-1].items.append(Node("br"))
            continue
        if tag in CLOSES_P:
            up_to(("p",), ("article", "main", "body", "td", "div", "section", "li", "aside", "nav", "footer"))
        if tag in SIBLINGS:
            same, stop = SIBLINGS[tag]
            up_to(tuple(same.split()), stop)
        if tag == "body":
            up_to(("head",))
        node = _opened(tag, m[3] or m[6] or "")
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
            push(node)
            if not end:
                break
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/") or tag in ("p", "div", "span", "article"):
            push(node)
    while stack:
        _close(stack.pop())
    return root


def _walk(root: Node, templates: frozenset | set, collect: set | None = None) -> Iterator[str]:
    """Text of what is left, a space for each block's edge; with collect, the hashes that may be templates instead."""
    inside_marked = _marked(root)
    stack: list[tuple[str | Node, bool, bool]] = [(root, not inside_marked, False)]  # and whether it is wanted, and within an article
    while stack:
        x, wanted, within = stack.pop()
        if isinstance(x, str):
            if wanted:
                yield entities.unescape(x)
            continue
        marked = inside_marked and wanted
        prose = marked and x.tag in PROSE
        if x.drop or x.classed and not (prose and x.classed == 1 and x.tag not in LISTS) or x.tag == "header" and not marked:
            if collect is not None:
                collect.add(x.hash)
            yield " "
            continue
        if x.tag not in ("#root", "html", "body", "br") and not x.article and not prose and x.tag not in INLINE:
            if collect is not None:
                collect.add(x.hash)
            elif x.hash in templates:
                yield " "
                continue
        wanted, within = wanted or x.article, within or x.tag == "article"
        edge = x.tag not in INLINE and "-" not in x.tag  # an element of a site's own making is inline
        if edge:
            stack.append((" ", True, within))
        items = x.items if within else _without_other_articles(x.items)
        stack.extend((y, wanted, within) for y in reversed(items))
        if edge:
            stack.append((" ", True, within))


def _without_other_articles(items: list) -> list:
    """items with the article that has the most text (the first of equals) and no other, if there are several side by side."""
    articles = [x for x in items if isinstance(x, Node) and x.article and x.tag == "article"]
    if len(articles) < 2:
        return items
    best = max(articles, key=_length)
    return [" " if isinstance(x, Node) and x is not best and x.article and x.tag == "article" else x for x in items]


def _length(node: Node) -> int:
    """Characters in the words of what its tags and classes leave of an element."""
    n, stack = 0, [node]
    while stack:
        for x in stack.pop().items:
            if isinstance(x, str):
                n += sum(map(len, x.split()))
            elif not x.drop and not x.classed:
                stack.append(x)
    return n


def _marked(root: Node) -> bool:
    stack = [root]
    while stack:
        x = stack.pop()
        if x.article:
            return True
        if not x.drop and not x.classed:
            stack.extend(y for y in x.items if isinstance(y, Node))
    return False


def subtrees(root: Node) -> set[int]:
    """Hashes of the subtrees that may be templates."""
    found: set[int] = set()
    for _ in _walk(root, frozenset(), found):
        pass
    return found


def extract(page: str, templates: frozenset | set = frozenset()) -> str:
    """The text of a page without templates; references are decoded in each run of text by itself."""
    return " ".join("".join(_walk(parse(page), templates)).split())


def host_of(url: str = "url") -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def templates_of(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(host, hash) of subtrees that recur on many different pages of a host. Counts are pre-aggregated, so a hot host meets no single task."""

    signed = lambda h: h - (1 << 64) if h >> 63 else h

    def run(batches):
        for batch in batches:
            trees = [parse(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([signed(t.hash) for t in trees], pa.int64()), pa.array([[signed(h) for h in subtrees(t)] for t in trees], pa.list_(pa.int64()))],
                ["host", "page", "hashes"],
            )

    hosted = pages.select(host_of().alias("host"), F.col("html").cast("string").alias("html"))
    # pages with the same tree have the same subtrees
    different = hosted.mapInArrow(run, "host string, page long, hashes array<bigint>").groupBy("host", "page").agg(F.any_value("hashes").alias("hashes"))
    counts = different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    sizes = different.groupBy("host").agg(F.count("*").alias("pages"))
    bar = share * F.least(F.col("pages").cast("double"), F.sqrt(SMALL * F.col("pages")))
    return counts.filter(F.col("n") >= min_pages).join(sizes, "host").filter(F.col("n") >= bar).select("host", "hash")


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE, most: int = MOST_TEMPLATES) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html; other columns are ignored).

    Null or empty html has the empty text. Pages without a host form one. Repeated rows count as one page. Text is decoded, each
    run of white space is one space, and nothing is cut.
    """
    from .common import cut

    found = cut(templates_of(pages, min_pages, share))
    own = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host_of().alias("host"))

    def read(table: dict | None):
        def run(batches):
            for batch in batches:
                rows = []
                for i, (page, host) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                    hashes = table.get(host, ()) if table is not None else batch.column(4)[i].as_py() or ()
                    rows.append(extract(page, {h % (1 << 64) for h in hashes}) if page else "")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.string())], ["page_id", "url", "text"])

        return run

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    if found.count() <= most:
        table: dict[str, list[int]] = {}
        for host, h in found.collect():
            table.setdefault(host, []).append(h)
        out = own.mapInArrow(read(table), schema)
    else:
        # hosts are salted so that a hot one is dealt over many tasks
        lists = found.groupBy("host").agg(F.collect_list("hash").alias("hashes")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        salted = own.withColumn("salt", F.pmod(F.xxhash64("url", "page_id"), F.lit(64)).cast("int"))
        out = salted.join(lists, ["host", "salt"], "left").select("page_id", "url", "html", "host", "hashes").mapInArrow(read(None), schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))
