"""Main text of web pages by consensus of their host.

Each page's containers are scored by the text they hold, less their link text.  From the best one the
page's content root is found: the nearest article or main element, and from there each element around
it that adds text with few links, such as a title or lead.  The root casts a vote for its generalised
path (tags with their classes, digits left out) at its host.  Spark counts the votes; the path with
most of them wins at that host, and every page of the host is extracted again from the containers on
that path, without the parts that are no article: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and comments.

A host's path never hides a page's own article: where a page's own root lies elsewhere, the root is taken
if it is an article or main element, else both are, in page order.  Only a root that the host knows for
something else is left: one on a path that stands beside the article on more pages than hold theirs there.

Elements whose name or role says that they are no article are dropped.  So are those with a class or id
that says nothing else; one that merely contains such a word (``social-history``, ``related``) is dropped
only when much of its text is links, and counts less when containers are scored.  Of a header inside an
article the headings stay.

Defined cases: a null or empty page has an empty text; pages with a null URL share the empty host;
equal rows vote and are extracted one by one; an empty table gives an empty result; pages of any length
and depth take time in proportion to their length; other columns pass through, whatever they are called,
but one with the name of the result, which is replaced.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Collection
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import put_back, query, set_apart, small_batches, table
from .urls import url_parts

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
_RAW = "script|style|noscript|template|textarea|title|iframe|noembed|noframes|xmp"
#: Elements whose content is never article text.
_DROP = set("head nav footer aside form button select header dialog menu svg object canvas audio video fieldset".split())
_BLOCK = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address hr br details summary center".split()
) | _DROP
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADINGS | {"p"}
_CONTAINER = set("body main article section div td blockquote center".split())
#: Opening one of these closes an open element of the set, up to the nearest container or list.
_CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = _CONTAINER - {"td"} | set("ul ol dl table html".split()) | _DROP
#: Words of class and id names of parts that are no article.
_BOILER = set(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies gdpr notice "
    "notices popup modal newsletter subscribe signup login sidebar aside widget nav navbar navigation menu breadcrumb "
    "breadcrumbs pagination pager header masthead topbar footer comment comments commentlist disqus replies respond "
    "toolbar hidden".split()
)
#: Words that such parts share with articles.
_MAYBE = set(
    "alert bottom consent copyright disclaimer form legal recommended related search share sharing side skip social "
    "subscription".split()
)
#: Words that say nothing about what they are joined to.
_NEUTRAL = set(
    "area bar block box button buttons container content entry inline inner item items left links list main outer "
    "page panel post posts right section site slot small text top unit wrap wrapper".split()
)
_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_TOKEN = re.compile(
    r"<!--(?:.*?-->|>|.*\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<[!?][^>]*+>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


@dataclass
class Container:
    path: str
    parent: int
    weak: bool = False
    score: float = 0.0


@dataclass
class Page:
    """Containers in page order, and blocks as (container number, text, link characters).

    ``titled`` holds the containers with a heading or paragraph of their own.
    """

    containers: list[Container] = field(default_factory=lambda: [Container("", -1)])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    titled: set[int] = field(default_factory=set)


@dataclass
class _Open:
    tag: str
    container: int = 0
    dropped: bool = False
    link: bool = False
    path: str = ""
    prose: bool = False  # inside a heading or paragraph of its container
    article: bool = False
    lead: bool = False  # inside the header of an article, where only headings count
    heading: bool = False


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)} if text else {}


def _naming(name: str) -> str:
    """What a class or id name says of its element: ``drop``, ``weak`` or nothing."""
    parts = [p.rstrip("0123456789") for p in re.split(r"[-_]+", name.lower())]
    parts = [p for p in parts if p]
    if any(p in _BOILER for p in parts):
        return "drop" if all(p in _BOILER or p in _MAYBE or p in _NEUTRAL for p in parts) else "weak"
    return "weak" if any(p in _MAYBE for p in parts) else ""


def _standing(tag: str, attrs: dict[str, str], article: bool) -> str:
    """How an element stands to an article: ``drop``, ``lead`` (its header), ``weak`` or nothing."""
    if tag in _DROP:
        return "lead" if tag == "header" and article else "drop"
    if tag in ("html", "body", "article", "main") or not attrs:
        return ""
    style = attrs.get("style", "").replace(" ", "").lower()
    if attrs.get("role", "").lower() in _ROLES or "hidden" in attrs or "display:none" in style:
        return "drop"
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    said = {_naming(name) for name in names} - {""}
    return "drop" if "drop" in said else "weak" if said else ""


#: Length above which the beginning of a path is replaced by its hash, so that deep pages stay small.
PATH_LENGTH = 400


def _path(above: str, tag: str, attrs: dict[str, str]) -> str:
    names = ".".join(sorted({re.sub(r"\d+", "", c) for c in attrs.get("class", "").split()} - {""}))
    if len(above) > PATH_LENGTH:
        above = "#" + hashlib.blake2b(above.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
    return f"{above}/{tag}" + (f".{names}" if names else "")


class _Stack:
    """Open elements, with a count by tag so that what is not open is not looked for."""

    def __init__(self):
        self.open = [_Open("")]
        self.count: Counter = Counter()

    def push(self, element: _Open) -> None:
        self.open.append(element)
        self.count[element.tag] += 1

    def cut(self, at: int) -> None:
        for element in self.open[at:]:
            self.count[element.tag] -= 1
        del self.open[at:]

    def close(self, tag: str) -> None:
        """An end tag.  An inline one does not reach past the block it stands in."""
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.cut(i)
                return
            if tag not in _BLOCK and self.open[i].tag in _BLOCK:
                return

    def close_before(self, tags: set[str]) -> None:
        """What a start tag closes: the nearest of these elements, up to the next container or list."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self.cut(i)
                return
            if self.open[i].tag in _SCOPE:
                return


def parse_page(source: str | None) -> Page:
    """Containers and blocks of a page, tolerant of unclosed and stray tags."""
    page = Page()
    stack = _Stack()
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                top = stack.open[-1]
                page.blocks.append((top.container, text, linked))
                if top.prose:
                    page.titled.add(top.container)
            pieces.clear()
        linked = 0

    def add_text(raw: str) -> None:
        nonlocal linked
        top = stack.open[-1]
        if raw and not top.dropped and (top.heading or not top.lead):
            text = entities.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if top.link:
                linked += len(text.strip())

    at = 0
    source = source or ""
    for m in _TOKEN.finditer(source):
        add_text(source[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in _BLOCK:
            flush()
        if m["close"]:
            stack.close(tag)
            continue
        if tag in _VOID:
            continue
        closes = _CLOSES.get(tag) or ({"p"} if tag in _BLOCK else None)
        if closes:
            stack.close_before(closes)
        top = stack.open[-1]
        attrs = _attributes(m["attrs"])
        standing = _standing(tag, attrs, top.article)
        dropped = top.dropped or standing == "drop"
        path, container, prose = top.path, top.container, top.prose
        if tag in _CONTAINER or standing == "weak":
            path = _path(path, tag, attrs)
            if not dropped:
                page.containers.append(Container(path, container, standing == "weak"))
                container, prose = len(page.containers) - 1, False
        stack.push(
            _Open(
                tag, container, dropped, top.link or tag == "a", path, prose or tag in _PROSE,
                top.article or tag in ("article", "main"), top.lead or standing == "lead", top.heading or tag in _HEADINGS,
            )
        )
    add_text(source[at:])
    flush()
    return page


#: What a container keeps of the score of a container inside it.
INHERIT = 0.8


#: What the text of an element counts whose class merely contains a word of parts that are no article.
WEAK = 0.25


def best_container(page: Page) -> int:
    """The container with the highest score: own text counts whole, text deeper inside counts less."""
    weak = [False] * len(page.containers)
    for i, c in enumerate(page.containers):
        weak[i] = c.weak or (c.parent >= 0 and weak[c.parent])
    for number, text, link in page.blocks:
        page.containers[number].score += max(0, len(text) - 2 * link) * (WEAK if weak[number] else 1)
    for c in reversed(page.containers):
        if c.parent >= 0:
            page.containers[c.parent].score += INHERIT * c.score
    return max(range(len(page.containers)), key=lambda i: (page.containers[i].score, i))


def _tag(container: Container) -> str:
    return container.path.rsplit("/", 1)[-1].split(".", 1)[0]


#: The share of link characters up to which added text counts as part of the article.
LINK_SHARE = 0.25


def _sums(page: Page) -> tuple[list[int], list[int], list[bool]]:
    """Text and link characters inside every container, and which containers are links for the most part.

    One pass from the last container to the first, as a container stands before those inside it.  What is
    mostly links and may be no article is left out of the containers around it.
    """
    texts, links, gone = [0] * len(page.containers), [0] * len(page.containers), [False] * len(page.containers)
    for number, text, link in page.blocks:
        texts[number] += len(text)
        links[number] += link
    for i in range(len(page.containers) - 1, 0, -1):
        c = page.containers[i]
        gone[i] = c.weak and links[i] > LINK_SHARE * texts[i]
        if c.parent >= 0 and not gone[i]:
            texts[c.parent] += texts[i]
            links[c.parent] += links[i]
    return texts, links, gone


def content_root(page: Page) -> int:
    """The element that holds the whole article around the best container.

    The body, which holds all else too, is taken only for a heading or paragraph of its own, and not
    around an article or main element.
    """
    containers = page.containers
    texts, links, _ = _sums(page)
    best = at = best_container(page)
    while at >= 0 and _tag(containers[at]) not in ("article", "main"):
        at = containers[at].parent
    root = at = at if at >= 0 else best
    while containers[at].parent >= 0:
        at = containers[at].parent
        if _tag(containers[at]) in ("", "body") and (at not in page.titled or _tag(containers[root]) in ("article", "main")):
            break
        added, linked = texts[at] - texts[root], links[at] - links[root]
        if linked > LINK_SHARE * added:
            break
        if added:
            root = at
    return root


def text_of(page: Page, wanted: set[int]) -> str:
    """Blocks inside the wanted containers, in page order, less parts that are mostly links."""
    _, _, gone = _sums(page)
    inside = [False] * len(page.containers)
    for i, c in enumerate(page.containers):
        inside[i] = i in wanted or (c.parent >= 0 and inside[c.parent] and not gone[i])
    return "\n".join(text for number, text, _ in page.blocks if inside[number])


def extract(source: str | None, winner: str | None, beside: Collection[str] = ()) -> str:
    """The text on the host's path, or of the page's own root where this lies elsewhere, or of both.

    ``beside`` are paths that stand beside the articles of the host.
    """
    page = parse_page(source)
    wanted = {i for i, c in enumerate(page.containers) if c.path == winner}
    if not text_of(page, wanted):
        wanted = set()
    root = at = content_root(page)
    while at >= 0 and at not in wanted:
        at = page.containers[at].parent
    own = page.containers[root]
    if at < 0 and not (wanted and own.path in beside):
        wanted = {root} if _tag(own) in ("article", "main") else wanted | {root}
    return text_of(page, wanted)


def votes_of(source: str | None) -> list[tuple[str, bool, float]]:
    """Paths of a page with text on them: (path, whether it is the root's, score); those around it are no vote."""
    page = parse_page(source)
    root = content_root(page)
    texts, _, gone = _sums(page)
    around, at = set(), page.containers[root].parent
    while at >= 0:
        around.add(at)
        at = page.containers[at].parent
    own = page.containers[root]
    inside = [False] * len(page.containers)
    others = set()
    for i, c in enumerate(page.containers):
        inside[i] = i == root or (c.parent >= 0 and inside[c.parent])
        if texts[i] and not inside[i] and i not in around:
            others.add(c.path)
    found = [(own.path, True, own.score)] if own.score > 0 else []
    return found + [(path, False, 0.0) for path in sorted(others - {own.path})]


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The winning path of each host: most votes, then the higher score, then the last in order.

    ``beside`` lists paths that were some page's root, but stand beside the root on more pages.
    """

    @F.pandas_udf("array<struct<path:string,root:boolean,score:double>>")
    def vote(sources: pd.Series) -> pd.Series:
        kinds = ("path", "root", "score")
        return pd.Series([[dict(zip(kinds, v)) for v in votes_of(source)] for source in sources], dtype=object)

    host, _ = url_parts(F.col(url))
    ballots = pages.select(host.alias("host"), F.explode(vote(html)).alias("v"))
    counted = ballots.groupBy("host", F.col("v.path").alias("path")).agg(
        F.count_if("v.root").alias("votes"), F.count_if(~F.col("v.root")).alias("others"), F.sum("v.score").alias("score")
    )
    voted = counted.filter("votes > 0")
    rank = F.struct(F.col("votes"), F.round("score", 3).alias("score"), F.col("path").alias("tie"))
    lost = F.collect_list(F.when(F.col("others") > F.col("votes"), F.col("path")))
    return voted.groupBy("host").agg(F.max_by("path", rank).alias("winner"), lost.alias("beside"))


#: Parts each host is dealt to when pages and winners are joined by a shuffle.
SALTS = 64


def extract_pages(pages: DataFrame, url: str = "url", html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text added.

    The winners are stored, so Spark knows their size: few are sent to all tasks, many are joined by
    a shuffle, where each host is dealt to ``SALTS`` parts so that a large host is no single task.
    """

    @F.pandas_udf("string")
    def read(sources: pd.Series, winners: pd.Series, beside: pd.Series) -> pd.Series:
        found = [extract(s, w, set() if b is None else set(b)) for s, w, b in zip(sources, winners, beside)]
        return pd.Series(found, dtype=object)

    small_batches(pages.sparkSession)
    winners = stage(host_paths(pages, url, html), "host-paths")
    host, _ = url_parts(F.col(url))
    salted = winners.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("host", "_host")
    columns = list(dict.fromkeys([url, html]))
    rows = set_apart(pages, *columns)
    rows = rows.withColumn("_host", host).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    named = salted.withColumnsRenamed({"winner": "_winner", "beside": "_beside"})
    joined = rows.join(named, ["_host", "_salt"], "left")
    return put_back(joined, pages.columns, *columns, keep={into: read(html, "_winner", "_beside")})


@query("op9_html_extraction")
def op9_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_pages(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
