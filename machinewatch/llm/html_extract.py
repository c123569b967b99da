"""Main text of web pages by consensus paths of their host.

Each page is parsed once into blocks of text and the containers around them.
A block's letters outside links are credited to its container and half to the
one above; a container around several such ones is taken for the article if it
holds clearly more text than the best of them. A container's generalised path
is its chain of tags and classes without digits. Every page votes for its best
path; votes are summed per host in Spark, and a second pass extracts each page
by the first of its host's winning paths that it has, or by its own best
container.

Left out wherever they stand: navigation, forms, asides, footers, dialogs,
scripts, styles, hidden elements, and containers whose class, id or role
names a menu, banner, sidebar, notice, advert, comments and the like. A name
that tells a state (``no-sidebar``, ``comments-open``) is none of these, and a
container around the article or the page's first heading is not left out for
its name. Of a header only the headings inside the article stay.

Job shape: paths and votes are small rows (summed per task first). The winning
paths, a few per host, are written and measured: within ``BROADCAST`` bytes
they are broadcast, else each host's paths and pages are dealt over salts, so no
page waits for the others of its host. A page's containers know their path by
number, so depth costs memory once per element.

Defined results: null and empty html and pages without text give an empty
text; a null url or one without a host has no consensus; equal votes: the
first path in order; repeated pages vote and are extracted each; elements may
be nested to any depth.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows, written

#: Paths kept per host, and the least share of the host's votes of any but the first.
PATHS, SHARE = 5, 0.05
#: Text of a container against its best part's, from which on it is the article itself.
WHOLE = 1.2
#: Characters of winning paths that are broadcast, and salts of a host's pages beyond that.
BROADCAST, SALTS = 16 << 20, 32

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|([^<]+)|(<)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = frozenset("script style noscript iframe textarea title svg math template object canvas select xmp".split())
_VOID = frozenset("area base col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split())
_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dd dt figcaption caption".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_JUNK_TAGS = frozenset("nav footer aside form button menu dialog fieldset head".split())
_JUNK_ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert menu menubar banner form".split())
#: Parts of class and id names that mark what is not the article (fixed values).
_JUNK_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget "
    "footer comment comments respond disqus reply replies share sharing social related recommended newsletter subscribe "
    "subscription signup login search pagination pager toolbar masthead topbar hidden".split())
_HEADER_NAMES = frozenset("header".split())
#: Words beside such a name that make it tell a state of the page (fixed values).
_STATES = frozenset("no not has have with without is open opened closed enabled disabled on off active inactive show hide".split())
#: Elements that a start tag of the same family closes, and the containers that stop the search.
_CLOSES = {
    "p": ({"p"}, {"div", "article", "section", "main", "body", "td", "li", "blockquote", "ul", "ol", "table"}),
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Blocks that end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split())
_SPLIT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Node:
    """An element: its path's number, and the text it holds itself."""

    __slots__ = ("tag", "path", "parent", "named", "junk", "header", "credit", "worth", "own", "total")

    def __init__(self, tag: str, path: int, parent: _Node | None, named: bool, junk: bool, header: bool):
        self.tag, self.path, self.parent = tag, path, parent
        self.named, self.junk = named, junk
        self.header = header or (parent is not None and parent.header)
        self.credit, self.worth, self.own, self.total = 0.0, 0, 0, 0


class Page:
    """A parsed page: blocks of text in order, elements in order of their start tags, and the paths by number."""

    def __init__(self) -> None:
        self.nodes = [_Node("", 0, None, False, False, False)]
        self.blocks: list[tuple[_Node, str]] = []
        self.numbers: dict[tuple[int, str], int] = {(-1, ""): 0}
        self.names: list[tuple[int, str]] = [(-1, "")]

    def add(self, tag: str, name: str, parent: _Node, named: bool, junk: bool, header: bool) -> _Node:
        key = (parent.path, name.replace("/", "|"))
        if key not in self.numbers:
            self.numbers[key] = len(self.names)
            self.names.append(key)
        node = _Node(tag, self.numbers[key], parent, named, junk, header)
        self.nodes.append(node)
        return node

    def path_text(self, path: int) -> str:
        names = []
        while path > 0:
            path, name = self.names[path]
            names.append(name)
        return "".join(f"/{name}" for name in reversed(names))

    def path_number(self, text: str) -> int | None:
        """The number of a path, if the page has it."""
        path: int | None = 0
        for name in text.split("/")[1:]:
            path = self.numbers.get((path, name))
            if path is None:
                break
        return path

    def settle(self) -> None:
        """Decide what is left out, and credit the rest."""
        holds = set()
        heading = next((n for n in self.nodes if n.tag == "h1"), None)
        for node in reversed(self.nodes):
            main = node.tag in ("article", "main") and not node.named or node is heading
            if (main or id(node) in holds) and node.parent is not None:
                holds.add(id(node.parent))
        for node in self.nodes[1:]:
            node.junk = node.junk or node.named and id(node) not in holds or node.parent.junk
        for node in reversed(self.nodes):
            if node.junk:
                continue
            node.total += node.worth
            if node.parent is not None:
                node.parent.total += node.total
            if node.worth:
                holder = node.parent if node.tag in _PARAGRAPH and node.parent else node
                holder.credit += node.worth
                if holder.parent:
                    holder.parent.credit += node.worth / 2


def _names(attributes: dict[str, str]) -> list[set[str]]:
    """The words of each class and id name."""
    value = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return [set(_SPLIT.split(_CAMEL.sub("-", name).lower())) for name in value.split()]


def _names_any(names: list[set[str]], words: frozenset[str] | set[str]) -> bool:
    return any(name & words and not name & _STATES for name in names)


def parse(page: str) -> Page:
    """Elements and blocks of text; junk and credits are settled."""
    parsed = Page()
    stack, parts, linked, links = [parsed.nodes[0]], [], 0, 0
    opened: dict[str, int] = {}
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                node = stack[-1]
                parsed.blocks.append((node, text))
                node.worth += len(text) - min(linked, len(text))
            parts, linked = [], 0

    def leave(i: int) -> None:
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    while at < size:
        match = _TOKEN.match(page, at)
        if match is None:  # cannot happen: the last alternatives take any character
            break
        at = match.end()
        close, tag, attributes, text, stray = match.groups()
        if text is not None or stray is not None:
            parts.append(text or stray)
            linked += len(text or "") if links else 0
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _RAW and not close:
            if not attributes.endswith("/"):
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
            continue
        if tag == "a":
            links = max(0, links - 1) if close else links + 1
        if tag == "br" or tag in _VOID:
            if tag in ("br", "hr"):
                parts.append(" ")
            continue
        if close:
            if not opened.get(tag):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    flush()
                    leave(i)
                    links = 0 if tag not in _INLINE else links
                    break
            continue
        own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        names = _names(own) if own else []
        style = own.get("style", "").replace(" ", "").lower() if own else ""
        junk = (tag in _JUNK_TAGS or own.get("role", "").lower() in _JUNK_ROLES
                or "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in style
                or "visibility:hidden" in style)
        named = _names_any(names, _JUNK_NAMES)
        if tag in ("html", "body", "main", "article"):
            # The page or the article itself is not left out for its name, unless it is a comment.
            junk, named = False, tag == "article" and _names_any(names, {"comment", "comments", "reply"})
        if tag in _INLINE and not junk and not named:
            continue
        flush()
        if tag in _ENDS_P or tag in _CLOSES:
            ends, stops = _CLOSES.get(tag, _CLOSES["p"])
            if any(opened.get(e) for e in ends):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ends:
                        leave(i)
                        break
                    if stack[i].tag in stops:
                        break
        if attributes.endswith("/") and tag in _INLINE:
            continue
        classes = ".".join(sorted(c for c in _DIGITS.sub("", own.get("class", "")).split())) if own else ""
        header = tag == "header" or _names_any(names, _HEADER_NAMES)
        stack.append(parsed.add(tag, f"{tag}.{classes}" if classes else tag, stack[-1], named, junk, header))
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    parsed.settle()
    return parsed


def best_path(page: Page) -> tuple[str, float] | None:
    """The path of the page's best containers, and its credit."""
    credit: dict[int, float] = {}
    holders: dict[int, list[_Node]] = {}
    for node in page.nodes:
        if not node.junk and node.credit > 0 and node.tag not in _PARAGRAPH:
            credit[node.path] = credit.get(node.path, 0.0) + node.credit
            holders.setdefault(node.path, []).append(node)
    if not credit:
        return None
    most = max(credit.values())
    path = min((p for p in credit if credit[p] == most), key=page.path_text)
    # The article around it; else the parent that holds several such containers.
    node = holders[path][0]
    up = node
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is None:
        parents = {id(n.parent) for n in holders[path]}
        up = node.parent if len(holders[path]) > 1 and len(parents) == 1 and node.parent.tag not in ("", "body", "html") else node
        # Its parts may have names of their own: a wrapper with clearly more text is the article.
        above = up.parent
        while above is not None and above.tag not in ("", "body", "html"):
            up, above = above if above.total >= WHOLE * up.total else up, above.parent
    return page.path_text(up.path), most


def take(page: Page, path: str) -> str:
    """Texts of the blocks inside containers of this path."""
    number = page.path_number(path)
    if number is None:
        return ""
    inside = set()
    for node in page.nodes:
        if node.path == number or node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
    return " ".join(text for node, text in page.blocks if id(node) in inside and not node.junk and not (
        node.header and node.tag not in _HEADING))


def extract(page: str | None, paths: list[str]) -> str:
    """Text of a page by the first path that it has, else by its own best one."""
    parsed = parse(page) if page else None
    if parsed is None or not parsed.blocks:
        return ""
    for path in paths:
        if text := take(parsed, path):
            return text
    own = best_path(parsed)
    return take(parsed, own[0]) if own else ""


def host_of(url: str):
    """Column: the host of a url column in lower case, null if there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: int = PATHS,
               share: float = SHARE) -> DataFrame:
    """``host, paths array<string>``: the winning paths of every host, most votes first."""

    def start():
        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            votes: dict[tuple, int] = {}
            for host, page in rows:
                best = best_path(parse(page)) if page else None
                if best:
                    votes[host, best[0]] = votes.get((host, best[0]), 0) + 1
                if len(votes) > 50_000:
                    yield from ((*k, n) for k, n in votes.items())
                    votes = {}
            yield from ((*k, n) for k, n in votes.items())

        return run

    hosted = pages.select(host_of(url_col).alias("h"), F.col(html_col).alias("p")).where("h is not null")
    votes = map_rows(hosted, "host string, path string, n long", start, batch_rows=10_000)
    sums = votes.groupBy("host", "path").agg(F.sum("n").alias("n"))
    by_host = Window.partitionBy("host")
    ranked = sums.withColumn("rank", F.row_number().over(by_host.orderBy(F.desc("n"), "path"))).withColumn(
        "all", F.sum("n").over(by_host))
    won = ranked.where((F.col("rank") <= keep) & ((F.col("rank") == 1) | (F.col("n") >= share * F.col("all"))))
    return won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("r")).select(
        "host", F.col("r.path").alias("paths"))


def with_paths(pages: DataFrame, paths: DataFrame, limit: int = BROADCAST) -> DataFrame:
    """``pages`` (with a host column ``h``) and the paths of their host; the html is not shuffled if the paths are small."""
    paths = written(paths, "html-paths")
    size = paths.agg(F.sum(F.length("host") + F.length(F.array_join("paths", "")))).first()[0] or 0
    if size <= limit:
        return pages.join(F.broadcast(paths), pages["h"] == paths["host"], "left")  # measured above
    # Beyond that, a host's pages are dealt over salts and its paths repeated for each; pages without a host over all tasks.
    salted = paths.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pages.withColumn("salt", F.pmod(F.xxhash64("html", "url", "page_id"), F.lit(SALTS)).cast("int")).withColumn(
        "k", F.coalesce("h", F.concat(F.lit("?"), F.xxhash64("html", "page_id").cast("string"))))
    return dealt.join(salted, (dealt["k"] == salted["host"]) & (dealt["salt"] == salted["s"]), "left")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  limit: int = BROADCAST) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    paths = host_paths(pages, url_col, html_col)
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                       host_of(url_col).alias("h"))
    both = with_paths(own, paths, limit).select("page_id", "url", "html", "paths")

    def start():
        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            for page_id, url, page, found in rows:
                text = extract(page, found or [])
                yield page_id, url, text, len(text)

        return run

    return map_rows(both, "page_id long, url string, text string, n_chars long", start)
