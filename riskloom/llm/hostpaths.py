"""Main text of web pages by consensus of their host's pages on the container that holds it.

Pass one reads every page into blocks of text and scores its containers: each container gets the characters of
its own blocks less twice their link characters, its parent half as many. A page votes for the generalised
tag-class path (numbers of two digits or more made one sign, classes sorted) of the article that its best container belongs to, with
that container's share of the page's score. Votes are summed per host and path in Spark; paths with at least ``SHARE`` of a host's
votes win (so at most 1 / ``SHARE`` per host). Pass two reads the pages again and takes the most voted winning path
that the page has, or its own best container where it has none.

Left out everywhere: scripts, styles and other unseen elements, forms, and regions whose tag, role, class or id
says menu, header, footer, sidebar, notice, advert or comment (a header inside an article that holds its h1
stays), and inside the container lists whose text is mostly links.

Defined results: null or empty html gives an empty text; so does a page without text outside such regions; a null url
is a host of its own; a page that is cut off ends where it ends; plain text is one block; very long pages are read
whole in time linear in their length; repeated rows give equal results; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices
from riskloom.session import checkpointed

SHARE, UNIT, BROADCAST_BYTES = 0.02, 1_000_000, 32 << 20

# -- reading a page ---------------------------------------------------------------------------------

# elements whose content is not markup, and elements shown as something other than text
UNSEEN = ("script", "style", "noscript", "textarea", "title", "iframe")
MUTE = frozenset("svg canvas select button audio video".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<unseen>" + "|".join(UNSEEN) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=unseen)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption colgroup thead tbody tfoot tr td th blockquote pre section article main "
    "aside nav header footer form fieldset legend figure figcaption address hr details summary center dir menu search hgroup head frameset template object dialog".split()
)
VOID = frozenset("br hr img input meta link source wbr area base col embed track param".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# an opening tag ends open elements of these kinds, up to the nearest of the given scopes
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)), "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
}
# -- fixed values: names that tell what a region is for ---------------------------------------------
LEFT_OUT_TAGS = frozenset("nav aside footer form dialog menu search template object".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle adbox adslot banner sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation navi menu menus submenu topbar breadcrumb breadcrumbs sidebar sidebars side aside rail footer foot masthead "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer newsletter subscribe subscription signup login signin "
    "search searchbox form comment comments commentlist disqus reply replies respond discussion share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager copyright legal outbrain taboola".split()
)
HEADER_NAMES = frozenset(("header",))
NOT_ITSELF = ("has-", "no-", "with-", "without-")  # such a class names something else on the page
ARTICLE_NAMES = frozenset("article content post entry story main body text".split())
_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_DIGITS = re.compile(r"\d{2,}")
SEEN, HEADER, OUT = 0, 1, 2


class Kind(NamedTuple):
    step: str
    use: int
    article: bool


@lru_cache(1 << 14)
def kind_of(tag: str, attributes: str) -> Kind:
    """An element's step in generalised paths, whether its text is left out, and whether it is named as an article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in reversed(list(_ATTRIBUTE.finditer(attributes)))}
    classes = sorted({_DIGITS.sub("0", c) for c in found.get("class", "").lower().split()})
    own = _DIGITS.sub("0", found.get("id", "").strip().lower())
    step = tag + "".join("." + c.replace(">", "") for c in classes) + ("#" + own.replace(">", "") if own and not classes else "")
    named = [c for c in found.get("class", "").split() if not c.lower().startswith(NOT_ITSELF)]
    names = {w.lower() for w in _NAME.findall(" ".join([*named, found.get("id", "")]))}
    role = found.get("role", "").strip().lower()
    use = SEEN
    if tag not in ("html", "body"):
        if tag in LEFT_OUT_TAGS or role in LEFT_OUT_ROLES or (names & LEFT_OUT_NAMES and tag not in ("main",)):
            use = OUT
        elif tag == "header" or names & HEADER_NAMES:
            use = HEADER
    return Kind(step, use, tag in ("article", "main") or role in ("main", "article") or bool(names & ARTICLE_NAMES))


class Block(NamedTuple):
    path: tuple[int, ...]  # its elements, outermost first
    text: str
    links: int  # characters inside links
    out: bool


class Page:
    """The blocks of one page in order, and its block elements (step, tag, named as an article) by number."""

    def __init__(self, source: str) -> None:
        self.steps: list[str] = []
        self.tags: list[str] = []
        self.articles: list[bool] = []
        self.blocks: list[Block] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, int, int]] = []  # tag, element, region that leaves it out, header region
        words: list[str] = []
        link_words: list[str] = []
        in_link, last, mute = 0, 0, ""
        kept_headers: set[int] = set()
        found: list[tuple[tuple[int, ...], str, int, int, int]] = []

        def flush() -> None:
            nonlocal words, link_words
            if words:
                text = " ".join("".join(words).split())
                if text:
                    links = len(" ".join("".join(link_words).split()))
                    top = stack[-1] if stack else ("", -1, -1, -1)
                    found.append((tuple(s[1] for s in stack), text, links, top[2], top[3]))
                words, link_words = [], []

        def say(raw: str) -> None:
            if mute:
                return
            text = entities.unescape(raw) if "&" in raw else raw
            words.append(text)
            if in_link:
                link_words.append(text)

        def close(at: int) -> None:
            flush()
            del stack[at:]

        for m in _TOKEN.finditer(source):
            if m.start() > last:
                say(source[last : m.start()])
            last = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag == "a":
                in_link = 0 if m["end"] else 1
                continue
            if tag == "br":
                words.append(" ")
                continue
            if tag in MUTE:
                mute = "" if m["end"] else mute if m["attributes"].endswith("/") else mute or tag
                continue
            if tag not in BLOCKS:
                continue
            mute = ""
            if m["end"]:
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at][0] == tag or (tag in HEADINGS and stack[at][0] in HEADINGS):
                        close(at)
                        in_link = 0
                        break
                else:
                    flush()
                continue
            flush()
            in_link = 0 if tag in ("p", "li", "article") else in_link
            closes, scopes = _CLOSES.get(tag, ((), ()))
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in scopes:
                    break
                if stack[at][0] in closes:
                    del stack[at:]
            while stack and (stack[-1][0] == "p" or (stack[-1][0] in HEADINGS and tag in HEADINGS)):
                stack.pop()
            if tag in VOID or tag == "head":
                continue
            if tag in ("html", "body") and any(s[0] == tag for s in stack):
                continue
            kind = kind_of(tag, m["attributes"])
            element = len(self.steps)
            self.steps.append(kind.step), self.tags.append(tag), self.articles.append(kind.article and kind.use == SEEN)
            _, _, out, header = stack[-1] if stack else ("", -1, -1, -1)
            if out >= 0 and self.tags[out] == "form" and self.articles[element]:
                out = -1  # a form around the whole page
            if out < 0 and kind.use == OUT:
                out = element
            if out < 0 and header < 0 and kind.use == HEADER:
                header = element
            if tag == "h1" and header >= 0 and any(self.articles[s[1]] for s in stack if s[1] < header):
                kept_headers.add(header)
            stack.append((tag, element, out, header))
        if last < len(source):
            say(source[last:])
        flush()
        self.blocks = [Block(path, text, links, out >= 0 or (header >= 0 and header not in kept_headers)) for path, text, links, out, header in found]

    def container(self, path: tuple[int, ...]) -> int:
        """How many of a block's elements belong to its container: not the paragraph or heading itself."""
        n = len(path)
        while n and self.tags[path[n - 1]] in _TEXT_TAGS:
            n -= 1
        return n

    def generalised(self, path: tuple[int, ...]) -> str:
        return ">".join(self.steps[e] for e in path if self.tags[e] not in ("html", "body"))


_TEXT_TAGS = HEADINGS | frozenset("p li ul ol dl dt dd blockquote pre figure figcaption hgroup table caption thead tbody tfoot tr td th address".split())


def _scores(page: Page, blocks: list[Block]) -> dict[tuple[int, ...], int]:
    """Score per container (its elements); titles alone do not make one."""
    own: Counter = Counter()
    for b in blocks:
        value = len(b.text) - 2 * b.links
        if value > 0:
            own[b.path[: page.container(b.path)]] += 2 * value
    out = Counter(own)
    for path, value in own.items():
        if path:
            out[path[:-1]] += value // 2
    return out


def _raised(page: Page, path: tuple[int, ...], blocks: list[Block]) -> tuple[int, ...]:
    """The article that a container belongs to: the outermost one above it, or the outermost element named as one."""
    for wanted in ("article", "main"):
        for i, e in enumerate(path):
            if page.tags[e] == wanted and page.articles[e]:
                return path[: i + 1]
    n = next((i + 1 for i, e in enumerate(path) if page.articles[e]), len(path))
    while n > 1 and page.steps[path[n - 1]] in ("div", "section") and page.tags[path[n - 2]] not in ("html", "body"):
        n -= 1  # part of what is around it
    while 0 < n:  # a parent that adds only headings
        above = path[: n - 1]
        more = [b for b in blocks if b.path[: n - 1] == above and b.path[:n] != path[:n]]
        if not more or not all(any(page.tags[e] in HEADINGS for e in b.path) for b in more):
            break
        n -= 1
    return path[:n]


def candidates(page: Page) -> dict[str, int]:
    """Generalised container paths of a page and their score, raised to articles."""
    seen = [b for b in page.blocks if not b.out]
    raised: dict[tuple[int, ...], tuple[int, ...]] = {}
    out: dict[str, int] = defaultdict(int)
    best = _scores(page, seen)
    for path, value in best.items():
        up = raised[path] = _raised(page, path, seen)
        name = page.generalised(up)
        # containers of one article do not add up: the best of them stands for it
        out[name] = max(out[name], value)
    return out


def text_at(page: Page, name: str) -> str:
    """Blocks below the elements with this path, without lists of links."""
    steps = name.split(">") if name else []
    inside, links = [], Counter()
    for b in page.blocks:
        if b.out:
            continue
        path = [e for e in b.path if page.tags[e] not in ("html", "body")]
        if [page.steps[e] for e in path[: len(steps)]] != steps:
            continue
        below = page.generalised(tuple(path))
        inside.append((b, below))
        links[below] += 2 * b.links - len(b.text)
    listed = {p for p, n in links.items() if n > 0 and not set(re.split(r"[>.#]", p)) & {"p", *HEADINGS}}
    return "\n".join(b.text for b, below in inside if below not in listed)


def extract(source: str, winners: list[str]) -> tuple[str, str]:
    """Text and path: the first winning path that the page has, else its own best container."""
    page = Page(source)
    own = candidates(page)
    path = next((w for w in winners if w in own), None)
    if path is None:
        if not own:
            return "\n".join(b.text for b in page.blocks if not b.out), ""
        path = best_of(own)
    return text_at(page, path), path


# -- the passes -------------------------------------------------------------------------------------


def host() -> Column:
    """Host of the url in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def best_of(scores: dict[str, int]) -> str:
    return min(scores, key=lambda p: (-scores[p], p))


def votes(pages: DataFrame) -> DataFrame:
    """Votes per host and path; a page's vote is its best path's share of its scores, of one ``UNIT``."""

    def run(batches):
        for batch in batches:
            total: Counter = Counter()
            for piece in slices(batch, 200):
                for name, source in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    scores = candidates(Page(source))
                    if scores:
                        path = best_of(scores)
                        total[name, path] += UNIT * scores[path] // sum(scores.values())
            rows = [(h, p, n) for (h, p), n in total.items() if n]
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["host", "path", "votes"])

    return pages.select(host().alias("host"), "html").where("html <> ''").mapInArrow(run, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def winning(cast: DataFrame, share: float = SHARE) -> DataFrame:
    """Per host its winning paths, most voted first (ties by path); at most 1 / ``share`` of them."""
    total = cast.groupBy("host").agg(F.sum("votes").alias("total"))
    won = cast.join(total, "host").where(F.col("votes") >= F.lit(share) * F.col("total"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("order"), "path")))
    return won.groupBy("host").agg(ranked["path"].alias("winners"))


def main_text(pages: DataFrame, *, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_chars and the path the text was found at, for every row."""
    winners = winning(votes(pages), share)
    bytes_held = F.sum(F.octet_length("host") + F.aggregate("winners", F.lit(0), lambda n, p: n + F.octet_length(p) + 16))
    winners = checkpointed(winners)
    if (winners.agg(bytes_held.alias("b")).first()["b"] or 0) <= BROADCAST_BYTES:
        winners = F.broadcast(winners)  # counted; beyond it a join that adaptive execution splits at hot hosts
    named = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host")).join(winners, "host", "left")
    columns = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches):
        for batch in batches:
            for piece in slices(batch, 200):
                found = [extract(source, won or []) for source, won in zip(piece.column("html").to_pylist(), piece.column("winners").to_pylist(), strict=True)]
                texts = [f[0] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([f[1] for f in found], pa.string())],
                    names=["page_id", "url", "text", "n_chars", "path"],
                )

    return named.select("page_id", "url", "html", "winners").mapInArrow(run, f"{columns}, text string, n_chars long, path string")
