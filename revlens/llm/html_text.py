"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of styles: an element's style is the path of tags,
class names and ids above it (digits in names count alike). For every style node the table of
``site_styles`` holds how many pages have it, the entropy of its contents and of its layouts
over those pages (0 if all are equal, 1 if all differ), and how much of its text is in links.
Pages of a host that show the same texts in the same styles are counted once in all of this.
A node's importance is its weighted entropy, less for links. In each page the branches of low
importance on a host with enough pages are removed. A tag, role or name of chrome lowers a branch's
importance: one that is low by this alone, or not known of the host, goes unless it holds most of
the unlinked text. Reader comments differ from page to page as articles do, so importance doesn't keep
them. What is inside of an ``article`` or ``main`` element is the main text, if a page has one,
and a branch within it goes by importance only if it has a name of its own.

Blocks are the texts between block-level tags and line breaks; white space inside is one space,
empty blocks are left out, and blocks are joined by a line feed in page order.

NULL or empty html, and html without text, give an empty text. A NULL url is a host of its own.
Rows that repeat are kept, but count as one page of their host. Broken markup is read as far as it goes: elements
that are never closed end with the element around them. Only the id, url and html columns are
read, and all rows are kept. Style rows of hosts are joined by host and a salt, so that a host
with very many pages is spread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.frames import batch_of, chunks
from revlens.llm.store import Workspace

LEAST_IMPORTANCE = 0.25
LEAST_PAGES = 8
LAYOUT_WEIGHT = 0.2
CHROME_WEIGHT = 0.5
SALTS = 32
BROADCAST_STYLES = 300_000  # of at most 60 bytes each

# Tags by what they do to the text around them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("script style noscript template iframe object embed svg canvas audio video map title head".split())
CONTROLS = frozenset("button select textarea input label datalist".split())
CHROME = frozenset("nav aside footer form menu fieldset dialog search".split())
CLOSES_P = BLOCK - frozenset("br body html head option optgroup td th tr tbody thead tfoot caption title legend summary".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html div section article main aside nav td th select".split())
CHROME_WORDS = frozenset(
    "menu nav navbar navigation navi footer sidebar side notice cookie cookies consent gdpr banner ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion popup modal newsletter subscribe subscription social share sharing breadcrumb breadcrumbs "
    "pagination pager related recommended recommendations widget toolbar comment comments respond disqus reply replies login signin signup "
    "register search skip copyright legal disclaimer masthead topbar alert overlay paywall adsense adsbygoogle outbrain taboola".split()
)
HEADER_WORDS = frozenset("header head top topnav".split())
COMMENT_WORDS = frozenset("comment comments respond disqus reply replies".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
SPACES = re.compile(r"\s+")
NAME_PART = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

ROOT = 0x243F6A8885A308D3
PRIME, MASK = 0x100000001B3, (1 << 64) - 1
_STYLES: dict[tuple, int] = {}


def _style(parent: int, name: str) -> int:
    key = (parent, name)
    found = _STYLES.get(key)
    if found is None:
        if len(_STYLES) > 100_000:
            _STYLES.clear()
        found = _STYLES[key] = xxhash.xxh3_64_intdigest(parent.to_bytes(8, "little") + name.encode())
    return found


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Page(HTMLParser):
    """The elements of a page as lists, and its text pieces in order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.style, self.words, self.role, self.named = [-1], ["#root"], [ROOT], [frozenset()], [""], [False]
        self.pieces: list[tuple[int, str | None]] = []  # (element, text), or None where a block ends
        self.open = [0]
        self.depths: dict[str, list[int]] = {}  # where in ``open`` the elements of a tag are
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._end({"p"}, SCOPES)
        if tag in ENDS:
            self._end(ENDS[tag], frozenset("ul ol dl table select body".split()) if tag in ("li", "dt", "dd", "option") else frozenset({"table"}))
        if tag in BLOCK:
            self.pieces.append((0, None))
        if tag == "br":
            return
        given = dict(attrs)
        name = f"{given.get('class') or ''} {given.get('id') or ''}".strip()
        words = frozenset(NAME_PART.findall(CAMEL.sub(" ", name).lower())) if name else frozenset()
        at = self.open[-1]
        self.parent.append(at)
        self.tag.append(tag)
        self.style.append(_style(self.style[at], f"{tag} {DIGITS.sub('#', name)}"))
        self.words.append(words)
        self.role.append((given.get("role") or "").lower())
        self.named.append(bool(name))
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(len(self.tag) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.pieces.append((0, None))
        if self.depths.get(tag):
            self._cut(self.depths[tag][-1])

    def _cut(self, depth: int) -> None:
        """Close the open elements from ``depth`` on."""
        for i in self.open[depth:]:
            self.depths[self.tag[i]].pop()
        del self.open[depth:]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.tag[self.open[-1]] == tag:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        self.pieces.append((self.open[-1], data))

    def _end(self, tags: set[str], scopes: frozenset[str]) -> None:
        """Close the nearest open element of ``tags``, unless one of ``scopes`` is in between."""
        nearest = max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)
        if nearest and all(self.depths[t][-1] <= nearest for t in scopes if self.depths.get(t)):
            self._cut(nearest)

    def _chrome(self, i: int) -> bool:
        """Whether an element's tag, role or name is one of chrome."""
        tag, words = self.tag[i], self.words[i]
        named = tag in CHROME or self.role[i] in ROLES or words & CHROME_WORDS or tag == "header" or words & HEADER_WORDS
        return bool(named) and tag not in ("html", "body")

    def styles(self) -> Iterator[tuple[int, int, int, int, int, int, bool]]:
        """(style, content, layout, characters, characters in links, page, chrome) of each style with text.

        ``page`` is a digest of all texts and their styles.
        """
        n, page = len(self.tag), 0
        layout, in_link, hidden = [0] * n, [False] * n, [False] * n
        for i in range(1, n):
            at = self.parent[i]
            in_link[i] = in_link[at] or self.tag[i] == "a"
            hidden[i] = hidden[at] or self.tag[i] in HIDDEN
            layout[at] = (layout[at] * PRIME + self.style[i]) & MASK
        # The texts of an element and of those in it stand side by side, so sums up to each text do.
        codes, sizes, links, powers = [0], [0], [0], [1]
        low, high = [len(self.pieces)] * n, [0] * n
        for i, text in self.pieces:
            if text is None or hidden[i]:
                continue
            text = text.strip()
            if text:
                code = xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))
                page = (page * PRIME + (code ^ self.style[i])) & MASK
                low[i], high[i] = min(low[i], len(codes) - 1), len(codes)
                codes.append((codes[-1] * PRIME + code) & MASK)
                powers.append((powers[-1] * PRIME) & MASK)
                sizes.append(sizes[-1] + len(text))
                links.append(links[-1] + (len(text) if in_link[i] else 0))
        for i in range(n - 1, 0, -1):
            at = self.parent[i]
            low[at], high[at] = min(low[at], low[i]), max(high[at], high[i])
        content, chars, linked = [0] * n, [0] * n, [0] * n
        for i, (a, b) in enumerate(zip(low, high)):
            if a < b:
                content[i] = (codes[b] - codes[a] * powers[b - a]) & MASK
                chars[i], linked[i] = sizes[b] - sizes[a], links[b] - links[a]
        merged: dict[int, list[int]] = {}
        for i in range(1, n):
            if chars[i] and (self.tag[i] in BLOCK or self._chrome(i)):
                held = merged.setdefault(self.style[i], [0, 0, 0, 0, False])
                held[0] = (held[0] * 31 + content[i]) & 0xFFFFFFFFFFFFFFFF
                held[1] = (held[1] * 31 + layout[i] + 1) & 0xFFFFFFFFFFFFFFFF
                held[2] += chars[i]
                held[3] += linked[i]
                held[4] = held[4] or self._chrome(i)
        for style, (a, b, c, d, chrome) in merged.items():
            yield signed(style), signed(a), signed(b), c, d, signed(page), chrome

    def _regions(self) -> tuple[list[bool], bool]:
        """(elements inside of an article or main element that isn't in a comment, whether any has text)"""
        n, most = len(self.tag), self._most([True] * len(self.tag))
        inside, comment = [False] * n, [False] * n
        for i in range(1, n):
            at = self.parent[i]
            comment[i] = comment[at] or (self.tag[i] not in ("html", "body") and bool(self.words[i] & COMMENT_WORDS) and not most[i])
            top = self.tag[i] in ("article", "main") or self.role[i] == "main"
            inside[i] = inside[at] or (top and not comment[i])
        return inside, any(text and inside[i] and not text.isspace() for i, text in self.pieces if text)

    def _most(self, chosen: list[bool]) -> list[bool]:
        """Whether an element holds most of the unlinked text of the chosen elements."""
        n = len(self.tag)
        out, chars = [False] * n, [0] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] or self.tag[i] == "a" or self.tag[i] in HIDDEN or self.tag[i] in CONTROLS
        for i, text in self.pieces:
            if text and chosen[i] and not out[i]:
                chars[i] += len(text.strip())
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        return [2 * c > chars[0] for c in chars]

    def text(self, unimportant: frozenset[int], important: frozenset[int] = frozenset()) -> str:
        """The main text. ``important`` are the styles of chrome that are kept all the same."""
        inside, has_main = self._regions()
        n = len(self.tag)
        most = self._most(inside if has_main else [True] * n)
        holds = [False] * n  # elements around the main text are never chrome
        for i in range(n - 1, 0, -1):
            holds[self.parent[i]] = holds[self.parent[i]] or inside[i] or holds[i]
        gone = [False] * n
        for i in range(1, n):
            at, tag, style = self.parent[i], self.tag[i], signed(self.style[i])
            if gone[at] or tag in HIDDEN or tag in CONTROLS:
                gone[i] = True
            elif tag in ("html", "body") or (holds[i] and not inside[i]) or (inside[i] and not inside[at]):
                continue
            elif style in unimportant and (self.named[i] or not inside[i]):
                gone[i] = True
            elif self._chrome(i) and not most[i] and (style not in important or self.words[i] & COMMENT_WORDS):
                gone[i] = not inside[i] or tag in CHROME or self.role[i] in ROLES or bool(self.words[i] & CHROME_WORDS)
        blocks, now = [], []
        for i, text in self.pieces:
            if text is not None and not gone[i] and (inside[i] or not has_main):
                now.append(text)
            elif text is None and now:
                blocks.append("".join(now))
                now = []
        blocks.append("".join(now))
        clean = (SPACES.sub(" ", b).strip() for b in blocks)
        return "\n".join(b for b in clean if b)


def _host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def site_styles(pages: DataFrame) -> DataFrame:
    """(host, style, pages, importance, chrome) from columns host, html; counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            out = [[], [], [], [], [], [], [], []]
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for row in Page(html).styles() if html else ():
                    for column, value in zip(out, (host, *row)):
                        column.append(value)
            yield batch_of(["host", "style", "content", "layout", "chars", "linked", "page", "chrome"], out, [pa.string()] + [pa.int64()] * 6 + [pa.bool_()])

    schema = "host string, style bigint, content bigint, layout bigint, chars bigint, linked bigint, page bigint, chrome boolean"
    rows = pages.select("host", "html").mapInArrow(run, schema)
    own = rows.groupBy("host", "style", "content", "layout", "page").agg(F.max("chars").alias("chars"), F.max("linked").alias("linked"), F.max("chrome").alias("chrome"))
    # Of a node's (content, layout) counts, first by content, then over all contents.
    by_layout = F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("layouts")
    by_content = F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("contents")
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("content").alias("code")), F.struct(F.lit(1).alias("kind"), F.col("layout").alias("code"))))
    counted = (
        own.select("host", "style", "chars", "linked", "chrome", kinds.alias("k"))
        .groupBy("host", "style", "k.kind", "k.code")
        .agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.max("chrome").alias("chrome"))
    )
    nodes = counted.groupBy("host", "style").agg(
        (F.sum("n") / 2).cast("bigint").alias("pages"), by_content, by_layout, (F.sum("linked") / F.sum("chars")).alias("link_share"), F.max("chrome").alias("chrome")
    )
    entropy = lambda sums: F.when(F.col("pages") > 1, 1 - F.col(sums) / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    importance = ((1 - LAYOUT_WEIGHT) * entropy("contents") + LAYOUT_WEIGHT * entropy("layouts")) * (1 - F.col("link_share"))
    return nodes.select("host", "style", "pages", importance.alias("importance"), "chrome")


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    space = Workspace(pages.sparkSession)
    rows = pages.select(F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    rows = rows.withColumn("host", _host())
    low = (F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE)
    high = F.col("chrome") & (F.col("pages") > 1) & (F.col("importance") * CHROME_WEIGHT >= LEAST_IMPORTANCE)
    known = site_styles(rows).where(low | high).withColumn("kept", high)
    known = space.put(known.select("host", "style", "kept"))
    of = lambda kept: F.collect_list(F.when(F.col("kept") == kept, F.col("style")))
    by_host = known.groupBy("host").agg(of(False).alias("styles"), of(True).alias("important"))
    if known.count() <= BROADCAST_STYLES:
        met = rows.join(F.broadcast(by_host), "host", "left")
    else:
        salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2):
            given = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
            texts = [Page(html).text(frozenset(low or ()), frozenset(high or ())) if html else "" for html, low, high in given]
            yield batch_of(["page_id", "url", "text"], [batch.column(0), batch.column(1), texts], [pa.int64(), pa.string(), pa.string()])

    return met.select("page_id", "url", "html", "styles", "important").mapInArrow(run, "page_id bigint, url string, text string")

