"""Main text of web pages by tree scoring.

A page becomes a list of elements and a list of text blocks. What is boilerplate by
its tag or role is cut first; names of class and id only mark candidates, which stay if
their prose speaks for them. Then each paragraph passes points for its
length and its commas to its ancestors, less with every level, and a
container's points are discounted by the share of its text inside links. The best
container is kept, with siblings that score well or read like paragraphs; inside an
``article`` or ``main`` the whole of it is the container.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pricewright.llm.ship import shipped

# Element and class names of web pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
CUT = frozenset("nav header footer aside form head button select dialog menu svg canvas audio video object".split()) | RAW
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
    pre section summary table tbody td tfoot th thead tr ul""".split()) | CUT
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPE = frozenset("ul ol dl table tr select div section article main body td th blockquote".split())
BOILERPLATE = frozenset("""ad ads adsense adv advert advertisement adverts advertising adsbygoogle alert banner breadcrumb
    breadcrumbs comment commentform commentlist comments consent cookie cookies copyright disclaimer disqus footer gdpr
    header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay
    pager pagination popup promo promotion promoted recommendations recommended related replies reply respond search
    share sharing sidebar sidenav signup skip social sponsor sponsored subscribe taboola toolbar topbar topnav widget""".split())
#: Parts that say nothing of the content; a name of other parts beside a boilerplate one may mean something else.
FRAME = frozenset("""above after area article articles bar before below block blog body bottom box button buttons col
    column component container content desktop email entry field fixed form global group heading icon icons id inner
    item items js left link links list lower main mobile module news outer page panel post posts primary region right
    row secondary section site sticky stories story sub text thread title top upper widgets wp wrap wrapper""".split())
CONTENT = frozenset("article body content entry main page post story text".split())
NEGATING = frozenset("has hide no not with without".split())
ADVERT = frozenset("""ad ads adsense adv advert advertisement adverts advertising adsbygoogle outbrain promo promoted
    promotion sponsor sponsored taboola""".split())
ARTICLE_MARKS = frozenset("comment comments reply ad related promo".split())
ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
    toolbar""".split())

CONTAINERS = frozenset("div section article main body td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PLAIN = frozenset("p blockquote pre".split())
LISTS = frozenset("ul ol div section table".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:"[^"]*"|'[^']*'|[^<>"'])*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>""",
    re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Paragraphs shorter than this pass no points; containers with more of their text in links are menus.
SHORT, MENU = 25, 0.5
#: Prose has fewer characters in links than this; a named candidate needs this much of it, and so many times the rest's.
PROSE, BULK, TIMES = 0.25, 250, 5
#: Why an element may be boilerplate: a name that may mean something else, a plain name, or tag, role or style.
DOUBTED, NAMED, SURE = 1, 2, 3


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _names(found: dict[str, str]) -> list[set[str]]:
    """The parts of each name of class and id."""
    return [set(_NAME.findall(_HUMP.sub(" ", name).lower()))
            for name in f"{found.get('class', '')} {found.get('id', '')}".split()]


def _doubt(tag: str, raw: str) -> int:
    if tag in CUT:
        return SURE
    if not raw or tag in ("html", "body"):
        return 0
    found = _attributes(raw)
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")):
        return SURE
    if found.get("role", "").lower() in ROLES:
        return SURE
    if tag == "main":
        return 0
    names = _names(found)
    if tag != "article" and any(len(parts) == 1 and parts <= CONTENT for parts in names):
        return 0
    marks = ARTICLE_MARKS if tag == "article" else BOILERPLATE
    marked = [parts for parts in names if not marks.isdisjoint(parts) and NEGATING.isdisjoint(parts)]
    if any(parts <= BOILERPLATE | FRAME for parts in marked):
        return NAMED
    return DOUBTED if marked and tag in BLOCK else 0


class Page:
    """Elements as parallel lists (tag, parent, why it may be boilerplate) and blocks of (element, text, characters in links)."""

    def __init__(self, source: str):
        self.tags, self.parents, self.cut = ["#page"], [-1], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._open, self._text, self._linked, self._muted = [0], [], 0, 0
        self._named = Counter()  # open elements by tag
        self._parse(source)

    def _flush(self) -> None:
        if self._text:
            text = _SPACE.sub(" ", "".join(self._text)).strip()
            if text:
                owner = next((e for e in reversed(self._open) if self.tags[e] in BLOCK or not e))
                self.blocks.append((owner, text, min(self._linked, len(text))))
        self._text, self._linked = [], 0

    def _say(self, text: str) -> None:
        if text and not self._muted:
            text = html.unescape(text)
            self._text.append(text)
            if any(self.tags[e] == "a" for e in self._open[-4:]):
                self._linked += len(text.strip())

    def _close(self, keep: int) -> None:
        if any(self.tags[e] in BLOCK for e in self._open[keep:]):
            self._flush()
        self._muted -= sum(self._is_muted(e) for e in self._open[keep:])
        self._named.subtract(self.tags[e] for e in self._open[keep:])
        del self._open[keep:]

    def _is_muted(self, e: int) -> bool:
        """Boilerplate inside a line: its text is left out and does not end the block."""
        return bool(self.cut[e]) and self.tags[e] not in BLOCK

    def _start(self, tag: str, raw: str) -> None:
        if tag == "br":
            self._text.append(" ")
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag in BLOCK:
            self._flush()
            for k in range(len(self._open) - 1, 0, -1):
                other = self.tags[self._open[k]]
                if other == "p" or other in CLOSED_BY.get(tag, ()):
                    self._close(k)
                    break
                if other in SCOPE:
                    break
        above = self._open[-1]
        self.tags.append(tag)
        self.parents.append(above)
        doubt = _doubt(tag, raw)
        if doubt in (DOUBTED, NAMED) and tag not in BLOCK and any(not t.isspace() for t in self._text):
            # a sentence goes on: only an advert's name on a few words of it says anything
            doubt = NAMED if not ADVERT.isdisjoint(set().union(*_names(_attributes(raw)))) else 0
        self.cut.append(doubt)
        self._open.append(len(self.tags) - 1)
        self._named[tag] += 1
        self._muted += self._is_muted(len(self.tags) - 1)

    def _end(self, tag: str) -> None:
        if not self._named[tag]:
            return
        for k in range(len(self._open) - 1, 0, -1):
            if self.tags[self._open[k]] == tag:
                self._close(k)
                return

    def _parse(self, source: str) -> None:
        at, last = 0, source.rfind(">") + 1  # nothing behind the last ">" can be a tag
        while found := _TOKEN.search(source, at, last):
            self._say(source[at:found.start()])
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:
                self._end(tag)
                continue
            raw = found[3] or found[6] or ""
            self._start(tag, raw)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at, last)
                at = end.end() if end else len(source)
                self._end(tag)
        self._say(source[at:])
        self._flush()


def _spared(page: Page) -> set[int]:
    """Candidates that stay: doubted ones with prose, named ones that hold nearly all prose of the page."""
    if not any(c in (DOUBTED, NAMED) for c in page.cut):
        return set()
    size, linked, prose = ([0] * len(page.tags) for _ in range(3))
    for owner, text, in_links in page.blocks:
        size[owner] += len(text)
        linked[owner] += in_links
        prose[owner] += len(text) if len(text) >= SHORT else 0
    for e in range(len(page.tags) - 1, 0, -1):  # children come after their parents
        if page.cut[e] < NAMED:
            for sums in (size, linked, prose):
                sums[page.parents[e]] += sums[e]
    told = any(t in ("article", "main") and not c for t, c in zip(page.tags, page.cut))
    out = set()
    for e in range(len(page.tags)):
        if prose[e] and linked[e] < PROSE * size[e]:
            bulk = prose[e] >= BULK and prose[e] > TIMES * prose[0] and not told and page.tags[e] != "article"
            if page.cut[e] == DOUBTED or page.cut[e] == NAMED and bulk:
                out.add(e)
    return out


def _visible(page: Page) -> list[bool]:
    """Elements outside boilerplate; a boilerplate class on what holds an article or main does not count."""
    holds, spared = set(), _spared(page)
    for e, tag in enumerate(page.tags):
        if tag in ("article", "main") and not page.cut[e]:
            k = page.parents[e]
            while k > 0 and k not in holds:
                holds.add(k)
                k = page.parents[k]
    out = []
    for e, tag in enumerate(page.tags):
        # some pages are one form as a whole
        own = not page.cut[e] or e in spared or (e in holds and (tag not in CUT or tag == "form"))
        out.append(own and (page.parents[e] < 0 or out[page.parents[e]]))
    return out


def main_text(source: str | None) -> str:
    """Blocks of the main container, one per line; empty if there is no text."""
    if not source:
        return ""
    page = Page(source)
    shown = _visible(page)
    blocks = [b for b in page.blocks if shown[b[0]]]
    if not blocks:
        return ""
    total = len(page.tags)
    points, size, linked, passed = [0.0] * total, [0] * total, [0] * total, [0.0] * total
    for owner, text, in_links in blocks:
        size[owner] += len(text)
        linked[owner] += in_links
        if len(text) >= SHORT:
            container = owner if page.tags[owner] in CONTAINERS else max(page.parents[owner], 0)
            passed[container] += 1 + text.count(",") + min(len(text) / 100, 3)
    for e in range(total - 1, -1, -1):  # children come after their parents: one pass sums up the tree
        points[e] += passed[e]
        if e:
            above = page.parents[e]
            size[above] += size[e]
            linked[above] += linked[e]
            passed[above] += passed[e] / 2  # half of what it got, own paragraphs and lower levels' shares alike
    filled = [e for e in range(total) if size[e]]
    density = {e: linked[e] / size[e] for e in filled}
    score = {e: (points[e] + (25 if page.tags[e] in ("article", "main") else 0)) * (1 - density[e])
             for e in filled if points[e]}
    articles = [e for e in filled if page.tags[e] in ("article", "main")]
    if score:
        best = max(score, key=lambda e: (score[e], -e))
    else:
        best = max(articles, key=lambda e: (size[e], -e), default=0)
    up = best
    while up >= 0:
        if page.tags[up] in ("article", "main"):
            best = up
            break
        up = page.parents[up]
    whole = page.tags[best] in ("article", "main")
    kept = {best}
    if page.tags[best] not in ("main", "body", "html", "#page"):
        bar = max(10.0, 0.2 * score.get(best, 0.0))
        above = {page.parents[best]}
        while (up := page.parents[max(above)] if max(above) > 0 else -1) >= 0 and up not in above and not whole:
            above = above | {up}
            if up == 0:
                break
        for e in filled:
            if e == best or page.parents[e] not in above:
                continue
            sibling = page.parents[e] == page.parents[best]
            if page.tags[e] in HEADINGS:
                # a headline stands above its text, beside it or beside what holds it
                keep = not whole and density[e] < PROSE and (sibling or e < best)
            elif page.tags[e] in PLAIN:
                keep = sibling and density[e] < PROSE and (not whole or size[e] > 80)
            else:
                keep = sibling and score.get(e, 0.0) >= bar
            if keep:
                kept.add(e)
    first = min((k for k, (owner, text, _) in enumerate(blocks) if len(text) >= SHORT and density[owner] < PROSE), default=0)
    # from the top: inside a kept element or not, inside a list of links that stands before all prose or not
    inside, menu, lines = [False] * total, [False] * total, []
    for e in range(total):
        up = page.parents[e]
        inside[e] = e in kept or (up >= 0 and inside[up])
        if e not in kept and up >= 0:
            menu[e] = menu[up] or (not whole and page.tags[e] in LISTS and density.get(e, 0.0) > MENU)
    for k, (owner, text, _) in enumerate(blocks):
        if inside[owner] and not (menu[owner] and k < first):
            lines.append(text)
    return "\n".join(lines)


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column(batch.schema.names.index("__html")).to_pylist()]
        keep = [k for k, n in enumerate(batch.schema.names) if n != "__html"]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())],
                                         [*(batch.schema.names[k] for k in keep), "__text"])


def extracted(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: id, url, ``text, n_chars`` (code points).

    Character references are decoded once, white space inside a block is one space,
    blocks are trimmed and joined by line breaks in page order. Null and empty pages, and
    pages of boilerplate only, give an empty text. Markup that is never closed ends with the
    page. Each row stands alone: repeated rows and null ids are carried along, an
    empty table gives no rows, other columns are not looked at.
    """
    shipped(pages.sparkSession)
    frame = pages.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url_col}`").alias("__url"),
                         F.col(f"`{html_col}`").alias("__html"))
    fields = [f for f in frame.schema.fields if f.name != "__html"]
    done = frame.mapInArrow(_extract, T.StructType([*fields, T.StructField("__text", T.StringType())]))
    return done.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), F.col("__text").alias("text"),
                       F.length("__text").cast("long").alias("n_chars"))
