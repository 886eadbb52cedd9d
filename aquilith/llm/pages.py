"""Main text of web pages by paths that the pages of a host agree on.

Every page is read into its elements and text blocks, without the elements that
hold no article text by their tag, role, or a word of their class or id. The others'
containers are scored: text beside links counts for its container, half for the
one above, a quarter for the next, more where tag or class name an article. A
page deals 1000 points to its containers' generalised paths (tags and classes from the body
down, numbers as #), Spark sums them by host, and the paths with a twentieth of
a host's points or more, at most 20, are its winners. Each page is then read again and
gives the text of the elements on its host's best path, or of its own best
container where that holds more than twice as much.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, hot_keys, lean, small, spread_join

# Tag and class names by what they say of an element.
#: Elements whose content is no text of a page; it is skipped to the end tag.
RAW = frozenset("script style title textarea noscript template svg iframe object math select xmp noframes".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end a block of text and stand on the stack of open elements.
BLOCKS = frozenset(
    "html head body main article section div header footer nav aside form fieldset dialog menu p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption details summary address center button hgroup search".split()
)
#: Those of them that can hold an article.
CONTAINERS = frozenset("body main article section div td center".split())
#: Those that never hold text of one.
OUTSIDE = frozenset("head nav footer aside form dialog menu button search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Start tags that close an open element of the other names, up to a container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
LIMITS = frozenset("ul ol dl table div section article main body td blockquote".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of classes and ids of menus, headers, footers, sidebars, notices, adverts, forms and comments.
OUTSIDE_WORDS = frozenset(
    """nav navbar navigation menu menus menubar breadcrumb breadcrumbs crumbs pagination pager paging toc skip skiplink toolbar
    footer foot colophon copyright legal
    sidebar sidebars aside rail sidenav widget widgets related recommended recommendations popular trending teaser teasers
    notice notices notification notifications alert alerts announcement cookie cookies consent gdpr banner banners popup modal overlay lightbox toast paywall
    ad ads adv advert adverts advertisement advertising adslot adbox adunit adsense sponsor sponsored promo promotion taboola outbrain
    form login signin signup register newsletter subscribe subscription search share sharing social follow
    comment comments commentlist reply replies respond responses disqus discussion hidden invisible""".split()
)
HEADER_WORDS = frozenset("header masthead topbar branding logo".split())
ARTICLE_WORDS = frozenset("article content main post entry story body text blog news".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"[0-9]+")
_HOST = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)")


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


class Page:
    """Elements and text blocks of a page; broken markup is read as browsers do, roughly."""

    def __init__(self, html: str):
        self.tag, self.parent, self.path, self.out, self.weight = ["body"], [-1], [xxhash.xxh64_intdigest("body")], [False], [1.0]
        #: (text, characters outside links, element, whether a heading)
        self.blocks: list[tuple[str, int, int, bool]] = []
        self._named: list[int] = []  # elements that only a class or id puts outside
        self._read(html)
        self._settle()

    def _read(self, html: str) -> None:
        stack, buffer, links, in_link = [0], [], 0, False
        at, n = 0, len(html)
        no_more = {'"': n + 1, "'": n + 1}

        def flush() -> None:
            nonlocal links, in_link
            if buffer:
                text = " ".join(unescape("".join(buffer)).split())
                if text:
                    self.blocks.append((text, max(len(text) - links, 0), stack[-1], any(self.tag[e] in HEADINGS for e in stack[-2:])))
                buffer.clear()
            links, in_link = 0, False

        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                buffer.append(html[at:lt])
                if in_link:
                    links += lt - at
            if lt == n:
                break
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            if html.startswith(("<!", "<?"), lt):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            closing = html.startswith("</", lt)
            name = _NAME.match(html, lt + 1 + closing)
            if not name:
                buffer.append("<")
                at = lt + 1
                continue
            tag = name[0].lower()
            end = self._end_of_tag(html, name.end(), no_more)
            attributes, at = html[name.end() : end], end + 1
            if tag in RAW and not closing:
                if tag not in ("title", "script", "style"):
                    buffer.append(" ")
                if not attributes.endswith("/") or tag in ("script", "style", "title", "textarea"):
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                    at = close.end() if close else n
            elif tag == "br":
                buffer.append(" ")
            elif tag == "hr":
                flush()
            elif tag == "a":
                in_link = not closing
            elif tag in BLOCKS:
                flush()
                if closing:
                    self._close(stack, tag)
                else:
                    self._open(stack, tag, attributes)
        flush()

    @staticmethod
    def _end_of_tag(html: str, at: int, no_more: dict[str, int]) -> int:
        """Where the tag's > stands, beyond quoted values; an open quote that never closes quotes nothing."""
        while True:
            gt = html.find(">", at)
            if gt < 0:
                return len(html)
            quote = min((q for q in (html.find('="', at, gt), html.find("='", at, gt)) if q >= 0), default=-1)
            if quote < 0:
                return gt
            mark = html[quote + 1]
            close = -1 if quote + 2 > no_more[mark] else html.find(mark, quote + 2)
            if close < 0:
                no_more[mark] = min(no_more[mark], quote + 1)
                return gt
            at = close + 1

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            while self.tag[stack[-1]] == "head":
                stack.pop()
            return
        if self.tag[stack[-1]] == "head":
            stack.pop()
        ends = CLOSES.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            open_tag = self.tag[stack[i]]
            if open_tag == "p" or (open_tag in HEADINGS and tag in HEADINGS):
                del stack[i:]
            elif open_tag in ends:
                del stack[i:]
            elif open_tag in LIMITS or not ends:
                break
        above = stack[-1]
        stack.append(len(self.tag))
        names, role = [], ""
        if attributes:
            for k, a, b, c in _ATTRIBUTE.findall(attributes):
                k = k.lower()
                if k == "class" or k == "id":
                    names.append((k, unescape(a or b or c).split()))
                elif k == "role":
                    role = (a or b or c).strip().lower()
        classes = [x for k, v in names if k == "class" for x in v]
        words = {w.lower() for _, v in names for x in v if not x.lower().startswith(("has-", "with-", "no-", "is-")) for w in _WORD.findall(x)}
        in_article = any(self.tag[e] in ("article", "main") for e in stack[:-1])
        header = tag == "header" or role == "banner" or (bool(words & HEADER_WORDS) and tag not in ("article", "main") and not (tag in HEADINGS))
        hard = tag in OUTSIDE or (role in OUTSIDE_ROLES and tag != "main") or bool(attributes and _HIDDEN.search(attributes))
        named = tag != "main" and bool(words & OUTSIDE_WORDS)
        number = stack[-1]
        self.tag.append("site-header" if header and not in_article else "header" if header else tag)
        self.parent.append(above)
        self.path.append(xxhash.xxh64_intdigest(f"{self.path[above]}/{tag}.{'.'.join(sorted({_DIGITS.sub('#', x) for x in classes}))}"))
        self.out.append(hard or (header and not in_article))
        self.weight.append(2.5 if tag in ("article", "main") or role == "main" else 1.3 if words & ARTICLE_WORDS else 1.0)
        if named and not self.out[number]:
            self._named.append(number)

    def _close(self, stack: list[int], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            here = self.tag[stack[i]]
            if here == tag or (tag == "header" and here == "site-header") or (here in ("header", "site-header") and tag == "div"):
                del stack[i:]
                return
            if here in CONTAINERS and tag not in CONTAINERS and tag not in OUTSIDE | {"header", "ul", "ol", "table", "fieldset"}:
                return  # an end tag of something small does not close a container

    def _settle(self) -> None:
        """Passes on what is outside, and finds the container of every block."""
        wraps = [False] * len(self.tag)
        named = set(self._named)
        for e in range(len(self.tag) - 1, 0, -1):
            if wraps[e] or (self.tag[e] in ("article", "main") and e not in named and not self.out[e]):
                wraps[self.parent[e]] = True
        for e in range(1, len(self.tag)):
            self.out[e] |= self.out[self.parent[e]] or (e in named and not wraps[e])
        self.box = [0] * len(self.tag)
        in_header = [False] * len(self.tag)
        for e in range(1, len(self.tag)):
            self.box[e] = e if self.tag[e] in CONTAINERS else self.box[self.parent[e]]
            in_header[e] = self.tag[e] == "header" or in_header[self.parent[e]]
        self.blocks = [b for b in self.blocks if not self.out[b[2]] and (b[3] or not in_header[b[2]])]

    def scores(self) -> dict[int, float]:
        """Containers with a score above 0."""
        own: Counter = Counter()
        for text, plain, e, _ in self.blocks:
            own[self.box[e]] += plain * plain / len(text)
        total: Counter = Counter()
        for e, v in own.items():
            for _ in range(3):
                total[e] += v * self.weight[e]
                if e == 0:
                    break
                e, v = self.box[self.parent[e]], v / 2
        return {e: v for e, v in total.items() if v > 0}

    def points(self) -> dict[int, int]:
        """1000 points over the paths of the scored containers, by the square of their scores."""
        scores = self.scores()
        best: dict[int, float] = {}
        for e, v in scores.items():
            best[self.path[e]] = max(best.get(self.path[e], 0), v)
        squares = sum(v * v for v in best.values())
        return {p: n for p, v in best.items() if (n := int(1000 * v * v / squares))}

    def text(self, winners: list[int]) -> tuple[str, bool]:
        """The main text, and whether a path of the host gave it."""
        scores = self.scores()
        if not scores:
            return "\n".join(b[0] for b in self.blocks), False
        own = max(scores, key=lambda e: (scores[e], -e))
        chosen, by_host = {own}, False
        for w in winners:
            here = {e for e in scores if self.path[e] == w}
            if here and 2 * max(scores[e] for e in here) >= scores[own]:
                chosen, by_host = here, True
                break
        inside = [False] * len(self.tag)
        for e in range(len(self.tag)):
            inside[e] = e in chosen or (e > 0 and inside[self.parent[e]])
        kept = [inside[b[2]] for b in self.blocks]
        self._title(chosen, kept)
        return "\n".join(b[0] for b, k in zip(self.blocks, kept, strict=True) if k), by_host

    def _title(self, chosen: set[int], kept: list[bool]) -> None:
        """Takes in the last h1 ahead of the text that stands right in one of its ancestors, if the text has none."""
        first = kept.index(True) if True in kept else 0
        above, e = set(), min(chosen)
        while e > 0:
            e = self.parent[e]
            above.add(e)
        if any(k and self.tag[b[2]] == "h1" for b, k in zip(self.blocks, kept, strict=True)):
            return
        for i in range(first - 1, -1, -1):
            e = self.blocks[i][2]
            if self.tag[e] == "h1" and self.parent[e] in above:
                kept[i] = True
                return


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@lean()
def _votes(batches):
    """Points of (host, path), summed for each slice."""
    for b in small(batches, 1, 2_000_000):
        points, pages = Counter(), Counter()
        for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            host = host_of(url)
            if host and html:
                for path, n in Page(html).points().items():
                    points[host, path] += n
                    pages[host, path] += 1
        keys = list(points)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([_signed(k[1]) for k in keys], pa.int64()), pa.array([points[k] for k in keys], pa.int64()), pa.array([pages[k] for k in keys], pa.int64())],
            ["host", "path", "points", "pages"],
        )


@lean()
def _texts(batches):
    for b in small(batches, 2, 2_000_000):
        texts, voted = [], []
        for html, winners in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            text, by_host = Page(html).text([w & (1 << 64) - 1 for w in winners or ()]) if html else ("", False)
            texts.append(text)
            voted.append(by_host)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(voted)],
            ["id", "url", "text", "n_chars", "by_host"],
        )


def host_paths(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, points, pages, rank): the paths with a twentieth of their host's points or more, best first.

    Pages without a host or html cast no vote. Ties go to the path with more
    pages, then the smaller number. A host's repeated pages vote as often as they occur;
    other columns are ignored; an empty table has no paths.
    """
    votes = pages.select(F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")).mapInArrow(_votes, "host string, path long, points long, pages long")
    paths = votes.groupBy("host", "path").agg(F.sum("points").alias("points"), F.sum("pages").alias("pages"))
    of_host = Window.partitionBy("host")
    # at most 20 paths of a host pass, so that the ranking sorts few
    passed = paths.withColumn("all", F.sum("points").over(of_host)).filter(F.col("points") * 20 >= F.col("all")).drop("all")
    return passed.withColumn("rank", F.row_number().over(of_host.orderBy(F.desc("points"), F.desc("pages"), "path")))


#: Hosts whose winning paths are broadcast: 20 paths and a name each are under 300 bytes.
BROADCAST_HOSTS = 100_000


def extract(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    broadcast_hosts: int = BROADCAST_HOSTS,
) -> DataFrame:
    """(id, url, text, n_chars, by_host) for every row of ``pages``: the main text, a block a line.

    Character references are decoded, white space in a block is one space. A null or
    empty html, and one without article text, gives an empty text. A page without a host
    in its url gives its own best container. Whole pages are read, however long; repeated
    rows come back repeated; ties between containers go to the first. ``by_host`` says
    that a path of the host was used. Other columns are ignored; an empty table gives
    an empty one.
    """
    work = Workspace(pages.sparkSession, "pages")
    url = F.col(f"`{url_col}`").cast("string")
    narrow = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    id_type = narrow.schema["id"].dataType.simpleString()
    paths = host_paths(narrow)
    winners = work.put(paths.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path")))["path"].alias("winners")))
    host = F.lower(F.nullif(F.regexp_extract("url", _HOST.pattern, 1), F.lit("")))
    hosted = narrow.withColumn("host", host)
    if winners.count() <= broadcast_hosts:
        met = hosted.join(F.broadcast(winners), "host", "left")
    else:
        named = hosted.filter("host is not null")
        counts = work.put(named.groupBy("host").agg(F.count("*").alias("rows")))
        every = counts.join(winners, "host", "left").select("host", "winners")
        met = spread_join(named, every, "host", hot_keys(counts, "host", "rows")).unionByName(hosted.filter("host is null").withColumn("winners", F.lit(None).cast("array<long>")))
    return met.select("id", "url", "html", "winners").mapInArrow(_texts, f"id {id_type}, url string, text string, n_chars long, by_host boolean").withColumnsRenamed({"id": id_col, "url": url_col})
