"""Main texts of pages: whole tables against a plainer reading, hosts of other layouts against known articles."""

import random
import re
from html import escape, unescape

import duckdb
import pytest

from aquilith.llm.pages import Page, extract, host_of, host_paths
from aquilith.llm.queries import QUERIES


def plain(html):
    """The only article element's blocks, for the tables' pages."""
    body = html.partition("<article>")[2].partition("</article>")[0]
    parts = [" ".join(unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", body)]
    return "\n".join(x for x in parts if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_whole_query_equals_a_plainer_reading(spark, sf):
    folder = f"/root/testdata/{sf}"
    expected = [(i, u, plain(h), len(plain(h))) for i, u, h in duckdb.sql(f"select page_id, url, html from '{folder}/pages.parquet'").fetchall()]
    got = QUERIES["op13_host_paths"](spark, folder).select("page_id", "url", "text", "n_chars")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def sentence(rng, least=6):
    return " ".join(rng.choices("amber birch & cloud <dune> ember frost grove haze".split(), k=rng.randrange(least, 30))).capitalize() + "."


#: What stands around an article, by host.
LAYOUTS = {
    "plain.example": '<div class="wrap"><div id="menu"><a href="/a">Home</a> <a>About us</a></div><div class="col-{n} story-body">{a}</div><div class="right rail"><p>{x}</p></div></div>',
    "quiet.example": '<table><tr><td width=20%><a>one</a><br><a>two</a><br><a>three</a></td><td class=c{n}>{a}</td></tr></table><div>{s}</div>',
    "app.example": '<div id="root"><header class="top"><h1>Site</h1><p>{x}</p></header><main><section class="sheet"><div>{a}</div></section><section id="comments"><article class="comment"><p>{x}</p></article></section></main><div class="cookie-notice">{x}<button>OK</button></div></div>',
    "odd.example": '<center><form action=/s><p>{x}<input name="q>"></form><div class="page-{n}">{a}<div class="newsletter-box"><p>{x}</p></div><div class="share"><a>x</a></div></div></center><footer>&copy; {s}',
}


def page(rng, host, n):
    title, body = sentence(rng, 2), [sentence(rng) for _ in range(rng.randrange(2, 9))]
    html = f"<h1>{escape(title)}</h1>" + "".join(rng.choice(["<p>{}</p>", "<p>{}\n", "<p><b>{}<br>", "<blockquote>{}</blockquote>", "<ul><li>{}</ul>", "<p>\n {} <!-- <p>no</p> -->"]).format(escape(b)) for b in body)
    full = LAYOUTS[host].format(n=n, a=html, x=escape(sentence(rng)), s="terms apply")
    return (n, f"http://{host}/{n}?q=1", f"<!DOCTYPE html><html><head><title>t {n}</title><script>if (a < b) document.write('<p>x</p>')</script></head><body class='p{n}'>{full}</body></html>", "\n".join([title, *body]))


def rows_of(spark, rows, **how):
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    return sorted(map(tuple, extract(table.repartition(3), **how).collect()), key=repr)


@pytest.mark.parametrize("broadcast_hosts", [100, 0])
def test_other_layouts(spark, broadcast_hosts):
    rng = random.Random(3)
    pages = [page(rng, rng.choice(list(LAYOUTS)), n) for n in range(160)]
    got = rows_of(spark, [p[:3] for p in pages], broadcast_hosts=broadcast_hosts)
    assert [(g[0], g[2]) for g in sorted(got)] == [(p[0], p[3]) for p in sorted(pages)]
    assert sum(g[4] for g in got) == len(pages)


def test_the_host_decides_where_a_page_alone_would_not(spark):
    """Here a page's aside is longer than its article; its host's other pages tell them apart."""
    long, short = "long words stand here " * 20, "short text"
    shape = "<body><div class=left>{}</div><div class=extra>{}</div></body>"
    rows = [(n, "https://h.example/", shape.format(f"<p>{long} {n}</p>", "<p>little</p>")) for n in range(9)]
    rows.append((9, "https://h.example/9", shape.format(f"<p>{short * 6}</p>", f"<p>{short * 10}</p>")))
    alone = [(n, None, h) for n, _, h in rows]
    assert {r[0]: r[2] for r in rows_of(spark, rows)}[9] == short * 6
    assert {r[0]: r[2] for r in rows_of(spark, alone)}[9] == short * 10


def test_nulls_empty_pages_repeats_and_long_pages(spark):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [
        (1, "http://a.example/", None), (2, "http://a.example/", ""), (3, None, "<p>no host</p>"), (None, "http://a.example/", "<p>no id</p>"),
        (4, "http://a.example/", "<nav><p>menu</p></nav>"), (5, "http://a.example/", long), (5, "http://a.example/", long), (6, "nonsense", "bare text &amp; more"), (7, "http://b.example", "<body></body>"),
    ]
    got = rows_of(spark, rows)
    texts = sorted(((g[0], g[2]) for g in got), key=repr)
    word = " ".join(["word"] * 200_000)
    assert texts == sorted([(1, ""), (2, ""), (3, "no host"), (None, "no id"), (4, ""), (5, word), (5, word), (6, "bare text & more"), (7, "")], key=repr)
    assert all(g[3] == len(g[2]) for g in got)
    assert rows_of(spark, []) == []


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a <b>b</b>c<br>d</p>e", "a bc d\ne"),
        ("<p>1 < 2 &lt; 3 & &#x41;&eacute;&nbsp; x</p>", "1 < 2 < 3 & Aé x"),
        ('<p title="a > b">t</p><p class="x>y</p>z', "t\ny\nz"),
        ("<ul><li>one<li>two</ul><dl><dt>k<dd>v</dl>", "one\ntwo\nk\nv"),
        ("<article><header><h1>T</h1><p>by A</p></header><p>x</p><footer>f</footer></article>", "T\nx"),
        ("<p>open <script>if (a</p>b) </script><style>p{}</style>text<textarea>no</textarea>", "open text"),
        ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p><!-- open <p>x", "yes"),
        ("<article><p>main</p><div class='comments'><p>a comment</p></div></article>", "main"),
        ("<div class='page with-sidebar'><div class='content'>c c c</div><div class='sidebar'>s</div></div>", "c c c"),
        ("<P>up<DIV>down</DIV></BODY></HTML>tail", "up\ndown\ntail"),
        ("</p></div><>text</>", "<>text</>"),
    ],
)
def test_markup(html, text):
    assert Page(html).text([])[0] == text


def test_broken_markup_takes_time_in_proportion():
    for bad in ('<a title="', "<a title='", "<", "</", "<!--", "<p class='x", "<div>", "</b>", "&", '="', "<script"):
        Page(bad * 20_000).points()


def test_hosts():
    assert [host_of(u) for u in ("http://A.example:80/x", "//b.example?q", "https://u:p@c.example", "no", "", None)] == ["a.example", "b.example", "c.example", None, None, None]


def test_points_are_summed_by_host(spark):
    rng = random.Random(1)
    pages = [page(rng, host, n) for n, host in enumerate([*LAYOUTS] * 12)]
    found = host_paths(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(4)).collect()
    for host in LAYOUTS:
        sums = {}
        for n, url, html, _ in pages:
            if host_of(url) == host:
                for path, k in Page(html).points().items():
                    sums[path] = sums.get(path, 0) + k
        every = sum(sums.values())
        assert {r.path & (1 << 64) - 1: r.points for r in found if r.host == host} == {p: k for p, k in sums.items() if 20 * k >= every}
        assert sorted(r["rank"] for r in found if r.host == host) == list(range(1, 1 + sum(r.host == host for r in found)))
