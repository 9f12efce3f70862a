import time

import page_reader
import pytest
from pyspark.sql import functions as F

from gleanery.functions.urls import AllowRule, allowed, canonical, resolved, with_scheme
from gleanery.operators import pages as jobs

CANONICAL = {
    "HTTP://EX.com/A/": "http://ex.com/A",
    "http://ex.com/": "http://ex.com",
    "http://ex.com/a///": "http://ex.com/a",
    "http://ex.com/a;p?q=1#f": "http://ex.com/a?q=1",
    "http://ex.com/a?utm_source=x&b=2&a=1&b=3": "http://ex.com/a?b=2&a=1&b=3",
    "http://ex.com/a?%75tm_x=1&UTM_y=2": "http://ex.com/a?UTM_y=2",
    "http://ex.com/a?b=&c&d=x%20y": "http://ex.com/a?d=x+y",
    "http://ex.com:80/a": "http://ex.com:80/a",
    "http://[::1/x": None,
    "http://u:P@Host.X:80/A/?a=1&utm_x=2&b=&c&e=~*+%2B%C3%A9%FF&=v&f=a=b":
        "http://u:p@host.x:80/A?a=1&e=~%2A+%2B%C3%A9%EF%BF%BD&=v&f=a%3Db",
}
# The examples of RFC 3986, section 5.4, and other cases; a link of another scheme is put after the page's URL.
RFC_PAGE = "http://a/b/c/d;p?q"
RESOLVED = [
    *[(RFC_PAGE, href, url) for href, url in {
        "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
        "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s",
        "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "": RFC_PAGE,
        ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
        "../..": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "g:h": RFC_PAGE + "g:h",
    }.items()],
    ("http://a.b/c/d", "/e", "http://a.b/e"),
    ("http://a.b/c/d", "../e", "http://a.b/e"),
    ("http://a.b/c/d", "?q=2", "http://a.b/c/d?q=2"),
    ("http://a.b", "e", "http://a.b/e"),
    ("http://a.b/c", "//H.q/x", "http://H.q/x"),
    ("http://a.b/c", "mailto:x@y", "http://a.b/cmailto:x@y"),
    ("http://a.b/c", "http://z.w/a;b/c;d?e=f&g#h", "http://z.w/a;b/c;d?e=f&g#h"),
    ("http://a.b/c", "/a/./b/../../c/", "http://a.b/c/"),
    ("http://a.b/c", "http://[::1/x", None),
]
RULE = [
    ("https://en.wikipedia.org/wiki/Cat", True),
    ("https://xen.wikipedia.org/wiki/Cat", True),
    ("https://de.wikipedia.org/wiki/Cat", False),
    ("https://en.wikipedia.org/w/Cat", False),
    ("https://en.wikipedia.org/wiki/File:Cat", False),
    ("https://en.wikipedia.org/wiki/A/B:C", False),
    ("https://en.wikipedia.org/wiki/Cat?action=edit", False),
    ("https://en.wikipedia.org/wiki/Cat?diff=1", False),
    ("https://en.wikipedia.org/wiki/Cat?x=1&%6fldid=1", False),
    ("https://en.wikipedia.org/wiki/Cat?action=", True),
    ("http://[::1/wiki/Cat", False),
]
HTML = [
    "<p>a</p><p> b </p>",
    '<p>a</p><img alt="x"><img alt=""><img alt="y">',
    '<meta name="description" content="d"><p>a</p>',
    '<meta property="og:description" content="o"><p>a</p>',
    '<meta property="og:description" content="o"><meta name=description content=d><p>a\r\nb</p>',
    "<script>s</script><!-- c --><p>a</p>",
    '<meta name="description"><p>a</p>',
    "<p>x<b>y</b>z<!-- k -->w</p>",
    "<p>&eacute;&nbsp;&lt;b&gt; &amp;lt; &#233; &#xe9; &#150; AT&T &copy 1 &hearts;</p>",
    "<a href=/x>1</a><A HREF='y?a=1&amp;b=2'>2</a><a href=\"?a=1&copy=2&section=3\">3</a><a href>4</a>",
    "<a name=q>5</a><a title=\"x>y\" href='z'>6</a><a title='href=no' HREF = \"u\" >7</a><a href='1' href='2'>8</a>",
    "<p don't>it's</p> <p title=\"a > b\">c</p> 1 < 2 & 3 > 2 <br/>x<img src=a alt='p\"q'/><img alt=bare>",
    '<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby><template><a href="t">tt</a></template>',
    '<style>p{}</style >x<script src=a></script>y<script>var a="<b>";</script>z<script>un <b>closed',
    '<!DOCTYPE html><?php x ?><title>T</title> q \x1c<a href="http://[::1/x">bad</a><a href=" /sp ">s</a>',
    '<a href="mailto:x@y">m</a><svg/><script/>after<p/>',
    "",
    "plain &amp; simple",
    "<p>&nbsp;a&nbsp;b &lt;i&gt; &quot;&apos;&#39; &copy;&middot; &amp;nbsp;</p>",
    '<a href="&#x2F;abc&#47;d&lt;">x</a><a href="&notit;x&not;y&ampz">',
    "<a " + "x='1' " * 3000 + "href=/far>" + "<p>'\"" * 3000,
]


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = {r["i"]: r["o"] for r in df.select("i", expression(F.col("v")).alias("o")).collect()}
    return [got[i] for i in range(len(values))]


def test_canonical(spark):
    assert column(spark, list(CANONICAL), canonical) == list(CANONICAL.values())
    assert column(spark, ["ex.com/a", "https://x"], with_scheme) == ["http://ex.com/a", "https://x"]


def test_canonical_is_stable(spark):
    once = [u for u in CANONICAL.values() if u]
    assert column(spark, once, canonical) == once


def test_resolution(spark):
    df = spark.createDataFrame(RESOLVED, "base string, href string, target string")
    assert df.filter(~resolved(F.col("base"), F.col("href")).eqNullSafe(F.col("target"))).collect() == []


def test_allow_rule(spark):
    urls = [url for url, _ in RULE]
    assert column(spark, urls, lambda url: allowed(url, AllowRule())) == [passes for _, passes in RULE]


@pytest.mark.parametrize("source", ["fixtures", "/root/testdata/sf0.001/pages.parquet"])
def test_pages_against_the_standard_library(spark, source):
    if source == "fixtures":
        rows = [(f"http://fx.com/d/{i}", html) for i, html in enumerate(HTML)]
        table = spark.createDataFrame(rows, "url string, html string")
    else:
        table = spark.read.parquet(source).select("url", "html")
        rows = [tuple(r) for r in table.collect()]
    content = dict(jobs.extract_content(table).collect())
    links = [tuple(r) for r in jobs.extract_links(table).collect()]
    given = [(url, href) for url, html in rows for href in page_reader.read(html).links]
    targets = spark.createDataFrame(given, "url string, href string").select(
        "url", canonical(resolved(F.col("url"), F.col("href"))).alias("dst")
    )
    assert sorted(links) == sorted(tuple(r) for r in targets.dropna().distinct().collect())
    for url, html in rows:
        assert content[url] == page_reader.content(html)


@pytest.mark.parametrize("opener", ["<a ", "<!-- ", "<script ", "<rt>", "</", "<!", "x \n"])
def test_openers_without_an_end_take_linear_time(spark, opener):
    def seconds(times):
        table = spark.createDataFrame([("http://a.b", opener * times)], "url string, html string")
        began = time.monotonic()
        jobs.extract_links(table).collect(), jobs.extract_content(table).collect()
        return time.monotonic() - began

    seconds(10)
    assert seconds(100_000) < 10


def test_malformed_links_are_dropped_and_counted(spark):
    table = spark.createDataFrame([("http://a.b", '<a href="http://[x/">1</a><a href="/y">2</a>')], "url string, html string")
    assert tuple(jobs.dropped_links(table).first()) == (2, 1)
    assert [r["dst"] for r in jobs.extract_links(table).collect()] == ["http://a.b/y"]


def test_links_need_no_exchange(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = jobs.extract_links(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<url:string,html:string>" in plan
