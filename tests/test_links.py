"""Links as an HTML parser lists them; expected values written out by hand."""

import pytest

from strata.sources.links import page_links


@pytest.mark.parametrize("html,want", [
    ('<A HREF="up.txt">x</A>', ["up.txt"]), ("<a href='one.txt'>x</a>", ["one.txt"]), ("<a href=bare.txt>x</a>", ["bare.txt"]),
    ('<a data-href="no.txt">x</a>', []), ('<a data-href="no.txt" href="yes.txt">x</a>', ["yes.txt"]),
    ('<a title="a > b" href="later.txt">x</a>', ["later.txt"]), ("<a title='href=\"no\"' href = \"sp.txt\">x</a>", ["sp.txt"]),
    ('<a href="q?a=1&amp;b=2">x</a>', ["q?a=1&b=2"]), ("<a name=top>x</a>", []), ("<abbr href='no'>x</abbr>", []),
    ('<a download href="d.txt"/>', ["d.txt"]), ('<a\nhref="nl.txt">x</a>', ["nl.txt"]),
    ('<a href="../">up</a><a href="sub/">s</a><a href="">e</a><a href="f/g.txt">g</a>', ["f/g.txt"]), (None, [])])
def test_links(spark, html, want):
    out = page_links(spark.createDataFrame([(1, html)], "page_id INT, html STRING"), keep=["page_id"])
    got = [(r["href"], r["file_name"]) for r in out.collect()]
    assert got == [(x, x.split("/")[-1]) for x in want]


@pytest.mark.parametrize("html,hrefs", [
    ('<!-- <a href="commented.txt"> --><a href="a.txt">', ["a.txt"]),
    ("<script>var s = '<a href=\"script.txt\">';</script><a href=b.txt>", ["b.txt"]),
    ('<a href="x&#x2e;txt"><a href="caf&eacute;.txt"><a href="a&ampb=1&copy=2&lt;.t">', ["x.txt", "café.txt", "a&ampb=1&copy=2<.t"]),
    ('<a href="&#8364;&#x80;&#128512;&#0;&#xD800;&#99999999999;&amp;lt;&bogus;&#x;.t">', ["€€😀���&lt;&bogus;&#x;.t"]),
    ("<a title='<!--' href=c.txt><p title=\"<script>\"><a href=d.txt>--></script>", ["c.txt", "d.txt"]),
    ("<style>a{} <a href=no></style ><TEXTAREA><a href=no></textarea><title><a href=no></title><a href=e.txt>", ["e.txt"]),
    ("<script>/* <!-- </script><a href=f.txt><!-- --> <script src=x>never closed <a href=no>", ["f.txt"]),
    ("<!--> <a href=g.txt><!-- open <a href=no>", ["g.txt"]),
    ("<abbr href=no><a\nHREF = 'h.txt'><a name=x><a href><a href=''><a href=../><a href=sub/>", ["h.txt"]),
    ("", []), (None, []), ("<a", []), ("&&;&#;<a href='&'>", ["&"]),
])
def test_a_page_is_scanned_once(spark, html, hrefs):
    got = page_links(spark.createDataFrame([(1, html)], "page_id int, html string"))
    assert [r["href"] for r in got.collect()] == hrefs
