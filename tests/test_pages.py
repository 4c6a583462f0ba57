from pyspark.sql import functions as F

from recsmith.functions import markup as H
from recsmith.operators import pages as P
from recsmith.sources import markup as M

SF_SMALL = "/root/testdata/sf0.001"

COLLECTION = (
    '<div class="article">'
    '<div class="item"><div class="pic"><a class="nbg" title="T1" href="U1"></a></div>'
    '<div class="info"><a href="U1"><em> T1 </em></a><ul><li class="intro">S1</li>'
    '<li><span class="rating4-t"></span></li></ul></div></div>'
    '<div class="item"><div class="pic"><a title="T2" class="nbg" href="U2"></a></div>'
    '<div class="info"><a href="U2"><em>T2</em></a><ul><li class="intro">S2</li></ul></div></div>'
    '</div>')
PROFILE = ('<div class="info"><h1>Someone watched (123)</h1></div><div class="side-info-txt"><h3>N</h3></div>'
           '<div class="paginator"><a>1</a><a>2</a><a>next</a></div>')
PROFILE_ONE_PAGE = '<div class="info"><h1>X (5)</h1></div><div class="side-info-txt"><h3>M</h3></div>'
COMMENTS = ('<div class="comment-item"><span class="comment-info"><a href="U9">First Last</a></span></div>'
            '<div class="comment-item"><p>no link</p></div>')


def home(n, word="collect"):
    return (f'<div id="movie"><span class="pl"><a href="http://h/wish">{n + 100} wished</a></span>'
            f'<span class="pl"><a href="http://h/{word}">{n} watched</a></span></div>')


def pages(spark, *htmls):
    return spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def test_collection_items(spark):
    got = [tuple(r) for r in P.extract_items(pages(spark, COLLECTION)).orderBy("pos").collect()]
    assert got == [(0, 0, "T1", "U1", "S1", 4), (0, 1, "T2", "U2", "S2", 0)]


def test_attr_variant_either_order(spark):
    got = [r.title for r in P.extract_attr(pages(spark, COLLECTION)).orderBy("pos").collect()]
    assert got == ["T1", "T2"]


def test_profile(spark):
    got = [tuple(r) for r in P.extract_profile(pages(spark, PROFILE, PROFILE_ONE_PAGE)).orderBy("page_id").collect()]
    assert got == [(0, "N", 123, 2), (1, "M", 5, 1)]


def test_commenters(spark):
    got = [tuple(r) for r in P.extract_commenters(pages(spark, COMMENTS)).collect()]
    assert got == [(0, 0, "U9", "First-Last")]


def test_collection_link_threshold(spark):
    df = pages(spark, home(901), home(900), "<div>no section</div>", home(5000, word="other"))
    got = {r.page_id: r.collect_url for r in P.extract_collection_link(df).collect()}
    assert got == {0: "http://h/collect?"}


def test_ingest_status(spark):
    df = pages(spark, PROFILE, "<html></html>", '<div class="side-info-txt"><h3>Z</h3></div>')
    got = {r.page_id: r.status for r in P.ingest_pages(df).collect()}
    assert got == {0: "ok", 1: "no_name", 2: "no_total"}


VARIANT = (
    '<div class="article">\n'
    '  <div class="item  odd" data-x="1">\n'
    '    <div class="pic"><a title="T1" class="nbg" href="U1"><img src="p.jpg"></a></div>\n'
    '    <div class="info big">\n'
    '      <a class="t" href="U1"><em>T1 &amp; more</em></a>\n'
    '      <ul><li class="intro main">S1</li><li><span class="date rating5-t"></span></li></ul>\n'
    '    </div>\n'
    '  </div>\n'
    '  <div class="item"><div class="info"><a href="U2"><em>T2</em></a></div></div>\n'
    '</div>')


def test_markup_variants(spark):
    got = [tuple(r) for r in P.extract_items(pages(spark, VARIANT)).orderBy("pos").collect()]
    assert got == [(0, 0, "T1 & more", "U1", "S1", 5), (0, 1, "T2", "U2", "", 0)]


def test_odd_pages(spark):
    df = pages(spark, None, "", "no markup", "<div class='item'><div class=info><em>cut off", '<p class="item"/>',
               '<div class="item"><img class="info"></div>')
    got = [tuple(r) for r in P.extract_items(df).orderBy("page_id").collect()]
    assert got == [(3, 0, "", "", "", 0), (4, 0, "", "", "", 0), (5, 0, "", "", "", 0)]
    assert P.extract_commenters(df).count() == P.extract_collection_link(df).count() == P.extract_attr(df).count() == 0
    assert [tuple(r)[1:] for r in P.extract_profile(df).orderBy("page_id").collect()][1:] == [("", None, 1)] * 5


def test_long_pages(spark):
    """Very long texts, tags and runs of elements neither end the job nor lose elements."""
    page = ('<div class="article"><!-- ' + "x" * 200_000 + ' --><p title="' + "y" * 200_000 + '">' + "z<" * 50_000 + "</p>"
            + '<div class="item"><div class="info"><a href="u"><em>t</em></a></div></div>' * 500 + "</div>")
    got = P.extract_items(pages(spark, page)).collect()
    assert [r.pos for r in got] == list(range(500)) and {(r.title, r.item_url) for r in got} == {("t", "u")}


def test_text_and_attributes_equal_an_html_parser(spark):
    from html import unescape

    raw = ["&amp;lt; &lt;", "&#65;&#x42;&#0;&#xD800;", "&nope; & &amp", "a &nbsp; b", "&copy;&hellip;&euro;", "1 &lt 2",
           "&#128512; &amp;#38;", ""]
    want = [" ".join(unescape(x).replace("\u00a0", " ").split()) for x in raw]
    want[1], want[2], want[5] = "AB\ufffd\ufffd", "&nope; & &amp", "1 &lt 2"  # a reference ends with a semicolon
    df = spark.createDataFrame(list(enumerate(raw)), "i int, s string")
    got = [r.t for r in df.select("i", H.text_of(F.col("s")).alias("t")).orderBy("i").collect()]
    assert got == want
    tag = """<a data-x='href="no"' HREF = "u?a=1&amp;b=2" title=plain empty="">"""
    row = spark.createDataFrame([(tag,)], "t string").select(
        *[H.attribute(F.col("t"), n).alias(n) for n in ("href", "title", "empty", "none")]).first()
    assert tuple(row) == ("u?a=1&b=2", "plain", "", None)


def test_elements_by_pattern_equal_the_fold(spark):
    """What the pattern finds is what the fold over the tags finds, and it is the pattern that finds it in plain pages."""
    import random

    rnd = random.Random(5)
    names = ["div", "DIV", "p", "img", "a", "dé", "DÉ"]
    bits = ["<{n}>", "<{n} class='item'>", '<{n} class="x item y">', "<{n}\nclass = item >", "</{n}>", "</{n} >", "<{n}/>",
            "<{n} class='item'/>", "<{n} title='a/>b' class=item>", "text", " < 5 ", "<{n} title=\"<p class='item'>\">",
            "<{n} items=item>", "</{n}>", "</ div>", "é", "<3", "</"]
    odd = ["<div class='item", '<a "', ">", '"', "\x01"]
    htmls = [None, "", "item"] + ["<div class=item>" + "<div>x" * k + "</div>" * (k - 1) + "<p class=item>y</p>" for k in range(1, 13)]
    for i in range(1500):
        few = rnd.sample(names, rnd.choice([1, 2, 3]))
        htmls.append("".join(rnd.choice(bits + odd * (i % 3 == 0)).replace("{n}", rnd.choice(few))
                             for _ in range(rnd.choice([3, 8, 20, 60]))))
    html, opening = F.col("html"), H.with_class("item")
    folded = F.transform(H.elements(H.stream(html), opening, "item"), H.html_of)
    df = pages(spark, *htmls).select("html", folded.alias("folded"), H.of_class(html, "item").alias("got"))
    assert df.where(~F.col("got").eqNullSafe(F.col("folded"))).collect() == []
    assert df.where("size(got) > 1").count() > 300

    # One pass of the pattern over a plain page leaves what is behind its last element.
    behind = F.regexp_replace(html, rf"\G{H.LEAD}(?:(?!{opening}){H.TOKEN})*+{H._element(opening)}", "")
    assert pages(spark, COLLECTION).select(behind).first()[0] == "</div></div>"


def test_pages_are_dealt_over_the_cores(spark):
    for pages in (M.collection_pages(spark, SF_SMALL), M.collection_pages(spark, SF_SMALL, owner=True),
                  M.comment_pages(spark, SF_SMALL)):
        rows = pages.groupBy(F.spark_partition_id()).count().collect()
        assert len(rows) >= spark.sparkContext.defaultParallelism  # one split of the scan held all of them
        assert max(r["count"] for r in rows) < 2 * sum(r["count"] for r in rows) / len(rows)


def test_attribute_is_the_first_of_its_name(spark):
    want = {'<a x="1" TITLE=\'a "b"\' title=c>': 'a "b"', '<a data-title="x" title = b>': "b", '<a title="">': "",
            '<a alt="title=x" href=y>': None, "<a =title='t'>": None, "": None}
    df = spark.createDataFrame([(t,) for t in want], "tag string")
    assert {r["tag"]: r["got"] for r in df.select("tag", H.attribute(F.col("tag"), "title").alias("got")).collect()} == want


def test_plain_pages_are_read_from_tag_to_tag(spark):
    """every tag of a page was looked at for each class; elements must stay those of the fold."""
    deep = lambda k: '<div class="item">' + "<div>" * k + "x" + "</div>" * k + '</div><div class="item">y</div>'
    plain = ['<div class="a item b">x<div>y</div></div> <DIV CLASS=item>z</DIV >', '<br class="item">t<p>', '<p class=\'item\'/>u',
             '<item>no</item>', '<div title="it\'s" class="item">1 > 0', '<div class="items">no</div>', "item", deep(7), deep(8),
             deep(12), '<div class="item"><div>left open']
    other = ['<div data-k="a>b" class="item">x</div>', '<div class="item">5 < 6</div>', '<div class="item">cut <b', "<div class='item>x",
             '<ünd class="item">x</ünd><div class="item">y</div>', '</><div class="item">x</div>']
    df = spark.createDataFrame([(h, True) for h in plain] + [(h, False) for h in other] + [(None, None)], "html string, plain boolean")
    h = F.col("html")
    fold = F.transform(H.elements(H.stream(h), H.with_class("item"), "item"), H.html_of)
    rows = df.select("html", "plain", H.is_plain(h).alias("is_plain"), H.of_class(h, "item").alias("got"),
                     H.of_class(h, "item", H.is_plain(h)).alias("told"), F.when(h.isNotNull(), fold).alias("want"),
                     F.regexp_extract_all(h, F.lit(H._plain_element(H.with_class("item"))), F.lit(1)).alias("quick")).collect()
    for r in rows:
        assert r.is_plain == r.plain and r.got == r.told == r.want, r.html
        if r.plain:
            assert r.quick == r.want or "<" in r.quick, r.html
    assert ["<" in r.quick for r in rows if r.html in (deep(7), deep(12))] == [False, True]
    pages = df.select(F.lit(1).alias("page_id"), "html")
    assert P.shown(pages, ["page_id"]).columns == ["page_id", "shown", P.PLAIN]
