import html as html_lib
import random
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from crawlspark.functions.entities import unescape
from crawlspark.operators import html as H

SF = "/root/testdata/sf0.01"


class _Tags(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, {k: ("" if v is None else v) for k, v in attrs}))


def reference_tags(text):
    p = _Tags()
    p.feed(text)
    p.close()
    return p.found


def spark_tags(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")
    out = {i: [] for i in range(len(texts))}
    for r in H.elements(df).orderBy("page_id", "pos").collect():
        out[r.page_id].append((r.tag, r.attrs))
    return [out[i] for i in range(len(texts))]


CASES = [
    '<a href="/x">x</a>', "<A HREF='/x' CLASS=y>", "<a href=/x/y/>", '<a href="/a" href="/b">', "<a disabled href>",
    '<script>var a = "<a href=1>";</script><a href=2>', "<script src=x/></script><a href=3>", "<style><a></style><b>",
    "<!-- <a href=1> --><a href=2>", "<!-- open <a href=1> <a href=2>", '<a title="a > b" href="/c">',
    '<a href="/x"class="y">', "<a href=it's>", "<p><br/><img src='a.png'/>", "<!DOCTYPE html><?php x ?><i>", "a < b <c>",
    '<a href="?a=1&amp;b=2&copy;&#x41;&#66;&nosuch;">', "<a\nhref\n=\n'/n'\n>", "text only", "", "</p <a>", "<a href='x",
    "<a href=\"x\"\"><b>", "<div onclick='location.href = \"/p\"'>", "<scripty><a></scripty>", "<ScRipT><a></sCRIPT ><b>",
    "<script>unclosed <a>", "<a b=c=d e>", "<x/y=1>", "<a  / href=1>", "<![CDATA[ <a> ]]><b>", "<a href=x", "<", "<a", "<>x<b>",
]


def test_elements_follow_the_standard_tokenizer(spark):
    for text, got in zip(CASES, spark_tags(spark, CASES)):
        assert got == reference_tags(text), text


def test_elements_on_all_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    rows = pages.collect()
    got = spark_tags(spark, [r.html for r in rows])
    for r, tags in zip(rows, got):
        assert tags == reference_tags(r.html), r.page_id


PIECES = ["<a ", "href=", '"/x"', "'y'", ">", "</a>", "<b", " c ", "=", "/", "<!--", "-->", "<script>", "</script>",
          "<style>", "</style>", "<img src=i.png>", "text", "<", "&amp;", " ", "\n", "<p>"]


def test_elements_on_generated_markup(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    for text, got in zip(texts, spark_tags(spark, texts)):
        assert got == reference_tags(text), repr(text)


def test_long_pages_do_not_overflow(spark):
    text = "<p>" * 200_000 + "<!-- x -->" * 100_000 + "<a " + "k=v " * 100_000 + ">" + "tail " * 200_000
    df = spark.createDataFrame([(1, text)], "page_id long, html string")
    assert df.select(F.size(H.start_tags(F.col("html"))).alias("n")).first().n == 200_001


def test_unescape(spark):
    texts = ["a&amp;b", "&lt", "&copy=1", "&notit;", "&notin;", "&#65;&#x42;", "&#0;", "&#128;", "&#x110000;", "&", "&&", "&x",
             "&#55296;", "&#1;", "&#13;", "&NewLine;", "&fjlig;", "&#x1F600;", "é&eacute;", "&#99999999999999;", "&#xFFFE;",
             "&#", "&#x;", "&amp;amp;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", unescape(F.col("t")).alias("u")).collect():
        assert r.u == html_lib.unescape(r.t), r.t


def _rows(spark, texts):
    return spark.createDataFrame([(i, "https://a.gov.si/dir/p.html", t) for i, t in enumerate(texts)],
                                 "page_id long, url string, html string")


def test_onclick(spark):
    cases = [("location.href = \"/a\"", "/a"), ("location.assign('/b')", "/b"), ("location.href=\"/c\"", None),
             ("location = '/d'", "/d"), ("location.href = \"\"", ""), ("track(1)", None), ("window.open('/e')", None),
             ("window.location.replace(\"/f\")", "/f"), ("location.href = '/g'; location.href = '/h'", "/h")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, onclick string")
    got = df.select("i", H.link_target(F.lit(None).cast("string"), F.col("onclick")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [c[1] for c in cases]


def test_find_links(spark):
    pages = _rows(spark, [
        '<a href="/x?q=1#f">1</a><a href="/x">2</a><a href="https://b.gov.si/d.pdf">3</a><a href="https://evil.com/">4</a>',
        '<a href="about.html">1</a><a href="mailto:a@gov.si" onclick="location.href = \'/m\'">2</a>',
        '<div onclick="location.assign(\'/p\')">', '<a>no link</a><a href="?a=1">q</a>', '<p onclick=\'location.href = ""\'>'])
    got = sorted((r.page_id, r.url) for r in H.find_links(pages).collect())
    assert got == [(0, "https://a.gov.si/x/"), (0, "https://b.gov.si/d.pdf"), (1, "https://a.gov.si/m/"),
                   (2, "https://a.gov.si/p/"), (4, "https://a.gov.si/")]
    rfc = {r.url for r in H.find_links(pages, mode="rfc3986").collect() if r.page_id == 1}
    assert "https://a.gov.si/dir/about.html" in rfc


def test_find_images(spark):
    srcs = ["/i/a.PNG", "a.png;v=1", ".png", "a.tar.png", "data:image/png;base64,xx", "x.pdf", "x.txt", "/q.jpg?x=1", "..png",
            "noext"]
    pages = _rows(spark, ["".join(f'<img src="{s}">' for s in srcs) + "<img><img src='a.tar.png'>"])
    got = sorted((r.filename, r.content_type) for r in H.find_images(pages, ["page_id"]).collect())
    assert got == [("a", "PNG"), ("a", "PNG"), ("a.tar", "PNG"), ("a.tar", "PNG"), ("q", "JPG"), ("x", "PDF")]


def test_documents(spark):
    pages = _rows(spark, ['<a href="/a.pdf"></a><a href="/b.PDF"></a><a href="/c.docx"></a><a href="/c.doc"></a><a href="/d"></a>'])
    links = H.find_links(pages)
    docs = sorted((r.url[-6:], r.data_type_code) for r in H.document_links(links).collect())
    assert docs == [("/a.pdf", "PDF"), ("/c.doc", "DOC"), ("c.docx", "DOCX")]
    assert {r.url for r in H.page_links(links).collect()} == {"https://a.gov.si/b.PDF", "https://a.gov.si/d/"}


def test_voided_openings_change_nothing(spark):
    """The scan of marked texts finds what the scan of the plain texts finds."""
    rng = random.Random(10)
    pieces = ["<!--", "-->", "--", ">", "<![CDATA[", "]]>", "]]", "<a href=x>", "<b c='<!--'>", '<i d="<![CDATA[">', "<script>", "</script>", " ", "x", "<!", "-- >", "</p>", "<!>"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 16))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "html string")
    plain = F.filter(F.regexp_extract_all("html", F.lit(H._SCAN), F.lit(1)), lambda t: t != "")
    assert df.filter(~(H.start_tags(F.col("html")) == plain)).collect() == []


def test_hostile_markup_takes_linear_time(spark):
    for piece in ("<!--x>", "<![CDATA[>", "<!--><![CDATA[>", "<a b='", "</", "<script", "<!-- --"):
        text = piece * (1_000_000 // len(piece)) + "<a href='/end'>"
        df = spark.createDataFrame([(text,)], "html string").select(F.size(H.start_tags(F.col("html"))).alias("n"))
        began = time.perf_counter()
        df.first()
        assert time.perf_counter() - began < 5, piece


def test_scan_finds_the_same_links_and_images(spark):
    pieces = ['<a href="/x">', '<A HREF=\'/y&amp;z\' onclick="location.href = \'/o\'">', '<img src="/i/a.PNG">', "<img src='b.tar.gif?x=1' onclick=\"location.assign('/p')\">",
              '<IMG/src=c.jpg>', '<img>', '<img src>', '<img src="/no.txt">', '<div onclick="location.href = \'/q\'">', "<abbr href='/no'>", '<!-- <a href="/c"> -->', "<script><a href='/s'></script>"]
    rnd = random.Random(11)
    pages = spark.createDataFrame([(k, "".join(rnd.choices(pieces, k=rnd.randint(0, 12)))) for k in range(200)] + [(200, None), (201, "")], "page_id long, html string")
    found = H.scan(pages, ["page_id"]).collect()
    links = sorted((r.page_id, r.target) for r in found if r.target is not None)
    assert links == sorted(map(tuple, H.link_candidates(pages, ["page_id"]).collect())) and len(links) > 100
    images = sorted((r.page_id, r.filename, r.content_type) for r in found if r.filename is not None)
    assert images == sorted(map(tuple, H.find_images(pages, ["page_id"]).drop("pos").collect())) and len(images) > 100
    assert all(r.target is not None or r.filename is not None for r in found)
