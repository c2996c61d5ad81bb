import random
import xml.etree.ElementTree as ElementTree
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from crawlspark.functions import urls as U
from crawlspark.operators import robots as R
from crawlspark.operators import sitemaps as S

AGENT = "testbot/1.0"
TEXTS = [
    "User-agent: *\nDisallow: /private\nAllow: /\nCrawl-delay: 7\n\nSitemap: https://h/s.xml",
    "User-agent: TestBot\nUser-agent: other\nDisallow: /a\n\nUser-agent: *\nDisallow: /\n",
    "User-agent: *\nDisallow: /one\n\nUser-agent: *\nDisallow: /two\n",
    "User-agent: x\n\nDisallow: /lost\nUser-agent: testbot\nAllow: /a/b\nDisallow: /a\nUser-agent: *\nDisallow:\n",
    "Disallow: /orphan\r\nUser-agent: *\r\nCrawl-delay: 3\r\n", "", "# only a comment", "User-agent: *\nDisallow: *\nDisallow: /*.pdf",
    "user-AGENT : testbot # us\nDISALLOW : /%7Ex # c\nrequest-rate: 03/10\nAllow: /q?a=1\nDisallow: /q\n",
    "User-agent: bot\nDisallow: /b\nSitemap: /s1\nDisallow: /c\nSitemap: http://x/s2\n \nDisallow: /d",
    "User-agent: testbot\nCrawl-delay: x\nCrawl-delay: 12\nDisallow: /a b\n", "User-agent: *\nUser-agent: z\nDisallow: /z\nnonsense\nfoo: bar\n",
    "User-agent:\nDisallow: /e\n", "User-agent: *\rDisallow: /r Allow: /u\n",
]
URLS = ["https://h/", "https://h", "https://h/private/x", "https://h/a/b/c", "https://h/a", "https://h/%7Ex", "https://h/~x", "https://h/q?a=1",
        "https://h/q", "https://h/q?b", "https://h/a b", "https://h/a%20b", "https://h/two", "https://h/one", "https://h/z#f", "https://h/x.pdf",
        "https://h/*", "https://h/c", "https://h/d", "https://h/e/ü", "https://h/r", "https://h/u", "https://h/x?"]


def parser(text):
    p = RobotFileParser()
    p.parse(text.splitlines())
    return p


def check(spark, texts):
    files = spark.createDataFrame([(str(i), 200, t) for i, t in enumerate(texts)], "domain string, http_status int, content string")
    links = files.select("domain").crossJoin(spark.createDataFrame([(u,) for u in URLS], "url string"))
    for r in R.with_verdict(links, R.policies(files, AGENT)).collect():
        text = texts[int(r.domain)]
        assert r.allowed == parser(text).can_fetch(AGENT, r.url), (text, r.url)
    for r in R.policies(files, AGENT).collect():
        assert r.policy.delay == parser(texts[int(r.domain)]).crawl_delay(AGENT), texts[int(r.domain)]
    for r in R.site_columns(files).collect():
        p = parser(texts[int(r.domain)])
        assert r.robots_content == str(p), texts[int(r.domain)]
        assert r.sitemap_content == (",".join(p.site_maps()) if p.site_maps() else None)


def test_rules_follow_the_standard_parser(spark):
    check(spark, TEXTS)


def test_generated_files(spark):
    parts = ["User-agent: *", "User-agent: testbot", "User-agent: foo", "", "Disallow: /a", "Allow: /a/b", "Disallow:", "Disallow: /", "# c",
             "Crawl-delay: 4", "Sitemap: /s.xml", "Allow: /q", "  ", "junk", "Request-rate: 1/5", "Disallow: /q?a=1"]
    rnd = random.Random(3)
    check(spark, ["\n".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(150)])


def test_status(spark):
    rows = [("a", 401, "x"), ("b", 403, "x"), ("c", 404, None), ("d", 500, None), ("e", 200, ""), ("f", None, None)]
    files = spark.createDataFrame(rows, "domain string, http_status int, content string")
    links = spark.createDataFrame([(d, "https://h/x") for d in "abcdefg"], "domain string, url string")
    got = {r.domain: r.allowed for r in R.with_verdict(links, R.policies(files)).collect()}
    assert got == {"a": False, "b": False, "c": True, "d": False, "e": True, "f": False, "g": False}


def test_saved_robots_give_the_same_verdicts(spark):
    files = spark.createDataFrame([(str(i), 200, t) for i, t in enumerate(TEXTS)], "domain string, http_status int, content string")
    links = files.select("domain").crossJoin(spark.createDataFrame([(u,) for u in URLS], "url string"))
    saved = R.saved_policies(R.site_columns(files), AGENT)
    for r in R.with_verdict(links, saved).collect():
        assert r.allowed == parser(str(parser(TEXTS[int(r.domain)]))).can_fetch(AGENT, r.url)


def test_locs(spark):
    xml = ("<?xml version='1.0'?><urlset xmlns:image='i'><url><loc>https://a/x?a=1&amp;b=2</loc><image:loc>https://a/i.png</image:loc></url>"
           "<!-- <loc>https://a/no</loc> --><url><loc><![CDATA[https://a/y?c&d]]></loc></url><url><loc a='1'>https://a/z</loc></url></urlset>")
    files = spark.createDataFrame([("u", 200, xml), ("v", 404, xml), ("w", 200, None), ("x", 200, "")], "url string, http_status int, xml string")
    assert [r.loc for r in S.sitemap_locs(files).collect()] == ["https://a/x?a=1&b=2", "https://a/y?c&d", "https://a/z"]


def test_broken_sitemaps_have_no_locs(spark):
    good = "<x><loc>https://a/</loc></x>"
    broken = ["<x><loc>https://a/</loc>", "<x><loc>https://a/</loc></y>", "<x><loc>https://a/?b&c</loc></x>", "<x><loc>https://a/</loc><loc>cut", "<loc>https://a/</loc", "<x a=1><loc>https://a/</loc></x>",
              "no XML", "<x><loc>https://a/</loc><</x>", "<x><loc>https://a/</loc>&nosuch;</x>"]
    files = spark.createDataFrame([(str(k), 200, x) for k, x in enumerate([good, "<?xml version='1.0' encoding='UTF-8'?>\n" + good, *broken])], "url string, http_status int, xml string")
    assert sorted((r.url, r.loc) for r in S.sitemap_locs(files).collect()) == [("0", "https://a/"), ("1", "https://a/")]
    for text in broken:
        with pytest.raises(ElementTree.ParseError):
            ElementTree.fromstring(text)


def test_tree_with_cycle(spark):
    def index(*urls):
        return "<x>" + "".join(f"<loc>{u}</loc>" for u in urls) + "</x>"

    files = spark.createDataFrame([
        ("https://a.gov.si/sitemap.xml", 200, index("https://a.gov.si/s1.xml", "https://a.gov.si/page")),
        ("https://a.gov.si/s1.xml", 200, index("https://a.gov.si/sitemap.xml?p=2", "https://a.gov.si/s1.xml", "https://a.gov.si/deep")),
        ("https://a.gov.si/sitemap.xml?p=2", 200, index("https://a.gov.si/sitemap.xml", "https://a.gov.si/last", "https://evil.com/")),
        ("https://b.gov.si/own.xml", 200, index("https://b.gov.si/no/x", "https://b.gov.si/ok"))], "url string, http_status int, xml string")
    sites = spark.createDataFrame([("a.gov.si", "https://a.gov.si/z"), ("b.gov.si", "https://b.gov.si/")], "domain string, url string")
    robots = spark.createDataFrame([("a.gov.si", 404, None), ("b.gov.si", 200, "User-agent: *\nDisallow: /no\nSitemap: https://b.gov.si/own.xml")],
                                   "domain string, http_status int, content string")
    got = sorted((r.domain, r.url) for r in S.find_sitemap_links(sites, robots, files).collect())
    assert got == [("a.gov.si", "https://a.gov.si/deep/"), ("a.gov.si", "https://a.gov.si/last/"), ("a.gov.si", "https://a.gov.si/page/"),
                   ("b.gov.si", "https://b.gov.si/ok/")]
    assert S.root_sitemaps(sites, robots).filter(F.col("url") == U.sitemap_url(F.col("url"))).count() == 1
