import random
import unicodedata
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.functions import urls as U
from crawlspark.operators import dedupe, ids, outcome, politeness, skew, tables


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def test_split(spark):
    cases = ["http://a.b/c;p?q#f", "http://a_b.c/x y", "//host/x", "#top", "mailto:x@y", "host:8080/x", "", "http://u:p@h:80/a;b/c;d;e", "?a=1",
             "HTTP://H/", "a b", " http://x/\n", "/x;y", "javascript:void(0);x", "http://h?x#", "1http://x", "http:///p", "x:y;z", "ftp://h/a;t"]
    for text, got in zip(cases, column(spark, cases, U.split_url)):
        assert tuple(got) == tuple(urlparse(text)), text
    assert column(spark, [None], U.split_url)[0].scheme is None


@pytest.mark.parametrize("build, cases", [
    (U.is_url, {"#a": True, "?a=1": False, "javascript:void(0)": False, "/x": True, "": False, "http://[x": False, "http://[::1]/": True,
                "mailto:a": False, "https://a": True, "about.html": True}),
    (U.is_domain_allowed, {"https://gov.si/": False, "https://a.gov.si/": True, "https://a.gov.si:443/": False, "https://a.gov.si.evil.com/": False}),
    (U.needs_expansion, {"https://gov.si/": True, "https://e-uprava.gov.si/": True, "https://evem.gov.si/": False, "evem.gov.si": True,
                         "http://www.a.si/x y?": False}),
    (U.document_type, {f"https://a/x{e}": e[1:].upper() for e in [".pdf", ".doc", ".docx", ".ppt", ".pptx", ".zip", ".rar", ".xlsx", ".xlsm"]}
     | {"https://a/x.PDF": None, "https://a/x.xls": None, "xpdf": None}),
    (U.has_file_extension, {"https://a/b.html": True, "https://a/b": False, "https://a/v1.2": True, "https://a/.x": False, "https://a/x.": False,
                            "https://a/": False}),
    (U.site_key, {"www.a.www.b": "a.b", "a.si": "a.si"}),
    (U.is_relative_path, {"/a": True, "": True, "a": False, "/": True}),
    (U.robots_url, {"http://a.si/x": "http://a.si/robots.txt"}),
    (U.extension_type, {".pdf": "PDF"}),
    (U.end_with_slash, {"https://a/b": "https://a/b/", "https://a/b.c": "https://a/b.c", "https://a/": "https://a/"}),
])
def test_predicates(spark, build, cases):
    assert column(spark, list(cases), build) == list(cases.values())


def test_null_is_no_url(spark):
    assert column(spark, [None], U.is_url) == [False]


def test_fill(spark):
    base = F.lit("https://a.gov.si/d/p?q#f")
    cases = {"/x": "https://a.gov.si/x", "about.html": "https://a.gov.siabout.html", "#t": "https://a.gov.si#t", "//o/x": "https://a.gov.si//o/x",
             "http://z/y": "http://z/y", "": "https://a.gov.si"}
    assert column(spark, list(cases), lambda c: U.fill_url(c, base)) == list(cases.values())
    rfc = {"/x": "https://a.gov.si/x", "b.html": "https://a.gov.si/d/b.html", "#t": "https://a.gov.si/d/p?q#t", "//o/x": "https://o/x",
           "?z": "https://a.gov.si/d/p?z", "http://z/y": "http://z/y"}
    assert column(spark, list(rfc), lambda c: U.fill_url(c, base, "rfc3986")) == list(rfc.values())


CANONICAL = {
    "HTTP://WWW.Example.COM:80/a/../b//c/./d?x=1#y": "http://www.example.com/b/c/d/", "https://a.gov.si": "https://a.gov.si/",
    "//o.gov.si/x": "https://o.gov.si/x/", "gov.si": "https://gov.si/", "https://a.si/%7Eu/ü": "https://a.si/~u/%C3%BC/",
    "https://čšž.gov.si/a.html": "https://xn--bea2o7c.gov.si/a.html", "https://h.si:0443/": "https://h.si/", "https://h.si:8443/": "https://h.si:8443/",
    "https://h.si/v1.2": "https://h.si/v1.2", "https://h.si/a%3Fb": "https://h.si/a/", "https://h.si/#!x": "https://h.si/",
    "https://h.si/..": "https://h.si/", "https://h.si/a%zz": "https://h.si/a%25zz/", "https://h.si/a+b": "https://h.si/a+b/", "https://H.si./x?": "https://h.si/x/",
    "https://h.si/%2e%2e/x": "https://h.si/x/", "https://@h.si/": "https://h.si/"}


def canonical(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    return [r.url for r in U.canonicalize(df, "url").orderBy("i").collect()]


def test_paths_are_composed(spark):
    rng = random.Random(3)
    pool = "eao\u0301\u0323\u0300\u0308\u0327U\u00c5\u212b\u1e09\uac01\u1100\u1161\u11a8\u03a9\u2126\u0915\u093c\ufb01\U0001f600 x"
    texts = ["", "plain", "caf\u00e9", "cafe\u0301"] + ["".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    assert all(r.c == (None if r.t is None else unicodedata.normalize("NFC", r.t)) for r in df.select("t", U.composed(F.col("t")).alias("c")).collect())
    both = spark.createDataFrame([("https://a.si/caf\u00e9/x.html",), ("https://a.si/cafe\u0301/x.html",), ("https://a.si/cafe%CC%81/x.html",), ("https://a.si/caf%C3%A9/x.html",)], "url string")
    assert {r.url for r in U.canonicalize(both, "url").collect()} == {"https://a.si/caf%C3%A9/x.html"}


def test_canonical_is_idempotent(spark):
    got = canonical(spark, list(CANONICAL))
    assert got == list(CANONICAL.values())
    assert canonical(spark, got) == got


def test_ranks_are_dense_and_ordered(spark):
    df = spark.range(0, 5000).withColumn("k", F.xxhash64("id"))
    got = [(r.k, r.rank) for r in ids.with_rank(df, ["k"]).collect()]
    assert sorted(got) == [(k, i) for i, k in enumerate(sorted(k for k, _ in got), 1)]


def test_lookup_with_a_hot_key(spark):
    left = spark.range(0, 3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    right = left.select("key").distinct().filter("key != 'k7'").withColumn("payload", F.length("key"))
    assert {r.key: r.n for r in skew.key_counts(left, "key").collect()}["hot"] == 1000
    got = skew.lookup(left, right, "key")
    want = left.join(right, "key", "left")
    assert sorted(map(tuple, got.select("id", "key", "payload").na.fill(-1).collect())) == sorted(
        map(tuple, want.select("id", "key", "payload").na.fill(-1).collect()))


def test_one_original_per_hash(spark):
    rnd = random.Random(1)
    rows = [(i, i, 10 + i, rnd.choice(["h0", "h0", f"h{i % 40}", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, seq long, site_id long, html_hash string")
    known = spark.createDataFrame([(1000, 7, "h3"), (5, 15, "h5")], "id long, site_id long, html_content_hash string")
    marked = dedupe.mark_duplicates(df, known)
    assert marked.count() == 400
    first = {"h3": (1000, 7), "h5": (5, 15)}
    for i, _, site, h in rows:
        if h:
            first.setdefault(h, (i, site))
    for r in marked.collect():
        want = (None, None) if r.html_hash is None or first[r.html_hash][0] == r.id else first[r.html_hash]
        assert (r.original_id, r.original_site_id) == want
    dup = {r.id: r for r in dedupe.duplicate_rows(marked).collect()}
    assert {(r.from_page, r.to_page) for r in dedupe.duplicate_edges(marked).collect()} == {
        (i, first[h][0]) for i, _, _, h in rows if h and first[h][0] != i}
    assert all(d.html_content is None and d.html_content_hash is None for d in dup.values())


@pytest.mark.parametrize("limit", [None, 40])
def test_schedule_equals_the_sequential_loop(spark, limit):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3]), rnd.randint(0, 300), rnd.randint(1, 9)) for i in range(600)]
    before = {1: 50, 4: 900}
    df = spark.createDataFrame(rows, "id long, host long, arrival long, delay long")
    free = spark.createDataFrame(list(before.items()), "host long, free_at long")
    got = politeness.schedule(df, free, max_clock_rows=limit, chunk_rows=limit)
    clock, want = dict(before), {}
    for i, host, arrival, delay in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = max(arrival, clock.get(host, 0))
        clock[host] = want[i] + delay
    assert {r.id: r.start for r in got.collect()} == want
    assert {r.host: r.free_at for r in politeness.next_available(got, before=free).collect()} == clock


def test_wait_times(spark):
    df = spark.createDataFrame([("a", "1", 10), ("b", "1", 10), ("c", None, 10)], "domain string, ip string, now long")
    got = politeness.wait_times(df, spark.createDataFrame([("a", 12), ("c", 5)], "domain string, free_at long"),
                                spark.createDataFrame([("1", 14)], "ip string, free_at long"))
    assert {r.domain: r.wait for r in got.collect()} == {"a": 4, "b": 4, "c": 0}


def pages(spark, rows):
    return schemas.conform(spark.createDataFrame(rows, "id long, site_id long, page_type_code string, url string, html_content string"), "page")


def test_page_writes(spark):
    page = pages(spark, [(1, None, "CRAWLING", "a", None), (2, 5, "HTML", "b", "x"), (3, 6, "FRONTIER", "c", None)])
    upd = spark.createDataFrame([(1, 200, 9)], "id long, http_status_code int, site_id long").withColumn("accessed_time", F.lit(None).cast("timestamp"))
    got = {r.id: r for r in tables.update_page(page, upd).collect()}
    assert (got[1].page_type_code, got[1].site_id, got[1].http_status_code, len(got)) == ("HTML", 9, 200, 3)
    assert tables.update_page(page, upd.withColumn("id", F.lit(2).cast("long"))).filter("id = 2").first().html_content is None
    red = tables.mark_redirect(page, upd.withColumn("id", F.lit(2).cast("long"))).filter("id = 2").first()
    assert (red.page_type_code, red.http_status_code, red.site_id, red.html_content) == ("REDIRECT", 301, 9, "x")
    failed = {r.id: r for r in tables.mark_failed(page, spark.createDataFrame([(1, None), (2, 8)], "id long, site_id long")).collect()}
    assert (failed[1].page_type_code, failed[1].site_id, failed[2].site_id, failed[3].page_type_code) == ("FAILED", None, 8, "FRONTIER")
    assert tables.remove_pages(page, page.filter("id = 2")).count() == 2
    crawling = tables.mark_crawling(page, tables.pop_frontier(page, 5))
    assert {r.id: r.page_type_code for r in crawling.collect()} == {1: "CRAWLING", 2: "HTML", 3: "CRAWLING"}


def test_inserts(spark):
    page = pages(spark, [(4, None, "HTML", "a", None)])
    wanted = spark.createDataFrame([("a", 2, 1), ("z", 2, 2), ("b", 3, 3), ("z", 9, 4)], "url string, site_id long, seq long")
    new, known = tables.get_or_create_pages(page, wanted, ["seq"])
    assert [(r.id, r.url, r.site_id, r.page_type_code) for r in new.orderBy("id").collect()] == [(5, "z", 2, "FRONTIER"), (6, "b", 3, "FRONTIER")]
    assert {r.url: r.id for r in known.collect()} == {"a": 4, "z": 5, "b": 6}
    site = schemas.conform(spark.createDataFrame([(1, "x.si")], "id long, domain string"), "site")
    sites = spark.createDataFrame([("www.x.si", 1), ("www.y.si", 2), ("y.si", 3)], "domain string, seq long")
    new, known = tables.get_or_create_sites(site, sites, ["seq"])
    assert [(r.id, r.domain) for r in new.collect()] == [(2, "y.si")]
    assert {r.domain: r.id for r in known.collect()} == {"www.x.si": 1, "www.y.si": 2, "y.si": 2}
    link = spark.createDataFrame([(1, 2)], "from_page long, to_page long")
    got = tables.add_links(link, spark.createDataFrame([(1, 2), (1, 3), (1, 3)], "from_page long, to_page long"))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (1, 3)]


def test_large_pop_is_exact(spark, monkeypatch):
    page = pages(spark, [(i, None, "FRONTIER" if i % 2 else "HTML", str(i), None) for i in range(1, 200)])
    monkeypatch.setattr(tables, "TOP_K", 10)
    assert sorted(r.id for r in tables.pop_frontier(page, 30).collect()) == list(range(1, 60, 2))


def test_outcomes(spark):
    u = "https://a.gov.si/x/"
    rows = [
        ("html", u, u, 200, "text/html", "<p>", None, "1"), ("status", u, u, 404, "text/html", "<p>", None, "1"),
        ("nodns", u, u, 200, "text/html", "<p>", None, None), ("empty", u, u, 200, "text/html", "", None, "1"),
        ("reset", u, u, None, None, None, "net::ERR_CONNECTION_RESET at x", "1"), ("doc", u, u, 200, "application/pdf; q=1", None, "net::ERR_ABORTED at x", "1"),
        ("doc404", u, u, 404, "application/pdf", None, "net::ERR_ABORTED at x", "1"), ("unknown", u, u, 200, "application/x-unknown", None, None, "1"),
        ("htmldoc", u, u, 200, "text/html", None, "net::ERR_ABORTED", "1"), ("redirect", u, "https://a.gov.si/y?z=1", 200, None, "<p>", None, "1"),
        ("docredirect", u, "https://other/", 200, "application/zip", None, None, "1"), ("bare", "https://a.gov.si/x", u, 200, None, "<p>", None, "1")]
    df = spark.createDataFrame(rows, "k string, current_url string, final_url string, http_status int, content_type string, html string, error string, ip string")
    got = {r.k: (r.outcome, r.is_redirect, r.document) for r in outcome.with_outcome(df).collect()}
    assert got == {"html": ("HTML", False, None), "status": ("HTML", False, None), "nodns": ("CRAWLING", False, None), "empty": ("CRAWLING", False, None),
                   "reset": ("FAILED", False, None), "doc": ("BINARY", False, "PDF"), "doc404": ("FAILED", False, None), "unknown": ("FAILED", False, None),
                   "htmldoc": ("FAILED", False, "HTML"), "redirect": ("HTML", True, None), "docredirect": ("BINARY", False, "ZIP"), "bare": ("HTML", True, None)}
    report = {(r.error, r.quiet): r.n for r in outcome.error_report(df).collect()}
    assert report == {("net::ERR_CONNECTION_RESET", True): 1, ("net::ERR_ABORTED", True): 3}


def test_expansion(spark):
    df = spark.createDataFrame([("https://gov.si/",), ("https://evem.gov.si/",), ("https://x.si/",)], "u string")
    table = spark.createDataFrame([("https://gov.si/", "https://www.gov.si/"), ("https://evem.gov.si/", "https://no/")], "short_url string, real_url string")
    got = {r.u: r.c for r in outcome.expand_urls(df, table, "u", "c").collect()}
    assert got == {"https://gov.si/": "https://www.gov.si/", "https://evem.gov.si/": "https://evem.gov.si/", "https://x.si/": "https://x.si/"}
