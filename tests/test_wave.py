import datetime
import glob
import hashlib
import tempfile

import pytest

from crawlspark import schemas
from crawlspark.plans.discovery import discover, fold
from crawlspark.plans.wave import apply_wave, crawl_wave, empty_state
from crawlspark.sources import inputs
from crawlspark.sources.store import CrawlStore

T0 = datetime.datetime(2024, 1, 1)
A = "https://a.gov.si"


def fetch(seq, url, html="", final=None, status=200, kind="text/html", error=None, ip="1"):
    return (seq, url, final or url, status, kind, html, error, ip, T0 + datetime.timedelta(seconds=seq))


def fetches(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.schema("fetches"))


def robots(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.schema("robots_files"))


def state(spark, urls):
    page = spark.createDataFrame([(i, "CRAWLING", u) for i, u in enumerate(urls, 1)], "id long, page_type_code string, url string")
    return empty_state(page)


def table(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def run(spark, urls, rows, **inputs):
    before = state(spark, urls)
    return before, crawl_wave(before, fetches(spark, *rows), **inputs)


def test_one_wave(spark):
    urls = [f"{A}/{n}/" for n in ("p", "copy", "moved", "doc", "down", "nodns", "err404")]
    html = '<a href="/new">n</a><a href="/f.pdf">f</a><a href="/p/">p</a><a href="https://evil.com/">e</a><img src="/i.png"><a href="/no/x">x</a>'
    rows = [fetch(1, urls[0], html), fetch(2, urls[1], html), fetch(3, urls[2], '<a href="/new"></a><a href="/two"></a>', final=f"{A}/target?x=1"),
            fetch(4, urls[3], None, kind="application/x-tar"), fetch(5, urls[4], None, status=None, error="net::ERR_EMPTY_RESPONSE at x"),
            fetch(6, urls[5], html, ip=None), fetch(7, urls[6], "<p>missing", status=404)]
    files = robots(spark, ("a.gov.si", 200, "User-agent: *\nDisallow: /no\nSitemap: https://a.gov.si/s.xml"))
    maps = spark.createDataFrame([("https://a.gov.si/s.xml", "a.gov.si", 200, "<loc>https://a.gov.si/mapped</loc><loc>https://a.gov.si/m.pdf</loc>")],
                                 schemas.schema("sitemap_files"))
    before, delta = run(spark, urls, rows, robots_files=files, sitemap_files=maps)
    after = apply_wave(before, delta)
    assert table(after["page"], "id", "page_type_code", "url", "site_id", "http_status_code") == sorted([
        (1, "HTML", urls[0], 1, 200), (2, "DUPLICATE", urls[1], 1, 200), (3, "REDIRECT", urls[2], 1, 301), (4, "BINARY", urls[3], 1, 200),
        (5, "FAILED", urls[4], 1, None), (6, "CRAWLING", urls[5], None, None), (7, "HTML", urls[6], 1, 404),
        (8, "FRONTIER", f"{A}/m.pdf", None, None), (9, "FRONTIER", f"{A}/mapped/", None, None), (10, "FRONTIER", f"{A}/new/", None, None),
        (11, "HTML", f"{A}/target/", 1, 200), (12, "FRONTIER", f"{A}/two/", None, None)], key=str)
    assert table(after["link"], "from_page", "to_page") == sorted([(1, 8), (1, 9), (1, 10), (2, 1), (3, 11), (11, 12)], key=str)
    assert table(after["site"], "id", "domain", "robots_content", "sitemap_content") == [
        (1, "a.gov.si", "User-agent: *\nDisallow: /no", "https://a.gov.si/s.xml")]
    assert table(after["image"], "id", "page_id", "filename", "content_type") == [(1, 1, "i", "PNG")]
    assert table(after["page_data"], "id", "page_id", "data_type_code") == [(1, 1, "PDF"), (2, 4, "UNKNOWN")]
    rows_by_id = {r.id: r for r in after["page"].collect()}
    assert rows_by_id[1].html_content == html and rows_by_id[2].html_content is None and rows_by_id[2].html_content_hash is None
    assert rows_by_id[7].accessed_time == T0 + datetime.timedelta(seconds=7)

    # The same batch again changes no site, page or link; images and documents are appended per visit.
    again = apply_wave(after, crawl_wave(after, fetches(spark, *rows), robots_files=files, sitemap_files=maps))
    for name in ("site", "page", "link"):
        assert table(again[name], *again[name].columns) == table(after[name], *after[name].columns), name


def test_all_edges_and_long_values(spark):
    urls = [f"{A}/1/", f"{A}/2/"]
    long_url = "/" + "x" * 3000
    rows = [fetch(1, urls[0], f'<a href="/2/"></a><a href="{long_url}"></a>'), fetch(2, urls[1], f'<img src="{"y" * 256}.png"><a href="/1/"></a><a href="/z.pdf">')]
    before, delta = run(spark, urls, rows, edges="all", max_url_length=3000, max_filename_length=255)
    after = apply_wave(before, delta)
    assert table(after["link"], "from_page", "to_page") == [(1, 2), (2, 1)]
    assert table(after["page"], "id", "page_type_code") == [(1, "HTML"), (2, "FAILED")]
    assert delta["rejects"].count() == 1 and delta["image"].count() == 0 and delta["page_data"].count() == 0

    # Without limits nothing is lost.
    before, delta = run(spark, urls, rows, edges="all")
    after = apply_wave(before, delta)
    assert table(after["page"], "id", "page_type_code", "url") == [(1, "HTML", urls[0]), (2, "HTML", urls[1]), (3, "FRONTIER", A + long_url + "/")]
    assert table(after["link"], "from_page", "to_page") == [(1, 2), (1, 3), (2, 1)]
    assert delta["rejects"].count() == 0 and delta["image"].count() == 1 and delta["page_data"].count() == 1


def test_overlong_redirect_keeps_its_page(spark):
    urls, target = [f"{A}/r/"], A + "/" + "t" * 4000 + "/"
    html = '<a href="/n"></a><a href="/d.pdf"></a><img src="/i.png">'
    for limits in ({}, {"max_url_length": 3000}):
        before, delta = run(spark, urls, [fetch(1, urls[0], html, final=target)], **limits)
        after = apply_wave(before, delta)
        pages = {r.url: r for r in after["page"].collect()}
        assert pages[urls[0]].page_type_code == "REDIRECT" and pages[target].html_content == html
        owners = {pages[target].id}
        assert {r.page_id for r in after["image"].collect()} == {r.page_id for r in after["page_data"].collect()} == owners
        assert (pages[target].id, pages[A + "/n/"].id) in table(after["link"], "from_page", "to_page")
        assert delta["rejects"].count() == 0


def test_target_scope_reads_the_files_of_all_hosts(spark):
    urls = [f"{A}/p/"]
    html = "".join(f'<a href="https://{h}.gov.si/{p}"></a>' for h in "abc" for p in ("ok", "no"))
    files = robots(spark, ("a.gov.si", 200, "User-agent: *\nDisallow: /no"), ("b.gov.si", 200, "User-agent: *\nDisallow: /no"))
    before, delta = run(spark, urls, [fetch(1, urls[0], html)], robots_files=files, robots_scope="target")
    assert table(delta["page"].filter("page_type_code = 'FRONTIER'"), "url") == [("https://a.gov.si/ok/",), ("https://b.gov.si/ok/",)]
    # A later wave without these files knows the hosts from their site rows.
    known = apply_wave(before, delta)
    extra = schemas.conform(spark.createDataFrame([(9, "CRAWLING", f"{A}/q/")], "id long, page_type_code string, url string"), "page")
    known["page"] = known["page"].unionByName(extra)
    later = crawl_wave(known, fetches(spark, fetch(2, f"{A}/q/", '<a href="/no"></a><a href="/yes"></a>')), robots_files=robots(spark, ("z.gov.si", 200, "")), robots_scope="target")
    assert table(later["page"].filter("page_type_code = 'FRONTIER'"), "url") == [("https://a.gov.si/yes/",)]


def test_sitemaps_without_robots_files(spark):
    maps = spark.createDataFrame([("https://a.gov.si/sitemap.xml", "a.gov.si", 200, "<loc>https://a.gov.si/mapped</loc>")], schemas.schema("sitemap_files"))
    _, delta = run(spark, [f"{A}/p/"], [fetch(1, f"{A}/p/", "<p>")], sitemap_files=maps)
    assert table(delta["page"].filter("page_type_code = 'FRONTIER'"), "url") == [("https://a.gov.si/mapped/",)]


def test_forbidden_site_stays_forbidden(spark):
    urls = [f"{A}/1/", f"{A}/2/"]
    files = robots(spark, ("a.gov.si", 403, None))
    for status, opened in ((403, 0), (404, 1)):
        files = robots(spark, ("a.gov.si", status, None))
        before, delta = run(spark, urls, [fetch(1, urls[0], '<a href="/x"></a>')], robots_files=files)
        assert delta["page"].filter("page_type_code = 'FRONTIER'").count() == opened
        known = apply_wave(before, delta)
        later = crawl_wave(known, fetches(spark, fetch(2, urls[1], '<a href="/y"></a>')), robots_files=files)
        assert later["page"].filter("page_type_code = 'FRONTIER'").count() == opened


def test_redirect_onto_known_page_keeps_it(spark):
    urls = [f"{A}/old/", f"{A}/r/"]
    before, delta = run(spark, urls[:1], [fetch(1, urls[0], "<p>same")])
    known = apply_wave(before, delta)
    extra = schemas.conform(spark.createDataFrame([(2, "CRAWLING", urls[1])], "id long, page_type_code string, url string"), "page")
    known["page"] = known["page"].unionByName(extra)
    after = apply_wave(known, crawl_wave(known, fetches(spark, fetch(5, urls[1], "<p>same", final=urls[0]))))
    assert table(after["page"], "id", "page_type_code", "html_content") == [(1, "HTML", "<p>same"), (2, "REDIRECT", None)]
    assert table(after["link"], "from_page", "to_page") == [(2, 1)]
    failed = apply_wave(after, crawl_wave(after, fetches(spark, fetch(6, urls[0], None, status=None, error="net::X at y"))))
    assert table(failed["page"].filter("id = 1"), "page_type_code", "html_content", "http_status_code") == [("FAILED", "<p>same", 200)]


GRAPH = [("/", '<a href="/a/"></a><a href="/b/"></a>'), ("/a/", '<a href="/b/"></a><a href="/c/"></a>'), ("/b/", '<a href="/"></a><a href="/d/"></a>'),
         ("/c/", '<a href="/a/"></a>'), ("/d/", '<a href="/a/"></a>'), ("/e/", "<p>never reached")]


def test_discovery_reaches_a_fixpoint(spark):
    rows = [fetch(i, A + path, html, final=A + "/moved/" if path == "/b/" else None) for i, (path, html) in enumerate(GRAPH, 1)]
    store = CrawlStore(spark, tempfile.mkdtemp(prefix="run-")).reset([A + "/", A + "/gone/"])
    waves = discover(store, fetches(spark, *rows), per_wave=2)
    assert waves >= 3
    kinds = dict(table(store.page(), "url", "page_type_code"))
    assert kinds == {A + "/": "HTML", A + "/gone/": "CRAWLING", A + "/a/": "HTML", A + "/b/": "REDIRECT", A + "/moved/": "HTML",
                     A + "/c/": "HTML", A + "/d/": "DUPLICATE"}
    urls = {r.id: r.url.removeprefix(A) for r in store.page().collect()}
    assert {(urls[f], urls[t]) for f, t in table(store.table("link"), "from_page", "to_page")} == {
        ("/", "/a/"), ("/", "/b/"), ("/a/", "/c/"), ("/b/", "/moved/"), ("/moved/", "/d/"), ("/d/", "/c/")}
    assert store.page().groupBy("id").count().filter("count > 1").isEmpty()
    assert store.table("link").distinct().count() == store.table("link").count()
    assert store.reset([A + "/"]).page().count() == 1


def test_store_skips_finished_waves(spark):
    store = CrawlStore(spark, tempfile.mkdtemp(prefix="run-")).reset([A + "/"])
    batch = fetches(spark, fetch(1, A + "/", '<a href="/x"></a>'))
    assert fold(store, batch, wave=1) == 1
    first = table(store.page(), "id", "url", "page_type_code")
    assert fold(store, batch, wave=1) == 1 and store.wave() == 1
    assert table(store.page(), "id", "url", "page_type_code") == first == [(1, A + "/", "HTML"), (2, A + "/x/", "FRONTIER")]
    fold(store, fetches(spark, fetch(2, A + "/x/", "<p>", final=A + "/")), wave=2)
    assert table(store.page(), "id", "page_type_code", "html_content") == [(1, "HTML", "<p>"), (2, "REDIRECT", None)]


def test_requests_of_a_wave(spark):
    """Robots file first, then sitemaps, pages and downloads; a host without an address asks nobody."""
    urls = [f"{A}/{n}/" for n in ("p", "doc", "nodns", "b")]
    rows = [fetch(1, urls[0], "<p>one"), fetch(2, urls[1], None, kind="application/x-tar"), fetch(3, urls[2], "<p>x", ip=None), fetch(4, "https://b.gov.si/", "<p>b", ip="1")]
    files = robots(spark, ("a.gov.si", 200, "User-agent: *\nCrawl-delay: 7\nSitemap: https://a.gov.si/s.xml"), ("b.gov.si", 404, ""))
    maps = spark.createDataFrame([("https://a.gov.si/s.xml", "a.gov.si", 200, "<loc>https://a.gov.si/t.xml</loc><loc>https://a.gov.si/mapped</loc>")], schemas.schema("sitemap_files"))
    before = state(spark, [*urls[:3], "https://b.gov.si/"])
    clocks = (spark.createDataFrame([("a.gov.si", 100)], "domain string, free_at long"), spark.createDataFrame([("1", 90)], "ip string, free_at long"))
    delta = crawl_wave(before, fetches(spark, *rows), robots_files=files, sitemap_files=maps, now=50, clocks=clocks)
    assert table(delta["schedule"], "id", "kind", "url", "delay", "start") == sorted([
        (1, "robots", f"{A}/robots.txt", 5, 100), (2, "sitemap", f"{A}/s.xml", 7, 105), (3, "sitemap", f"{A}/t.xml", 7, 112), (4, "page", urls[0], 7, 119),
        (5, "page", urls[1], 7, 126), (6, "download", urls[1], 7, 133), (7, "robots", "https://b.gov.si/robots.txt", 5, 140),
        (8, "sitemap", "https://b.gov.si/sitemap.xml", 5, 145), (9, "page", "https://b.gov.si/", 5, 150)], key=str)
    assert table(delta["clock"], "kind", "name", "free_at") == [("domain", "a.gov.si", 140), ("domain", "b.gov.si", 155), ("ip", "1", 155)]


def test_discovery_obeys_its_schedule(spark):
    pages = [fetch(1, f"{A}/", '<a href="/x"></a><a href="/y"></a>'), fetch(2, f"{A}/x/", '<a href="/z"></a>'), fetch(3, f"{A}/y/", "<p>y", ip="2"), fetch(4, f"{A}/z/", "<p>z")]
    store = CrawlStore(spark, tempfile.mkdtemp(prefix="run-")).reset([f"{A}/"])
    assert discover(store, fetches(spark, *pages), now=0) == 3
    assert table(store.table("schedule"), "seq", "kind", "arrival", "start") == [(1, "page", 0, 0), (2, "page", 0, 5), (3, "page", 0, 10), (4, "page", 10, 15)]
    domains, addresses = store.clocks()
    assert table(domains, "domain", "free_at") == [("a.gov.si", 20)] and table(addresses, "ip", "free_at") == [("1", 20), ("2", 15)]
    store.reset([f"{A}/"])
    assert store.now() is None and store.clocks()[0].collect() == []
    assert discover(store, fetches(spark, *pages), now=0, until=6) == 2  # the third wave would begin at 10
    assert table(store.page().filter("page_type_code = 'FRONTIER'"), "url") == [(f"{A}/z/",)]


def test_laid_out_fetches_are_read_by_folder(spark, tmp_path):
    rows = [fetch(k, f"{A}/{k}/", "".join(f'<a href="/{n}">n</a>' for n in range(10, 18)) if k == 3 else None) for k in range(60)]
    rows += [fetch(100 + k, f"{A}/{k}/", "again") for k in range(5)]
    given = fetches(spark, *rows)
    inputs.write_fetches(given, f"{tmp_path}/laid", digits=2)
    laid = inputs.read_fetches(spark, f"{tmp_path}/laid")
    assert table(laid.drop("url_part"), *given.columns) == table(given, *given.columns)

    stores = []
    for name, source in (("plain", given), ("laid", laid)):
        store = CrawlStore(spark, f"{tmp_path}/store-{name}").reset([f"{A}/3/"])
        discover(store, source, max_waves=2)
        stores.append(table(store.page(), "id", "url", "page_type_code", "html_content"))
    assert stores[0] == stores[1] and len(stores[0]) == 9

    # Folders of other URLs are not opened: theirs hold no Parquet any more.
    asked = [f"{A}/3/", f"{A}/17/", f"{A}/unknown/"]
    kept = {hashlib.md5(u.encode()).hexdigest()[:2] for u in asked}
    for name in glob.glob(f"{tmp_path}/laid/url_part=*/*.parquet"):
        if name.split("url_part=")[1][:2] not in kept:
            with open(name, "wb") as f:
                f.write(b"no table")
    spark.catalog.clearCache()
    urls = spark.createDataFrame([(u,) for u in asked + asked], "url string")
    found = inputs.fetches_of(inputs.read_fetches(spark, f"{tmp_path}/laid"), urls)
    assert found.columns == given.columns and sorted(r.seq for r in found.collect()) == [3, 17, 103]
    assert inputs.fetches_of(laid, urls.filter("url is null")).count() == 0
    with pytest.raises(ValueError):
        inputs.write_fetches(given, f"{tmp_path}/other", digits=5)


def test_ids_come_from_the_marker(spark, tmp_path, monkeypatch):
    store = CrawlStore(spark, str(tmp_path / "store")).reset([f"{A}/a/", f"{A}/b/"])
    assert store.marks() == {"page": 2, "site": 0, "image": 0, "page_data": 0}

    def unread(*_):
        raise AssertionError("a wave reads a table for its largest id")

    monkeypatch.setattr("crawlspark.operators.ids.max_id", unread)
    html = '<a href="/c">c</a><a href="/f.pdf">f</a><img src="/i.png"><img src="/j.png">'
    fold(store, fetches(spark, fetch(1, f"{A}/a/", html)), robots_files=robots(spark, ("a.gov.si", 404, None)))
    assert store.marks() == {"page": 3, "site": 1, "image": 2, "page_data": 1}
    fold(store, fetches(spark, fetch(2, f"{A}/b/", '<a href="/d">d</a>')), robots_files=robots(spark, ("a.gov.si", 404, None)))
    assert table(store.page(), "id", "url") == [(1, f"{A}/a/"), (2, f"{A}/b/"), (3, f"{A}/c/"), (4, f"{A}/d/")]
    assert store.marks() == {"page": 4, "site": 1, "image": 2, "page_data": 1}
    assert store.reset([]).marks() == {"page": 0, "site": 0, "image": 0, "page_data": 0}


def test_pages_of_one_type_are_read_alone(spark, tmp_path):
    store = CrawlStore(spark, str(tmp_path / "store")).reset([f"{A}/{n}/" for n in "abc"])
    fold(store, fetches(spark, fetch(1, f"{A}/a/", "<p>x"), fetch(2, f"{A}/b/", None, error="net::ERR_FAILED at x")))
    html = store.page().filter("page_type_code = 'HTML'").select("url", "html_content")
    assert table(html, "url", "html_content") == [(f"{A}/a/", "<p>x")]
    read = store.done_pages().filter("page_type_code = 'HTML'").select("url", "html_content")
    assert [f.split("page_done/")[1].split("/part")[0] for f in read.inputFiles() if "page_done" in f] == ["wave=1/page_type_code=HTML"] or (
        "PartitionFilters: [" in (plan := read._jdf.queryExecution().executedPlan().toString()) and "(page_type_code" in plan.split("PartitionFilters: [", 1)[1])


def test_text_is_scanned_where_it_lies(spark):
    from crawlspark.operators import html

    rows = fetches(spark, *[fetch(k, f"{A}/{k}/", f'<a href="/x{k}">') for k in range(50)]).repartition(3)
    scanned = html.scan(rows.filter("html <> ''"), ["seq"])
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "RoundRobin" in plan
    assert table(scanned, "seq", "target") == sorted(((k, f"/x{k}") for k in range(50)), key=str)
