"""Table writes, set operations and reports over a crawl in progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark import schemas
from crawlspark.catalog.fixtures import canonical_sql
from crawlspark.functions import urls as U
from crawlspark.operators import dedupe, tables


def _shown(page):
    """A page table with text and time in a comparable form."""
    return page.select("id", "site_id", "page_type_code", "url", F.length("html_content").cast("long").alias("n_chars"), "html_content_hash",
                       "http_status_code", F.col("accessed_time").cast("string").alias("accessed_time"))


def _seeded(t):
    """Start URLs, then every page URL that is not one of them."""
    seeds = [*C.SEED_URLS]
    page = schemas.seed_tables(t.spark, seeds)["page"]
    return page.unionByName(tables.add_to_frontier(page, t.pages.select("url", "page_id"), ["page_id"])).select("id", "url", "page_type_code")


def _site(t):
    """Known sites: the even-length half of the hosts."""
    keys = t.fx_hosts.select(U.site_key(F.col("host")).alias("domain")).filter(F.length("domain") % 2 == 0).distinct()
    return keys.select(F.length("domain").cast("long").alias("id"), "domain")


def _get_or_create_page(t):
    wanted = t.fx_found.select("url", "seq", F.lit(None).cast("long").alias("site_id"))
    _, known = tables.get_or_create_pages(t.fx_page, wanted, ["seq"])
    return known


def _get_or_create_site(t):
    wanted = t.pages.select(U.netloc(F.col("url")).alias("domain"), F.col("page_id").alias("seq"))
    new, _ = tables.get_or_create_sites(_site(t), wanted, ["seq"])
    return new.select("id", "domain")


def _images(t):
    new = t.pages.filter("page_id % 3 < 2").select("page_id", F.concat(F.lit("i"), F.col("page_id")).alias("filename"),
                                                   F.lit("PNG").alias("content_type"))
    old = schemas.conform(t.pages.filter("page_id % 3 = 2").select(
        F.col("page_id").alias("id"), "page_id", F.lit("old").alias("filename"), F.lit("JPG").alias("content_type")), "image")
    return tables.append_images(old, new, ["page_id"]).select("id", "page_id", "filename", "content_type")


def _page_data(t):
    dims = schemas.seed_tables(t.spark)
    new = t.pages.select("page_id", F.element_at(F.array(*map(F.lit, ["PDF", "TAR", "DOCX"])), (F.col("page_id") % 3 + 1).cast("int"))
                         .alias("data_type_code"))
    return tables.append_page_data(dims["page_data"], new, dims["data_type"], ["page_id"]).select("id", "page_id", "data_type_code")


def _edges(t):
    return t.orders.select(F.col("o_custkey").alias("from_page"), (F.col("o_orderkey") % 50).alias("to_page"))


def _known_edges(t):
    return t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("from_page"), (F.col("o_orderkey") % 50).alias("to_page")).distinct()


def _discovery(t):
    return tables.discovery_edges(t.fx_found, t.fx_page)


def _edge_table(t):
    moved = t.fx_page.filter("page_type_code = 'FAILED'").select(F.col("id").alias("from_page"), (F.col("id") + 1).alias("to_page"))
    rows = t.fx_fetches.filter("html IS NOT NULL").select("seq", F.col("seq").alias("id"), F.lit(0).cast("long").alias("site_id"),
                                                          F.md5("html").alias("html_hash"))
    copies = dedupe.duplicate_edges(dedupe.mark_duplicates(rows))
    found = _discovery(t).select("from_page", F.length("url").cast("long").alias("to_page"))
    return tables.edge_table(moved, copies, found)


_url_sets = (lambda t: U.canonicalize(t.fx_found.select("url"), "url"), lambda t: U.canonicalize(t.pages.select("url"), "url"))

QUERIES = {
    "seed_tables": _seeded,
    "update_page": lambda t: _shown(tables.update_page(t.fx_page, t.fx_updates)),
    "mark_redirect": lambda t: _shown(tables.mark_redirect(t.fx_page, t.fx_updates.select("id", "site_id", "accessed_time"))),
    "mark_failed": lambda t: _shown(tables.mark_failed(t.fx_page, t.fx_updates.select("id", "site_id"))),
    "get_or_create_page": _get_or_create_page,
    "get_or_create_site": _get_or_create_site,
    "append_images": _images,
    "append_page_data": _page_data,
    "add_links": lambda t: tables.add_links(_known_edges(t), _edges(t)),
    "add_to_frontier": lambda t: tables.add_to_frontier(t.fx_page, t.fx_found.select("url", "seq"), ["seq"]).select("id", "url", "page_type_code"),
    "remove_pages": lambda t: tables.remove_pages(t.fx_page, t.fx_updates).select("id", "url"),
    "surrogate_ids": lambda t: tables.ids.with_rank(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "id")
        .select("id", "o_orderkey"),
    "site_lookup": lambda t: tables.site_lookup(
        t.pages.select("page_id", U.site_key(U.netloc(F.col("url"))).alias("domain")), _site(t)),
    "url_union": lambda t: _url_sets[0](t).unionByName(_url_sets[1](t)).distinct(),
    "url_difference": lambda t: _url_sets[0](t).distinct().join(_url_sets[1](t), "url", "left_anti"),
    "discovery_edges": _discovery,
    "edge_table": _edge_table,
    "html_page_count": lambda t: tables.html_page_count(t.fx_page),
    "frontier_urls": lambda t: tables.frontier_urls(t.fx_page),
    "frontier_size": lambda t: tables.frontier_urls(t.fx_page).agg(F.count(F.lit(1)).alias("n_urls")),
    "pop_frontier": lambda t: tables.pop_frontier(t.fx_page, 20),
    "mark_crawling": lambda t: _shown(tables.mark_crawling(t.fx_page, tables.pop_frontier(t.fx_page, 20))),
    "status_report": lambda t: tables.status_report(t.fx_page),
}

_PAGE = """id, site_id, page_type_code, url, length(html_content) AS n_chars, html_content_hash, http_status_code,
    CAST(accessed_time AS VARCHAR) AS accessed_time"""


def _merged(columns: dict[str, str], updates: str = "fx_updates") -> str:
    """SQL of a keyed merge: new values where an update exists."""
    names = ("site_id", "page_type_code", "html_content", "html_content_hash", "http_status_code", "accessed_time")
    picked = ", ".join(f"CASE WHEN u.id IS NULL THEN p.{n} ELSE {columns.get(n, 'p.' + n)} END AS {n}" for n in names)
    return f"SELECT {_PAGE} FROM (SELECT p.id, p.url, {picked} FROM fx_page p LEFT JOIN ({updates}) u ON u.id = p.id) AS m"


_ALL = "SELECT * FROM fx_updates"
_NEW = """SELECT url, min(seq) AS seq FROM fx_found WHERE url NOT IN (SELECT url FROM fx_page) GROUP BY url"""
_NUMBERED = f"SELECT url, (SELECT max(id) FROM fx_page) + row_number() OVER (ORDER BY seq) AS id FROM ({_NEW}) AS n"
_SITES = "SELECT DISTINCT length(replace(host, 'www.', '')) AS id, replace(host, 'www.', '') AS domain FROM fx_hosts WHERE length(replace(host, 'www.', '')) % 2 = 0"
_POPPED = "SELECT id, url FROM fx_page WHERE page_type_code = 'FRONTIER' ORDER BY id LIMIT 20"
_SEEDS = "(VALUES " + ", ".join(f"({i}, '{u}')" for i, u in enumerate(C.SEED_URLS, 1)) + ") AS s(id, url)"
_DISCOVERY = "SELECT url, min(seq) AS seq, min(from_page) AS from_page FROM fx_found WHERE url NOT IN (SELECT url FROM fx_page) GROUP BY url"
_SETS = (f"SELECT {canonical_sql('url')} AS url FROM fx_found", f"SELECT {canonical_sql('url')} AS url FROM pages")

ORACLES = {
    "seed_tables": f"""SELECT id, url, 'FRONTIER' AS page_type_code FROM {_SEEDS}
        UNION ALL SELECT 4 + row_number() OVER (ORDER BY page_id), url, 'FRONTIER' FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url) AS p""",
    "update_page": _merged({"site_id": "u.site_id", "page_type_code": "'HTML'", "html_content": "u.html_content", "html_content_hash": "u.html_content_hash",
                            "http_status_code": "u.http_status_code", "accessed_time": "u.accessed_time"}, _ALL),
    "mark_redirect": _merged({"site_id": "u.site_id", "page_type_code": "'REDIRECT'", "http_status_code": "301", "accessed_time": "u.accessed_time"}, _ALL),
    "mark_failed": _merged({"site_id": "coalesce(u.site_id, p.site_id)", "page_type_code": "'FAILED'"}, _ALL),
    "get_or_create_page": f"""SELECT url, id FROM (SELECT url, id FROM fx_page UNION ALL {_NUMBERED}) AS k WHERE url IN (SELECT url FROM fx_found)""",
    "get_or_create_site": f"""SELECT (SELECT max(id) FROM ({_SITES}) AS s) + row_number() OVER (ORDER BY seq) AS id, domain FROM
        (SELECT replace(split_part(url, '/', 3), 'www.', '') AS domain, min(page_id) AS seq FROM pages GROUP BY 1) AS n WHERE length(domain) % 2 = 1""",
    "append_images": """SELECT page_id AS id, page_id, 'old' AS filename, 'JPG' AS content_type FROM pages WHERE page_id % 3 = 2
        UNION ALL SELECT (SELECT max(page_id) FROM pages WHERE page_id % 3 = 2) + row_number() OVER (ORDER BY page_id), page_id, 'i' || page_id, 'PNG'
        FROM pages WHERE page_id % 3 < 2""",
    "append_page_data": """SELECT row_number() OVER (ORDER BY page_id) AS id, page_id,
        CASE page_id % 3 WHEN 0 THEN 'PDF' WHEN 1 THEN 'UNKNOWN' ELSE 'DOCX' END AS data_type_code FROM pages""",
    "add_links": "SELECT DISTINCT o_custkey AS from_page, o_orderkey % 50 AS to_page FROM orders",
    "add_to_frontier": f"SELECT id, url, 'FRONTIER' AS page_type_code FROM ({_NUMBERED}) AS n",
    "remove_pages": "SELECT id, url FROM fx_page WHERE id % 4 <> 0",
    "surrogate_ids": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders",
    "site_lookup": f"""SELECT page_id, d.domain, s.id AS site_id FROM (SELECT page_id, replace(split_part(url, '/', 3), 'www.', '') AS domain FROM pages) AS d
        LEFT JOIN ({_SITES}) AS s ON s.domain = d.domain""",
    "url_union": f"{_SETS[0]} UNION {_SETS[1]}",
    "url_difference": f"{_SETS[0]} EXCEPT {_SETS[1]}",
    "discovery_edges": _DISCOVERY,
    "edge_table": f"""SELECT id AS from_page, id + 1 AS to_page FROM fx_page WHERE page_type_code = 'FAILED'
        UNION SELECT seq, first FROM (SELECT seq, first_value(seq) OVER (PARTITION BY html ORDER BY seq) AS first FROM fx_fetches WHERE html IS NOT NULL) AS d
        WHERE first <> seq UNION SELECT from_page, length(url) FROM ({_DISCOVERY}) AS n""",
    "html_page_count": "SELECT count(*) AS n_html FROM fx_page WHERE page_type_code = 'HTML'",
    "frontier_urls": "SELECT DISTINCT url FROM fx_page WHERE page_type_code = 'FRONTIER'",
    "frontier_size": "SELECT count(DISTINCT url) AS n_urls FROM fx_page WHERE page_type_code = 'FRONTIER'",
    "pop_frontier": _POPPED,
    "mark_crawling": _merged({"page_type_code": "'CRAWLING'"}, f"SELECT id FROM ({_POPPED}) AS p"),
    "status_report": "SELECT page_type_code, count(*) AS n_pages FROM fx_page GROUP BY page_type_code",
}
