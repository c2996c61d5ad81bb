"""Inputs that both engines derive from the given tables with the same SQL text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The crawl allows these hosts in the given tables.
PATTERN = r"^[^\n]*\.example\.(com|net|org)$"
AGENT = "crawlspark"

FIXTURES = {
    "fx_hosts": "SELECT DISTINCT split_part(url, '/', 3) AS host FROM pages",
    # Pages with an onclick element, an image and a document link put in front of their markup.
    "fx_pages": """
SELECT page_id, url, '<div onclick=''' || CASE WHEN page_id % 3 = 0 THEN 'location.href = "/p/' || CAST(page_id AS VARCHAR(9)) || '"'
  WHEN page_id % 3 = 1 THEN 'location.assign("/q/' || CAST(page_id AS VARCHAR(9)) || '")' ELSE 'track(1)' END || '''></div><img src="/i/'
  || CAST(page_id AS VARCHAR(9)) || CASE WHEN page_id % 2 = 0 THEN '.PNG?x=1' ELSE '.txt' END || '"><a href="/d/' || CAST(page_id AS VARCHAR(9))
  || CASE WHEN page_id % 3 = 0 THEN '.pdf' WHEN page_id % 3 = 1 THEN '.PDF' ELSE '.docx' END || '">d</a>' || html AS html FROM pages""",
    # Fetches with redirects, other statuses, errors, copies and hosts without an address.
    "fx_fetches": """
SELECT p.page_id AS seq, p.url AS requested_url,
  CASE WHEN p.page_id % 13 = 0 THEN 'https://' || split_part(p.url, '/', 3) || '/moved/' ELSE p.url END AS final_url,
  CAST(CASE WHEN p.page_id % 17 = 0 THEN 404 ELSE 200 END AS INTEGER) AS http_status,
  CASE WHEN p.page_id % 7 = 0 THEN 'application/pdf' WHEN p.page_id % 7 = 1 THEN 'application/x-unknown; q=1'
    ELSE 'text/html; charset=utf-8' END AS content_type,
  CASE WHEN p.page_id % 19 = 0 THEN NULL WHEN p.page_id % 7 < 2 THEN NULL ELSE d.html END AS html,
  CASE WHEN p.page_id % 19 = 0 THEN CASE WHEN p.page_id % 2 = 0 THEN 'net::ERR_CONNECTION_RESET at ' ELSE 'net::ERR_FAILED at ' END || p.url END AS error,
  CASE WHEN p.page_id % 23 = 0 THEN NULL ELSE '10.0.0.' || CAST(length(split_part(p.url, '/', 3)) % 7 AS VARCHAR(9)) END AS ip,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' SECOND * p.page_id AS accessed_time
FROM pages p JOIN fx_pages d ON d.page_id = CASE WHEN p.page_id % 10 = 3 THEN p.page_id - 1 ELSE p.page_id END""",
    "fx_robots": """
SELECT host AS domain, CAST(CASE WHEN length(host) % 11 = 0 THEN 403 WHEN length(host) % 11 = 1 THEN 404 WHEN length(host) % 11 = 2 THEN 500
    ELSE 200 END AS INTEGER) AS http_status,
  'User-agent: other' || chr(10) || 'Disallow: /' || chr(10) || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /the' || chr(10)
  || 'Allow: /d/' || chr(10) || 'Disallow: /p/1 # old' || chr(10) || 'Crawl-delay: ' || CASE WHEN length(host) % 5 = 0 THEN 'x'
    ELSE CAST(length(host) % 9 AS VARCHAR(9)) END || CASE WHEN length(host) % 3 = 0 THEN '' ELSE chr(10) || chr(10) || 'Sitemap: https://'
  || host || '/sitemap.xml' || chr(10) || 'Sitemap: https://' || host || '/more.xml' END AS content FROM fx_hosts""",
    "fx_sitemaps": """
SELECT 'https://' || split_part(url, '/', 3) || '/sitemap' || CAST(page_id AS VARCHAR(9)) || '.xml' AS url, split_part(url, '/', 3) AS domain,
  CAST(CASE WHEN page_id % 9 = 0 THEN 404 ELSE 200 END AS INTEGER) AS http_status,
  '<urlset><url><loc>' || replace(url, '&', '&amp;') || '</loc></url><url><loc>https://' || split_part(url, '/', 3) || '/s/'
  || CAST(page_id AS VARCHAR(9)) || '.xml</loc></url></urlset>' AS xml FROM pages
UNION ALL SELECT 'https://' || split_part(url, '/', 3) || '/sitemap.xml', split_part(url, '/', 3), 200,
  '<sitemapindex>' || string_agg('<loc>https://' || split_part(url, '/', 3) || '/sitemap' || CAST(page_id AS VARCHAR(9)) || '.xml</loc>', '')
  || '</sitemapindex>' FROM pages GROUP BY split_part(url, '/', 3)""",
    "fx_expansions": """
SELECT url AS short_url, replace(url, 'http://', 'https://') AS real_url FROM pages WHERE page_id % 2 = 0""",
    # A crawl in progress: pages of all types.
    "fx_page": """
SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE page_id % 11 END AS site_id,
  CASE page_id % 5 WHEN 0 THEN 'FRONTIER' WHEN 1 THEN 'CRAWLING' WHEN 2 THEN 'HTML' WHEN 3 THEN 'FAILED' ELSE 'BINARY' END AS page_type_code,
  url, CASE WHEN page_id % 5 = 2 THEN html END AS html_content, CASE WHEN page_id % 5 = 2 THEN md5(html) END AS html_content_hash,
  CAST(CASE WHEN page_id % 5 = 2 THEN 200 END AS INTEGER) AS http_status_code,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' SECOND * page_id AS accessed_time FROM pages""",
    "fx_updates": """
SELECT page_id AS id, CASE WHEN page_id % 12 = 0 THEN NULL ELSE page_id % 7 END AS site_id, CAST(200 + page_id % 3 AS INTEGER) AS http_status_code,
  CAST('2024-02-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' SECOND * page_id AS accessed_time, 'new ' || CAST(page_id AS VARCHAR(9)) AS html_content,
  md5(CAST(page_id AS VARCHAR(9))) AS html_content_hash FROM pages WHERE page_id % 4 = 0""",
    # URLs found by pages, some of them known, some found more than once.
    "fx_found": """
SELECT page_id AS seq, page_id AS from_page, CASE WHEN page_id % 4 = 0 THEN url ELSE 'https://' || split_part(url, '/', 3) || '/n/'
  || CAST(page_id % 40 AS VARCHAR(9)) || '/' END AS url FROM pages""",
    "fx_requests": """
SELECT event_id AS id, user_id AS host, CAST(floor(value) AS BIGINT) % 9 + 1 AS delay,
  CAST((extract(DAY FROM ts) - 1) * 86400 + extract(HOUR FROM ts) * 3600 + extract(MINUTE FROM ts) * 60 + floor(extract(SECOND FROM ts)) AS BIGINT)
  AS arrival FROM events""",
    # Requests that take two clocks: some hosts have several addresses, some have none.
    "fx_shared_requests": """
SELECT id, 'h' || CAST(host AS VARCHAR(9)) AS domain, CASE WHEN id % 11 = 0 THEN NULL
  ELSE 'i' || CAST((host * 7 + CASE WHEN host % 4 = 0 THEN id % 3 ELSE 0 END) % 60 AS VARCHAR(9)) END AS ip, arrival % 3000 AS arrival, delay
FROM fx_requests""",
    # Links of pages: plain anchors and onclick targets, completed with the page's own scheme and host.
    "ox_links": r"""
SELECT page_id, host, lower(split_part(url, '://', 1)) || '://' || host || unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS url
  FROM (SELECT page_id, url, html, split_part(url, '/', 3) AS host FROM fx_pages)
UNION ALL SELECT page_id, split_part(url, '/', 3), lower(split_part(url, '://', 1)) || '://' || split_part(url, '/', 3)
  || regexp_extract(html, '^<div onclick=''location[^"]*"([^"]*)"', 1) FROM fx_pages WHERE page_id % 3 < 2""",
}

_BASE = ("pages", "documents", "events", "orders", "customer")
_NAME = re.compile(r"\b(?:fx|ox)_[a-z_]+\b")


def _needed(sql: str) -> list[str]:
    """Fixtures a text uses, in order of definition."""
    wanted: set[str] = set()
    todo = set(_NAME.findall(sql))
    while todo:
        wanted |= todo
        todo = {n for w in todo for n in _NAME.findall(FIXTURES[w])} - wanted
    return [n for n in FIXTURES if n in wanted]


def with_fixtures(sql: str, base: dict[str, str] | None = None) -> str:
    """Put the fixtures a query uses, and the given base tables, in front of it as common table expressions."""
    parts = [f"{n} AS ({FIXTURES[n]})" for n in _needed(sql)]
    text = " ".join(parts) + sql
    parts = [f"{n} AS ({s})" for n, s in (base or {}).items() if re.search(rf"\b{n}\b", text)] + parts
    body = sql.strip()
    if not parts:
        return body
    begin = re.match(r"WITH\s+(RECURSIVE\s)?", body)
    head = f"WITH {begin[1] or '' if begin else ''}" + ",\n".join(parts)
    return f"{head},\n{body[begin.end():]}" if begin else f"{head}\n{body}"


class Tables:
    """The given tables of one folder, and the fixtures over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            base = {n: f"SELECT * FROM parquet.`{self.folder}/{n}.parquet`" for n in _BASE}
            return self.spark.sql(with_fixtures(f"SELECT * FROM {name}", base))
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def encode_sql(text: str, safe: str) -> str:
    """DuckDB text that percent-encodes all but letters, digits, ``_.-~`` and ``safe``."""
    out = f"url_encode({text})"
    for c in safe:
        shown = "''" if c == "'" else c
        out = f"replace({out}, '%{ord(c):02X}', '{shown}')"
    return out


def normal_sql(url: str) -> str:
    """DuckDB text of the normal form of a plain http(s) URL, without query and fragment."""
    path = f"regexp_extract({url}, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)"
    path = f"regexp_replace({encode_sql(f'url_decode({path})', chr(126) + ':/?#[]@!$&' + chr(39) + '()*+,;=')}, '/+', '/', 'g')"
    return (f"lower(regexp_extract({url}, '^([a-zA-Z]+://[^/?#]*)', 1)) || "
            f"CASE WHEN {path} = '' THEN '/' ELSE {path} END")


def canonical_sql(url: str) -> str:
    u = normal_sql(url)
    return (f"CASE WHEN regexp_matches({u}, '/[^/]+[.][^/]+$') OR ends_with({u}, '/') THEN {u} ELSE {u} || '/' END")
