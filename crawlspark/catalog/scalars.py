"""URL columns over the URLs and links of all pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlspark.catalog.fixtures import PATTERN, canonical_sql, normal_sql
from crawlspark.functions import urls as U
from crawlspark.operators import html, outcome


def _url():
    return F.col("url")


def _links(t):
    """Completed links of all pages: page_id, host, url; repeats of one page fold."""
    return html.filled_links(t.fx_pages, pattern=PATTERN)


def _targets(t):
    """Raw link texts of all pages."""
    return html.link_candidates(t.fx_pages, ["page_id"]).select("page_id", F.col("target").alias("url"))


QUERIES = {
    "url_split": lambda t: t.pages.select("page_id", U.split_url(_url()).alias("s")).select("page_id", "s.*"),
    "is_url": lambda t: t.pages.select("page_id", F.explode(F.array(
        _url(), F.concat(F.lit("#"), _url()), F.concat(F.lit("mailto:"), _url()), F.regexp_replace(_url(), "^[^?]*", ""), F.lit(""))).alias("text"))
        .select("page_id", "text", U.is_url(F.col("text")).alias("ok")),
    "fill_url": lambda t: html.link_candidates(t.fx_pages, ["page_id", "url"])
        .select("page_id", U.fill_url(F.col("target"), _url()).alias("filled")),
    "normalize_url": lambda t: U.normalize_url(t.pages.select("page_id", U.drop_query(U.drop_fragment(_url())).alias("url")), "url"),
    "drop_query": lambda t: t.pages.select("page_id", U.drop_query(_url()).alias("url")),
    "drop_fragment": lambda t: t.pages.select("page_id", U.drop_fragment(_url()).alias("url")),
    "end_with_slash": lambda t: t.pages.select("page_id", U.end_with_slash(_url()).alias("url")),
    "canonical_urls": lambda t: U.canonicalize(t.pages.select("url").unionByName(_links(t).select("url")), "url").distinct(),
    "has_file_extension": lambda t: t.pages.select("page_id", U.has_file_extension(_url()).alias("is_file")),
    "domain_allowed": lambda t: t.pages.select("page_id", U.is_domain_allowed(_url(), r"^[^\n]*\.example\.com$").alias("allowed")),
    "binary_links": lambda t: _targets(t).select("page_id", "url", U.is_binary(_url()).alias("is_binary"), U.document_type(_url()).alias("code")),
    "extension_types": lambda t: _targets(t).select(F.regexp_extract(_url(), r"(\.[A-Za-z0-9]+)$", 1).alias("extension"))
        .filter("extension != ''").groupBy("extension").agg(F.count(F.lit(1)).alias("n"))
        .select("extension", U.extension_type(F.col("extension")).alias("code"), "n"),
    "needs_expansion": lambda t: t.pages.select("page_id", U.needs_expansion(_url()).alias("needed")),
    "expand_urls": lambda t: outcome.expand_urls(t.pages.select("page_id", "url"), t.fx_expansions, "url", "expanded")
        .select("page_id", "expanded"),
    "site_keys": lambda t: t.pages.select("page_id", U.site_key(U.netloc(_url())).alias("domain")),
    "relative_paths": lambda t: _targets(t).select("page_id", "url", U.is_relative_path(_url()).alias("relative"))
        .unionByName(t.pages.select("page_id", "url", U.is_relative_path(_url()).alias("relative"))),
    "well_known_urls": lambda t: t.pages.select("page_id", U.robots_url(_url()).alias("robots"), U.sitemap_url(_url()).alias("sitemap")),
}

# Raw link texts of the fixture pages.
_TARGETS = r"""SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS url FROM fx_pages
UNION ALL SELECT page_id, regexp_extract(html, '^<div onclick=''location[^"]*"([^"]*)"', 1) FROM fx_pages WHERE page_id % 3 < 2"""

ORACLES = {
    "url_split": r"""SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(url, '/', 3) AS netloc,
        regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, '' AS params, regexp_extract(url, '[?]([^#]*)', 1) AS query,
        regexp_extract(url, '#(.*)$', 1) AS fragment FROM pages""",
    "is_url": r"""SELECT page_id, url AS text, true AS ok FROM pages UNION ALL SELECT page_id, '#' || url, true FROM pages
        UNION ALL SELECT page_id, 'mailto:' || url, false FROM pages
        UNION ALL SELECT page_id, regexp_replace(url, '^[^?]*', ''), false FROM pages UNION ALL SELECT page_id, '', false FROM pages""",
    "fill_url": "SELECT page_id, url AS filled FROM ox_links",
    "normalize_url": f"SELECT page_id, {normal_sql('url')} AS url FROM pages",
    "drop_query": "SELECT page_id, split_part(url, '?', 1) AS url FROM pages",
    "drop_fragment": "SELECT page_id, split_part(url, '#', 1) AS url FROM pages",
    "end_with_slash": "SELECT page_id, CASE WHEN regexp_matches(url, '/[^/]+[.][^/]+$') OR ends_with(url, '/') THEN url ELSE url || '/' END AS url FROM pages",
    "canonical_urls": f"SELECT DISTINCT {canonical_sql('url')} AS url FROM (SELECT url FROM pages UNION ALL SELECT url FROM ox_links) AS a",
    "has_file_extension": "SELECT page_id, contains(regexp_replace(split_part(url, '/', -1), '^.|.$', '', 'g'), '.') AS is_file FROM pages",
    "domain_allowed": "SELECT page_id, ends_with(split_part(url, '/', 3), '.example.com') AS allowed FROM pages",
    "binary_links": f"""SELECT page_id, url, code IS NOT NULL AS is_binary, code FROM (SELECT page_id, url, CASE WHEN ends_with(url, '.pdf') THEN 'PDF'
        WHEN ends_with(url, '.docx') THEN 'DOCX' WHEN ends_with(url, '.doc') THEN 'DOC' END AS code FROM ({_TARGETS}) AS a) AS b""",
    "extension_types": f"""SELECT extension, upper(substr(extension, 2)) AS code, count(*) AS n
        FROM (SELECT regexp_extract(url, '([.][A-Za-z0-9]+)$', 1) AS extension FROM ({_TARGETS}) AS a) AS b WHERE extension <> '' GROUP BY 1, 2""",
    "needs_expansion": "SELECT page_id, NOT regexp_matches(url, '^https?://[A-Za-z0-9]+([.][A-Za-z]+){2,}') AS needed FROM pages",
    "expand_urls": """SELECT page_id, CASE WHEN page_id % 2 = 0 AND NOT regexp_matches(url, '^https?://[A-Za-z0-9]+([.][A-Za-z]+){2,}')
        THEN replace(url, 'http://', 'https://') ELSE url END AS expanded FROM pages""",
    "site_keys": "SELECT page_id, replace(split_part(url, '/', 3), 'www.', '') AS domain FROM pages",
    "relative_paths": f"SELECT page_id, url, starts_with(url, '/') OR url = '' AS relative FROM ({_TARGETS} UNION ALL SELECT page_id, url FROM pages) AS a",
    "well_known_urls": """SELECT page_id, split_part(url, '://', 1) || '://' || split_part(url, '/', 3) || '/robots.txt' AS robots,
        split_part(url, '://', 1) || '://' || split_part(url, '/', 3) || '/sitemap.xml' AS sitemap FROM pages""",
}
