"""HTML operators over all pages, and exact duplicates over pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlspark.catalog.fixtures import AGENT, PATTERN, canonical_sql
from crawlspark.operators import dedupe, html, outcome, robots, tables


def _find(t, policies=True):
    known = robots.policies(t.fx_robots, AGENT) if policies else None
    return html.find_links(t.fx_pages, known, pattern=PATTERN)


def _marked(t):
    rows = dedupe.hashed(t.documents, "text", ["doc_id"])
    rows = rows.withColumns({"seq": F.col("doc_id"), "site_id": F.lit(None).cast("long")})
    return dedupe.mark_duplicates(rows, key="doc_id")


def frontier(t):
    """New URLs of all pages with the page that finds each first."""
    found = html.find_links(t.pages, pattern=PATTERN).select("url", F.col("page_id").alias("seq"), F.col("page_id").alias("from_page"))
    return tables.discovery_edges(found, t.pages).select("url", "from_page")


QUERIES = {
    "flagship_frontier": frontier,
    "html_elements": lambda t: html.elements(t.pages).select("page_id", "pos", "tag", F.col("attrs")["href"].alias("href"),
                                                             F.col("attrs")["lang"].alias("lang")),
    "link_candidates": lambda t: html.link_candidates(t.fx_pages, ["page_id"]),
    "onclick_assignments": lambda t: html.clickables(t.fx_pages, ["page_id"])
        .select("page_id", html.onclick_assignment(F.col("onclick")).alias("target")).filter("target IS NOT NULL"),
    "onclick_calls": lambda t: html.clickables(t.fx_pages, ["page_id"])
        .select("page_id", html.onclick_call(F.col("onclick")).alias("target")).filter("target IS NOT NULL"),
    "page_links": _find,
    "page_scan": lambda t: html.scan(t.fx_pages, ["page_id"]).drop("pos"),
    "page_images": lambda t: html.find_images(t.fx_pages, ["page_id"]).select("page_id", "filename", "content_type"),
    "binary_split_documents": lambda t: html.document_links(_find(t, False)),
    "binary_split_links": lambda t: html.page_links(_find(t, False)),
    "content_hash": lambda t: t.pages.select("page_id", html.content_hash(F.col("html")).alias("hash")),
    "link_counts": lambda t: html.link_counts(_find(t, False)),
    "exact_duplicates": lambda t: _marked(t).select("doc_id", "original_id"),
    "duplicate_rows": lambda t: dedupe.duplicate_rows(_marked(t), "doc_id").select("id", "site_id", "page_type_code"),
    "duplicate_edges": lambda t: dedupe.duplicate_edges(_marked(t), "doc_id"),
    "redirects": lambda t: _outcomes(t).filter("is_redirect").select("seq", "current_url", "page_url"),
    "document_types": lambda t: t.fx_fetches.select("seq", outcome.data_type(F.col("content_type")).alias("code")),
    "fetch_outcomes": lambda t: _outcomes(t).select("seq", "outcome", "is_redirect", "document"),
    "error_report": lambda t: outcome.error_report(t.fx_fetches),
    "fetch_scan": lambda t: t.fx_fetches.select("seq", "final_url", "http_status", F.length("html").alias("n_chars"),
                                                F.col("accessed_time").cast("string").alias("accessed_time")),
}


def _outcomes(t):
    return outcome.with_outcome(t.fx_fetches.withColumn("has_text", F.col("html") != "").drop("html").withColumn("current_url", F.col("requested_url")))


_CANON = canonical_sql("url")
_ALL_LINKS = f"SELECT DISTINCT page_id, {_CANON} AS url FROM ox_links"
# Verdict of the fixture robots files on a completed link.
_VERDICT = r"""CASE WHEN r.http_status IN (403, 500) THEN false WHEN r.http_status = 404 THEN true
    WHEN starts_with(path, '/the') THEN false WHEN starts_with(path, '/d/') THEN true WHEN starts_with(path, '/p/1') THEN false ELSE true END"""
ALLOWED_LINKS = rf"""SELECT page_id, url FROM (SELECT page_id, host, url, regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) AS path FROM ox_links) AS l
    JOIN fx_robots r ON r.domain = l.host WHERE {_VERDICT}"""
_FIRST = "SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text ORDER BY doc_id) AS first FROM documents"
_DOWN = "(html IS NULL AND error IS NULL)"
OUTCOME_SQL = rf"""SELECT seq, requested_url, current_url, page_url, ip, document, outcome, ip IS NOT NULL AND outcome <> 'FAILED' AND current_url <> page_url AS is_redirect
    FROM (SELECT *, CASE WHEN ip IS NULL THEN 'CRAWLING' WHEN error IS NOT NULL OR (down AND document IS NULL) THEN 'FAILED' WHEN down THEN 'BINARY'
        WHEN coalesce(html, '') = '' THEN 'CRAWLING' ELSE 'HTML' END AS outcome
      FROM (SELECT *, requested_url AS current_url, {_DOWN} AS down,
          CASE WHEN {_DOWN} AND http_status = 200 AND content_type = 'application/pdf' THEN 'PDF' END AS document,
          {canonical_sql(f"CASE WHEN {_DOWN} THEN requested_url ELSE final_url END")} AS page_url FROM fx_fetches) AS a) AS b"""

ORACLES = {
    "flagship_frontier": rf"""SELECT url, min(page_id) AS from_page FROM (SELECT page_id, {_CANON} AS url FROM (SELECT page_id,
        split_part(url, '://', 1) || '://' || split_part(url, '/', 3) || unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS url FROM pages) AS a) AS b
        WHERE url NOT IN (SELECT url FROM pages) GROUP BY url""",
    "html_elements": r"""SELECT page_id, pos - 1 AS pos, lower(regexp_extract(tag, '^<([a-zA-Z0-9]+)', 1)) AS tag,
        CASE WHEN contains(tag, ' href=') THEN regexp_extract(tag, ' href="([^"]*)"', 1) END AS href,
        CASE WHEN contains(tag, ' lang=') THEN regexp_extract(tag, ' lang="([^"]*)"', 1) END AS lang
        FROM (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos
        FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<[a-zA-Z][^>]*>') AS tags FROM pages) AS a) AS b""",
    "link_candidates": r"""SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS target FROM fx_pages
        UNION ALL SELECT page_id, regexp_extract(html, '^<div onclick=''location[^"]*"([^"]*)"', 1) FROM fx_pages WHERE page_id % 3 < 2""",
    "onclick_assignments": "SELECT page_id, '/p/' || page_id AS target FROM pages WHERE page_id % 3 = 0",
    "onclick_calls": "SELECT page_id, '/q/' || page_id AS target FROM pages WHERE page_id % 3 = 1",
    "page_links": f"SELECT DISTINCT page_id, {_CANON} AS url FROM ({ALLOWED_LINKS}) AS a",
    "page_scan": r"""SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS target, NULL AS filename, NULL AS content_type FROM fx_pages
        UNION ALL SELECT page_id, regexp_extract(html, '^<div onclick=''location[^"]*"([^"]*)"', 1), NULL, NULL FROM fx_pages WHERE page_id % 3 < 2
        UNION ALL SELECT page_id, NULL, '' || page_id, 'PNG' FROM fx_pages WHERE page_id % 2 = 0""",
    "page_images": "SELECT page_id, '' || page_id AS filename, 'PNG' AS content_type FROM pages WHERE page_id % 2 = 0",
    "binary_split_documents": f"""SELECT page_id, url, CASE WHEN ends_with(url, '.pdf') THEN 'PDF' ELSE 'DOCX' END AS data_type_code
        FROM ({_ALL_LINKS}) AS a WHERE ends_with(url, '.pdf') OR ends_with(url, '.docx')""",
    "binary_split_links": f"SELECT page_id, url FROM ({_ALL_LINKS}) AS a WHERE NOT (ends_with(url, '.pdf') OR ends_with(url, '.docx'))",
    "content_hash": "SELECT page_id, sha256(html) AS hash FROM pages",
    "link_counts": f"SELECT page_id, count(*) AS n_links FROM ({_ALL_LINKS}) AS a GROUP BY page_id",
    "exact_duplicates": f"SELECT doc_id, CASE WHEN first <> doc_id THEN first END AS original_id FROM ({_FIRST}) AS a",
    "duplicate_rows": f"SELECT doc_id AS id, CAST(NULL AS BIGINT) AS site_id, 'DUPLICATE' AS page_type_code FROM ({_FIRST}) AS a WHERE first <> doc_id",
    "duplicate_edges": f"SELECT doc_id AS from_page, first AS to_page FROM ({_FIRST}) AS a WHERE first <> doc_id",
    "redirects": f"SELECT seq, current_url, page_url FROM ({OUTCOME_SQL}) AS o WHERE is_redirect",
    "document_types": "SELECT seq, CASE split_part(content_type, ';', 1) WHEN 'application/pdf' THEN 'PDF' WHEN 'text/html' THEN 'HTML' END AS code FROM fx_fetches",
    "fetch_outcomes": f"SELECT seq, outcome, is_redirect, document FROM ({OUTCOME_SQL}) AS o",
    "error_report": """SELECT split_part(error, ' at ', 1) AS error, split_part(error, ' at ', 1) = 'net::ERR_CONNECTION_RESET' AS quiet, count(*) AS n
        FROM fx_fetches WHERE error IS NOT NULL GROUP BY 1, 2""",
    "fetch_scan": "SELECT seq, final_url, http_status, length(html) AS n_chars, CAST(accessed_time AS VARCHAR) AS accessed_time FROM fx_fetches",
}
