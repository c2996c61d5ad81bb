"""Robots and sitemap operators over the hosts of all pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlspark.catalog.fixtures import AGENT, PATTERN, canonical_sql
from crawlspark.catalog.pages import ALLOWED_LINKS
from crawlspark.functions import urls as U
from crawlspark.operators import html, robots, sitemaps, tables


def _links(t):
    return html.filled_links(t.fx_pages, pattern=PATTERN).withColumnRenamed("host", "domain")


def _saved(t):
    """Site rows with robots text as a first visit keeps it."""
    return robots.site_columns(t.fx_robots)


def _sites(t):
    hosts = t.pages.select(U.netloc(F.col("url")).alias("domain"), "url")
    return tables.first_by(hosts, "domain", ["url"])


def _known_sites(t):
    """Every second host is known already."""
    return t.fx_hosts.select(U.site_key(F.col("host")).alias("domain")).filter(F.length("domain") % 2 == 0).distinct()


QUERIES = {
    "robots_rules": lambda t: robots.robots_rules(t.fx_robots).select(
        "domain", "group", F.array_join("agents", ",").alias("agents"), "rule", "allow", "path", "delay"),
    "robots_allowed": lambda t: robots.with_verdict(_links(t), robots.policies(t.fx_robots, AGENT))
        .select("page_id", "url", "allowed"),
    "robots_status": lambda t: t.fx_robots.select("domain", robots.mode(F.col("http_status"), F.col("content")).alias("mode")),
    "crawl_delays": lambda t: robots.crawl_delays(t.fx_robots, AGENT),
    "robots_sitemaps": lambda t: robots.robots_sitemaps(t.fx_robots),
    "sitemap_csv": lambda t: _saved(t).select("domain", "sitemap_content"),
    "robots_text": lambda t: _saved(t).select("domain", "robots_content"),
    "saved_robots": lambda t: robots.with_verdict(_links(t), robots.saved_policies(_saved(t), AGENT))
        .select("page_id", "url", "allowed"),
    "sitemap_locs": lambda t: sitemaps.sitemap_locs(t.fx_sitemaps),
    "sitemap_tree": lambda t: sitemaps.sitemap_tree(sitemaps.root_sitemaps(_sites(t), t.fx_robots), t.fx_sitemaps),
    "sitemap_links": lambda t: sitemaps.find_sitemap_links(_sites(t), t.fx_robots, t.fx_sitemaps, AGENT, PATTERN),
    "new_domains": lambda t: t.fx_hosts.select(U.site_key(F.col("host")).alias("domain")).distinct().join(_known_sites(t), "domain", "left_anti"),
}

_PATH = "regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1)"
_RULES = """SELECT domain, 0 AS "group", 'other' AS agents, 0 AS rule, false AS allow, '/' AS path, CAST(NULL AS BIGINT) AS delay FROM fx_robots
    UNION ALL SELECT domain, 1, '*', rule, allow, path, CASE WHEN length(domain) % 5 <> 0 THEN length(domain) % 9 END FROM fx_robots,
    (VALUES (0, false, '/the'), (1, true, '/d/'), (2, false, '/p/1')) AS r(rule, allow, path)"""
_NAMED = """SELECT domain, 0 AS pos, 'https://' || domain || '/sitemap.xml' AS url FROM fx_robots WHERE http_status = 200 AND length(domain) % 3 <> 0
    UNION ALL SELECT domain, 1, 'https://' || domain || '/more.xml' FROM fx_robots WHERE http_status = 200 AND length(domain) % 3 <> 0"""
# The index of a host is opened if robots names it or as the default, which has the scheme of the host's first URL.
_OPENED = """SELECT h.host AS domain FROM fx_hosts h JOIN fx_robots r ON r.domain = h.host
    JOIN (SELECT split_part(url, '/', 3) AS host, min(url) AS url FROM pages GROUP BY 1) u ON u.host = h.host
    WHERE (r.http_status = 200 AND length(h.host) % 3 <> 0) OR starts_with(u.url, 'https://')"""
_LEAVES = f"SELECT DISTINCT o.domain, p.url FROM ({_OPENED}) AS o JOIN pages p ON split_part(p.url, '/', 3) = o.domain WHERE p.page_id % 9 <> 0"
_CANON = canonical_sql("url")

ORACLES = {
    "robots_rules": _RULES,
    "robots_allowed": f"""SELECT DISTINCT l.page_id, l.url, a.url IS NOT NULL AS allowed FROM ox_links l
        LEFT JOIN ({ALLOWED_LINKS}) AS a ON a.page_id = l.page_id AND a.url = l.url""",
    "robots_status": """SELECT domain, CASE http_status WHEN 200 THEN 'rules' WHEN 404 THEN 'all' ELSE 'none' END AS mode FROM fx_robots""",
    "crawl_delays": """SELECT domain, CASE WHEN http_status = 200 AND length(domain) % 5 <> 0 THEN length(domain) % 9 ELSE 5 END AS delay FROM fx_robots""",
    "robots_sitemaps": _NAMED,
    "sitemap_csv": """SELECT domain, CASE WHEN http_status = 200 AND length(domain) % 3 <> 0
        THEN 'https://' || domain || '/sitemap.xml,https://' || domain || '/more.xml' END AS sitemap_content FROM fx_robots""",
    "robots_text": """SELECT domain, CASE WHEN http_status <> 200 THEN '' ELSE 'User-agent: other' || chr(10) || 'Disallow: /' || chr(10) || chr(10)
        || 'User-agent: *' || chr(10) || CASE WHEN length(domain) % 5 <> 0 THEN 'Crawl-delay: ' || length(domain) % 9 || chr(10) ELSE '' END
        || 'Disallow: /the' || chr(10) || 'Allow: /d/' || chr(10) || 'Disallow: /p/1' END AS robots_content FROM fx_robots""",
    "saved_robots": f"""SELECT DISTINCT page_id, l.url, r.http_status <> 200 OR NOT (starts_with({_PATH.replace('url', 'l.url')}, '/the')
        OR starts_with({_PATH.replace('url', 'l.url')}, '/p/1')) AS allowed FROM ox_links l JOIN fx_robots r ON r.domain = l.host""",
    "sitemap_locs": r"""SELECT url, replace(unnest(regexp_extract_all(xml, '<loc>([^<]*)</loc>', 1)), '&amp;', '&') AS loc FROM fx_sitemaps WHERE http_status = 200""",
    "sitemap_tree": _LEAVES,
    "sitemap_links": f"""SELECT domain, url FROM (SELECT DISTINCT domain, {_CANON} AS url FROM ({_LEAVES}) AS l) AS c JOIN fx_robots r USING (domain)
        WHERE r.http_status = 404 OR (r.http_status = 200 AND NOT starts_with({_PATH}, '/the') AND NOT starts_with({_PATH}, '/p/1'))""",
    "new_domains": "SELECT DISTINCT replace(host, 'www.', '') AS domain FROM fx_hosts WHERE length(replace(host, 'www.', '')) % 2 = 1",
}
