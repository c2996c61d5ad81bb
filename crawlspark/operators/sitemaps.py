"""Sitemaps: the URLs of a file, the tree below an index, and the links of a site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.checkpoints import checkpointed
from crawlspark.functions import urls as U
from crawlspark.functions.entities import unescape
from crawlspark.operators import robots

_LOC = r"(?s)<loc(?:\s[^>]*)?>(.*?)</loc\s*>"


def _text(inner: Column) -> Column:
    """Text of an element body: CDATA unwrapped, inner tags dropped, references decoded outside CDATA."""
    cdata = F.regexp_extract(inner, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*\z", 1)
    return F.when(cdata != "", cdata).otherwise(unescape(F.regexp_replace(inner, r"(?s)<[^>]*>", "")))


def is_well_formed(xml: Column) -> Column:
    """Whether Spark's XML parser gets through the root element; what follows it, and undeclared prefixes, don't count."""
    tried = F.from_xml(xml, "`_bad` string, `_` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return tried.isNotNull() & tried["_bad"].isNull()


def locs(xml: Column) -> Column:
    """Array of the ``loc`` texts of a sitemap; elements of other namespaces do not count, broken XML has none."""
    body = F.regexp_replace(xml, r"(?s)<!--.*?-->", "")
    return F.when(is_well_formed(xml), F.transform(F.regexp_extract_all(body, F.lit(_LOC), F.lit(1)), _text))


def sitemap_locs(files: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """carry columns and ``loc`` for each entry of the files that were served with status 200."""
    return files.filter(F.col("http_status") == 200).select(*(carry or ["url"]), F.explode(locs(F.col("xml"))).alias("loc"))


def is_index_entry(loc: Column) -> Column:
    return loc.endswith(".xml") | loc.contains("sitemap.xml")


def sitemap_walk(roots: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaf URLs below the root sitemaps (domain, url) and the sitemaps opened on the way (domain, url, level).

    ``roots`` has domain, url; ``files`` url, http_status, xml.

    One round per level of the index. A sitemap is opened once per domain, so a cycle ends. The files are read once,
    into rows of (sitemap, entry) that the rounds join: no file's list moves as a whole, and a sitemap that many domains
    share is split like any hot key. The opened set and the leaves stay distributed; only the emptiness test comes back.
    """
    level = checkpointed(roots.select("domain", "url").distinct())
    opened, leaves = [level.withColumn("level", F.lit(0))], []
    served = checkpointed(sitemap_locs(files))
    while not level.isEmpty():
        found = served.join(level, "url").select("domain", F.col("loc").alias("url"))
        found = checkpointed(found.distinct())
        leaves.append(found.filter(~is_index_entry(F.col("url"))))
        seen = reduce(DataFrame.unionByName, opened)
        level = checkpointed(found.filter(is_index_entry(F.col("url"))).join(seen, ["domain", "url"], "left_anti"))
        opened.append(level.withColumn("level", F.lit(len(opened))))
    return (reduce(DataFrame.unionByName, leaves).distinct() if leaves else level), reduce(DataFrame.unionByName, opened)


def sitemap_tree(roots: DataFrame, files: DataFrame) -> DataFrame:
    """Leaf URLs below the root sitemaps: domain, url."""
    return sitemap_walk(roots, files)[0]


def root_sitemaps(sites: DataFrame, files: DataFrame | None) -> DataFrame:
    """Sitemaps to open per site: those its robots file names, else ``/sitemap.xml``.

    ``sites`` has domain and url (any URL of the site); ``files`` are the robots files, if there are any.
    """
    if files is None:
        return sites.select("domain", U.sitemap_url(F.col("url")).alias("url")).distinct()
    named = robots.robots_sitemaps(files).select("domain", F.col("url").alias("_named")).distinct()
    return (sites.select("domain", "url").join(named, "domain", "left")
            .select("domain", F.coalesce(F.col("_named"), U.sitemap_url(F.col("url"))).alias("url")).distinct())


def find_sitemap_links(sites: DataFrame, robots_files: DataFrame | None, sitemap_files: DataFrame,
                       agent: str = C.DEFAULT_AGENT, pattern: str = C.ALLOWED_NETLOC) -> DataFrame:
    """Canonical sitemap links per site that robots and domain filters let through: domain, url.

    Without ``robots_files`` nothing is disallowed.
    """
    return allowed_leaves(sitemap_tree(root_sitemaps(sites, robots_files), sitemap_files), robots_files, agent, pattern)


def allowed_leaves(leaves: DataFrame, robots_files: DataFrame | None, agent: str, pattern: str) -> DataFrame:
    links = U.canonicalize(leaves, "url").distinct().filter(U.is_domain_allowed(F.col("url"), pattern))
    return links if robots_files is None else robots.filter_allowed(links, robots.policies(robots_files, agent))
