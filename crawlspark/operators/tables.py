"""Writes of the crawl tables as set operations: keyed merges, inserts that skip known keys, appends, reports.

Updates read the wide table once: a left join with the narrow updates, which Spark turns into a broadcast when they are
small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.functions import urls as U
from crawlspark.operators import ids, skew
from crawlspark.schemas import conform


def _merge(page: DataFrame, updates: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Replace columns of the pages that ``updates`` (one row per id) names; others keep their row."""
    new = updates.select("id", F.lit(True).alias("_touched"), *[F.col(c).alias(f"_{c}") for c in updates.columns if c != "id"])
    changed = {c: F.when(F.col("_touched"), v).otherwise(F.col(c)) for c, v in values.items()}
    return page.join(new, "id", "left").withColumns(changed).select(*page.columns)


def _new(updates: DataFrame, column: str, default=None) -> Column:
    return F.col(f"_{column}") if column in updates.columns else F.lit(default)


def update_page(page: DataFrame, updates: DataFrame) -> DataFrame:
    """Overwrite type, html, hash, status, site and time of pages. ``updates``: id, http_status_code, site_id,
    accessed_time and, where given, html_content, html_content_hash (else null), page_type_code (else HTML)."""
    return _merge(page, updates, {
        "page_type_code": _new(updates, "page_type_code", "HTML"),
        "html_content": _new(updates, "html_content").cast("string"),
        "html_content_hash": _new(updates, "html_content_hash").cast("string"),
        "http_status_code": F.col("_http_status_code"), "site_id": F.col("_site_id"),
        "accessed_time": F.col("_accessed_time")})


def mark_redirect(page: DataFrame, updates: DataFrame) -> DataFrame:
    """Type REDIRECT and status 301 with site and time of ``updates``; html stays."""
    return _merge(page, updates, {
        "page_type_code": F.lit("REDIRECT"), "http_status_code": F.lit(C.REDIRECT_STATUS),
        "site_id": F.col("_site_id"), "accessed_time": F.col("_accessed_time")})


def mark_failed(page: DataFrame, updates: DataFrame) -> DataFrame:
    """Type FAILED; the site is set only where ``updates`` knows one."""
    return _merge(page, updates, {
        "page_type_code": F.lit("FAILED"), "site_id": F.coalesce(_new(updates, "site_id").cast("long"), F.col("site_id"))})


def first_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``. A minimum of structs folds before the shuffle, so hot keys are cheap."""
    rest = order + [c for c in df.columns if c not in order and c != key]
    firsts = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_first"))
    return firsts.select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def insert_missing(table: DataFrame, wanted: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Rows of ``wanted`` whose key ``table`` does not have, first per key, with fresh ids, shaped as ``name``.

    Keys fold before they meet the table, so one that comes up very often is a single row in the join.
    """
    fresh = first_by(wanted, key, order).join(table.select(key), key, "left_anti")
    return conform(ids.assign_ids(fresh, ids.max_id(table), list(dict.fromkeys(order + [key]))), name)


def get_or_create_pages(page: DataFrame, wanted: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``wanted`` has url, site_id and the order columns. Returns the new FRONTIER rows, and (url, id) of all wanted."""
    new = insert_missing(page, wanted.withColumn("page_type_code", F.lit("FRONTIER")), "url", order, "page")
    known = page.select("url", "id").unionByName(new.select("url", "id"))
    return new, known.join(wanted.select("url").distinct(), "url", "left_semi")


def get_or_create_sites(site: DataFrame, wanted: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``wanted`` has domain (a host), robots_content, sitemap_content. Returns new rows, and (domain, id) by host."""
    keyed = wanted.withColumnRenamed("domain", "host").withColumn("domain", U.site_key(F.col("host")))
    new = insert_missing(site, keyed.drop("host"), "domain", order, "site")
    known = site.select("domain", "id").unionByName(new.select("domain", "id"))
    hosts = keyed.select("host", "domain").distinct()
    return new, hosts.join(known, "domain").select(F.col("host").alias("domain"), "id")


def site_lookup(rows: DataFrame, site: DataFrame) -> DataFrame:
    """Add ``site_id`` to rows with a ``domain``."""
    return skew.lookup(rows, site.select("domain", F.col("id").alias("site_id")), "domain")


def append_images(image: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    rows = conform(ids.assign_ids(new, ids.max_id(image), order), "image")
    return image.unionByName(rows)


def known_data_type(new: DataFrame, data_type: DataFrame) -> DataFrame:
    """Replace type codes the dimension lacks by UNKNOWN. The dimension has a handful of rows."""
    dim = data_type.select(F.col("code").alias("data_type_code"), F.lit(True).alias("_known"))
    return (new.join(dim, "data_type_code", "left")
            .withColumn("data_type_code", F.when(F.col("_known"), F.col("data_type_code")).otherwise("UNKNOWN"))
            .drop("_known"))


def append_page_data(page_data: DataFrame, new: DataFrame, data_type: DataFrame, order: list[str]) -> DataFrame:
    rows = conform(ids.assign_ids(known_data_type(new, data_type), ids.max_id(page_data), order), "page_data")
    return page_data.unionByName(rows)


def new_links(link: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct edges that are not in ``link`` yet."""
    return edges.select("from_page", "to_page").distinct().join(link, ["from_page", "to_page"], "left_anti")


def add_links(link: DataFrame, edges: DataFrame) -> DataFrame:
    return link.unionByName(new_links(link, edges))


def add_to_frontier(page: DataFrame, urls: DataFrame, order: list[str] | None = None) -> DataFrame:
    """New FRONTIER rows for URLs no page has, whatever its type."""
    wanted = urls.withColumn("page_type_code", F.lit("FRONTIER"))
    return insert_missing(page, wanted, "url", order or ["url"], "page")


def remove_pages(page: DataFrame, gone: DataFrame) -> DataFrame:
    return page.join(gone.select("id"), "id", "left_anti").select(*page.columns)


def discovery_edges(found: DataFrame, page: DataFrame) -> DataFrame:
    """First finder of each URL that no page has: url, seq, from_page. ``found`` has seq, from_page, url."""
    firsts = first_by(found.select("url", "seq", "from_page"), "url", ["seq", "from_page"])
    return firsts.join(page.select("url"), "url", "left_anti")


def edge_table(*kinds: DataFrame) -> DataFrame:
    """Distinct union of redirect, duplicate and discovery edges."""
    first, *rest = [k.select("from_page", "to_page") for k in kinds]
    for k in rest:
        first = first.unionByName(k)
    return first.distinct()


def html_page_count(page: DataFrame) -> DataFrame:
    return page.filter(F.col("page_type_code") == "HTML").agg(F.count(F.lit(1)).alias("n_html"))


def frontier_urls(page: DataFrame) -> DataFrame:
    return page.filter(F.col("page_type_code") == "FRONTIER").select("url").distinct()


def status_report(page: DataFrame) -> DataFrame:
    return page.groupBy("page_type_code").agg(F.count(F.lit(1)).alias("n_pages"))


# Up to this many rows a top-k is kept in memory per task; longer pops are ranked by range instead.
TOP_K = 100_000


def pop_frontier(page: DataFrame, n: int | None = None) -> DataFrame:
    """The first ``n`` FRONTIER pages by id (all if not given): id, url."""
    waiting = page.filter(F.col("page_type_code") == "FRONTIER").select("id", "url")
    if n is None:
        return waiting
    if n <= TOP_K:
        return waiting.orderBy("id").limit(n)
    return ids.with_rank(waiting, ["id"]).filter(F.col("rank") <= n).drop("rank")


def mark_crawling(page: DataFrame, popped: DataFrame) -> DataFrame:
    return _merge(page, popped.select("id"), {"page_type_code": F.lit("CRAWLING")})
