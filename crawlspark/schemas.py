"""Schemas of the crawl tables and of the inputs a user brings."""

from __future__ import annotations

import mimetypes
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark import constants as C

CRAWL_TABLES = {
    "data_type": "code string",
    "page_type": "code string",
    "site": "id long, domain string, robots_content string, sitemap_content string",
    "page": ("id long, site_id long, page_type_code string, url string, html_content string, html_content_hash string, "
             "http_status_code int, accessed_time timestamp"),
    "image": "id long, page_id long, filename string, content_type string, data binary, accessed_time timestamp",
    "link": "from_page long, to_page long",
    "page_data": "id long, page_id long, data_type_code string, data binary",
}

INPUT_TABLES = {
    "fetches": ("seq long, requested_url string, final_url string, http_status int, content_type string, html string, "
                "error string, ip string, accessed_time timestamp"),
    "robots_files": "domain string, http_status int, content string",
    "sitemap_files": "url string, domain string, http_status int, xml string",
    "url_expansions": "short_url string, real_url string",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL({**CRAWL_TABLES, **INPUT_TABLES}[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in order, cast, with null for those ``df`` lacks."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema(table)])


def create_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The seven crawl tables, empty."""
    return {name: empty(spark, name) for name in CRAWL_TABLES}


def seed_tables(spark: SparkSession, seeds: list[str] | None = None) -> dict[str, DataFrame]:
    """The crawl tables with both type dimensions and the start URLs in the frontier."""
    tables = create_tables(spark)
    tables["data_type"] = spark.createDataFrame([(c,) for c in C.DATA_TYPES], schema("data_type"))
    tables["page_type"] = spark.createDataFrame([(c,) for c in C.PAGE_TYPES], schema("page_type"))
    tables["page"] = spark.createDataFrame(
        [(i, None, "FRONTIER", url, None, None, None, None) for i, url in enumerate(C.SEED_URLS if seeds is None else seeds, 1)], schema("page"))
    return tables


@lru_cache(maxsize=1)
def mime_extensions() -> dict[str, str]:
    """First extension of each MIME type in the standard table, without entries of the machine."""
    table = mimetypes.MimeTypes()
    return {kind: extensions[0] for kind, extensions in table.types_map_inv[True].items()}
