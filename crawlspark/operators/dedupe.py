"""Exact duplicates by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.checkpoints import checkpointed
from crawlspark.operators import skew


def hashed(rows: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """carry columns and html_hash, written once: what follows reads hashes several times, but the texts no more."""
    return checkpointed(rows.select(*carry, F.sha2(F.col(text), 256).alias("html_hash")))


def originals(rows: DataFrame, order: str = "seq", payload: list[str] | None = None) -> DataFrame:
    """First row per hash and the number of copies: html_hash, n, first (order and payload columns).

    A minimum and a count, both folded before the shuffle: a hash that a third of all pages share costs one row per
    task. A ranking window would put all of them into one task.
    """
    return rows.groupBy("html_hash").agg(F.min(F.struct(order, *(payload or []))).alias("first"),
                                         F.count(F.lit(1)).alias("n"))


def mark_duplicates(rows: DataFrame, known: DataFrame | None = None, key: str = "id", order: str = "seq",
                    site: str = "site_id") -> DataFrame:
    """Add original_id and original_site_id to each row that is a copy, null for originals.

    ``rows`` has key, order, site and html_hash. ``known`` holds earlier pages (key, site_id, html_content_hash), which
    come before any row of the batch. A page is never a copy of itself. Rows without a hash pass through.
    """
    first = originals(rows.filter(F.col("html_hash").isNotNull()), order, [key, site])
    first = first.select("html_hash", "n", F.col(f"first.{key}").alias("_id"), F.col(f"first.{site}").alias("_site"))
    if known is not None:
        earlier = known.filter(F.col("html_content_hash").isNotNull()).select(
            F.col("html_content_hash").alias("html_hash"), F.col(key).alias("_kid"), F.col("site_id").alias("_ksite"))
        first = first.join(earlier, "html_hash", "left").select(
            "html_hash", "n", F.coalesce("_kid", "_id").alias("_id"),
            F.when(F.col("_kid").isNotNull(), F.col("_ksite")).otherwise(F.col("_site")).alias("_site"))
    found = skew.lookup(rows, first.drop("n"), "html_hash")
    copy = F.col("_id") != F.col(key)
    return (found.withColumns({"original_id": F.when(copy, F.col("_id")), "original_site_id": F.when(copy, F.col("_site"))})
            .drop("_id", "_site"))


def duplicate_rows(marked: DataFrame, key: str = "id") -> DataFrame:
    """Page rows of the copies: the original's site, no html, no hash."""
    return marked.filter(F.col("original_id").isNotNull()).select(
        F.col(key).alias("id"), F.col("original_site_id").alias("site_id"), F.lit("DUPLICATE").alias("page_type_code"),
        F.lit(None).cast("string").alias("html_content"), F.lit(None).cast("string").alias("html_content_hash"))


def duplicate_edges(marked: DataFrame, key: str = "id") -> DataFrame:
    return marked.filter(F.col("original_id").isNotNull()).select(
        F.col(key).alias("from_page"), F.col("original_id").alias("to_page"))
