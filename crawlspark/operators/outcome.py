"""What a fetch turned into: redirect, document, failure, page."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.functions import urls as U
from crawlspark.schemas import mime_extensions


def data_type(content_type: Column) -> Column:
    """Type code of a Content-Type value: the part before ``;``, its standard extension, upper-cased; null if unknown."""
    table = F.create_map(*[F.lit(x) for x in chain(*mime_extensions().items())])
    kind = F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?s)^([^;]*)", 1))
    return U.extension_type(F.try_element_at(table, kind))


def error_class(error: Column) -> Column:
    """Text before the first `` at ``."""
    return F.split(error, " at ", 2)[0]


def is_quiet(error: Column) -> Column:
    return error_class(error).isin(C.QUIET_ERRORS)


def error_report(fetches: DataFrame) -> DataFrame:
    """Failed fetches per error class: error, quiet, n."""
    failed = fetches.filter(F.col("error").isNotNull())
    return failed.groupBy(error_class(F.col("error")).alias("error"), is_quiet(F.col("error")).alias("quiet")).agg(
        F.count(F.lit(1)).alias("n"))


def expand_urls(df: DataFrame, expansions: DataFrame | None, column: str, out: str) -> DataFrame:
    """Replace URLs that need it by what they expand to; those without an entry stay. One entry per short URL."""
    if expansions is None:
        return df.withColumn(out, F.col(column))
    table = expansions.select(F.col("short_url").alias("_short"), F.col("real_url").alias("_real"))
    need = U.needs_expansion(F.col(column))
    joined = df.join(table, need & (F.col(column) == F.col("_short")), "left")
    return joined.withColumn(out, F.coalesce(F.col("_real"), F.col(column))).drop("_short", "_real")


def is_download(has_text: Column, error: Column) -> Column:
    """Whether the browser gave no text and the URL was asked for once more, as a document."""
    return has_text.isNull() & (error.isNull() | (error_class(error) == C.DOWNLOAD_ERROR))


def with_outcome(fetches: DataFrame) -> DataFrame:
    """Classify fetches (with ``current_url``, the expanded request).

    Adds ``page_url`` (canonical final URL), ``document`` (type code of a download), ``is_redirect`` and ``outcome``:
    CRAWLING without an address or content, FAILED, BINARY, or HTML for pages whose hash is still to be looked up.
    A download's final URL is its request. The text itself is not needed where ``has_text`` (false: empty, null: no
    text) stands for ``html``.
    """
    has_text = F.col("has_text") if "has_text" in fetches.columns else F.col("html") != ""
    download = is_download(has_text, F.col("error"))
    fetches = fetches.withColumns({
        "_download": download,
        "document": F.when(download & (F.col("http_status") == 200), data_type(F.col("content_type"))),
        "page_url": F.when(download, F.col("current_url")).otherwise(F.col("final_url"))})
    fetches = U.canonicalize(fetches, "page_url")
    failed = ((F.col("error").isNotNull() & ~F.col("_download"))
              | (F.col("_download") & (F.col("document").isNull() | (F.col("document") == "HTML"))))
    outcome = (F.when(F.col("ip").isNull(), "CRAWLING").when(failed, "FAILED").when(F.col("_download"), "BINARY")
               .when(~F.coalesce(has_text, F.lit(False)), "CRAWLING").otherwise("HTML"))
    return fetches.withColumn("outcome", outcome).withColumn(
        "is_redirect", F.col("ip").isNotNull() & (F.col("outcome") != "FAILED")
        & (F.col("current_url") != F.col("page_url"))).drop("_download")
