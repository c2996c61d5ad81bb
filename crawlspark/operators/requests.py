"""The requests that a crawl wave makes, in order, each with the delay its host asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.functions import urls as U
from crawlspark.operators import ids, skew

KINDS = ("robots", "sitemap", "page", "download")


def wave_requests(batch: DataFrame, firsts: DataFrame, policies: DataFrame | None, opened: DataFrame | None, now: int | float = 0) -> DataFrame:
    """id, seq, kind, url, domain, ip, arrival, delay: everything a wave asks its hosts for.

    ``batch`` (seq, domain, ip, current_url, retried) holds the fetches; those without an address ask nobody. The first
    fetch of a new site (``firsts``: domain, host, seq, current_url) reads its robots file, always at the default delay,
    if ``policies`` (domain, policy) says that such files are read, and then the sitemaps in ``opened`` (domain: the host,
    url, level), level by level. Then comes the page, and where the browser refused it as a document (``retried``) the
    download. Ids follow the fetches' ``seq`` and these steps; all arrive at ``now``.
    """
    visits = batch.filter(F.col("ip").isNotNull())
    if policies is None:
        visits = visits.withColumn("delay", F.lit(C.DEFAULT_DELAY_SECONDS))
    else:
        delays = policies.select("domain", F.col("policy.delay").alias("_delay"))
        visits = skew.lookup(visits, delays, "domain").withColumn("delay", F.coalesce("_delay", F.lit(C.DEFAULT_DELAY_SECONDS)))
    visits = visits.select("seq", "domain", "ip", "current_url", "retried", F.col("delay").cast("long").alias("delay"))

    def step(rows: DataFrame, kind: str, url, level=F.lit(0)) -> DataFrame:
        return rows.select("seq", F.lit(KINDS.index(kind)).alias("_step"), level.cast("int").alias("_level"), F.lit(kind).alias("kind"), url.alias("url"), "domain", "ip", "delay")

    rows = step(visits, "page", F.col("current_url")).unionByName(step(visits.filter("retried"), "download", F.col("current_url")))
    first = visits.join(firsts.select("seq", "host"), "seq")
    if policies is not None:
        rows = rows.unionByName(step(first.withColumn("delay", F.lit(C.DEFAULT_DELAY_SECONDS).cast("long")), "robots", U.robots_url(F.col("current_url"))))
    if opened is not None:
        maps = skew.lookup(opened.select(F.col("domain").alias("host"), "url", "level"), first.drop("current_url"), "host", how="inner")
        rows = rows.unionByName(step(maps, "sitemap", F.col("url"), F.col("level")))
    numbered = ids.with_rank(rows, ["seq", "_step", "_level", "url"], "id")
    return numbered.withColumn("arrival", F.lit(now)).select("id", "seq", "kind", "url", "domain", "ip", "arrival", "delay")
