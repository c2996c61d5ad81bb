"""Polite fetch schedule: when each request may start, and when each host is free again.

A request starts at ``max(arrival, time its clock is free)`` and keeps the clock for its delay. Along one clock that is
a prefix computation: with ``S`` the delays before a request, ``start = S + max over requests so far of (arrival - S)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark import constants as C
from crawlspark.checkpoints import checkpointed
from crawlspark.operators import skew

# Above this many requests on one clock its line is cut into chunks that are scanned in parallel.
MAX_CLOCK_ROWS = 1_000_000


def required_delay(delay: Column) -> Column:
    return F.coalesce(delay, F.lit(C.DEFAULT_DELAY_SECONDS))


def clock_key(ip: Column, domain: Column) -> Column:
    """One clock per address; hosts without one use their name."""
    return F.coalesce(ip, domain)


def wait_times(requests: DataFrame, domain_free: DataFrame, ip_free: DataFrame) -> DataFrame:
    """Add ``wait``: how long domain and address stay blocked after ``now``, at least 0.

    ``domain_free`` has domain, free_at; ``ip_free`` ip, free_at. Both keys are skewed.
    """
    for key, free, name in (("domain", domain_free, "_d"), ("ip", ip_free, "_i")):
        requests = skew.lookup(requests, free.select(key, F.col("free_at").alias(name)), key)
    return (requests.withColumn("wait", F.greatest(F.coalesce(F.col("_d") - F.col("now"), F.lit(0)),
                                           F.coalesce(F.col("_i") - F.col("now"), F.lit(0)), F.lit(0)))
            .drop("_d", "_i"))


def schedule(requests: DataFrame, available: DataFrame | None = None, key: str = "host",
             max_clock_rows: int | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Add ``start`` to each request (id, key, arrival, delay), in the order of arrival and id per clock.

    ``available`` (key, free_at) is the state before the batch. If no clock has more than ``max_clock_rows`` requests
    each is one window; otherwise all are cut into chunks of about ``chunk_rows`` by :func:`_chunked`.
    """
    limit = MAX_CLOCK_ROWS if max_clock_rows is None else max_clock_rows
    counts = skew.key_counts(requests.select(key), key)
    long_lines = (counts.agg(F.max("n").alias("n")).first().n or 0) > limit
    if available is not None:
        floor = available.select(key, F.col("free_at").alias("_free"))
        requests = skew.lookup(requests, floor, key).withColumn(
            "_from", F.greatest(F.col("arrival"), F.coalesce(F.col("_free"), F.col("arrival")))).drop("_free")
    else:
        requests = requests.withColumn("_from", F.col("arrival"))
    if long_lines:
        return _chunked(requests, key, chunk_rows or MAX_CLOCK_ROWS)
    line = Window.partitionBy(key).orderBy("arrival", "id")
    return _scan(requests, line).withColumn("start", F.col("_sum") + F.col("_peak")).drop("_from", "_sum", "_peak")


def _scan(requests: DataFrame, line) -> DataFrame:
    """Delays before each row, and the largest slack so far."""
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    requests = requests.withColumn("_sum", F.coalesce(F.sum("delay").over(before), F.lit(0)))
    return requests.withColumn("_peak", F.max(F.col("_from") - F.col("_sum")).over(so_far))


def _chunked(requests: DataFrame, key: str, chunk_rows: int) -> DataFrame:
    """The same scan with long clocks cut at range partition borders.

    Rows are range-partitioned by (clock, arrival, id) and written once, so that a partition number names the same rows
    on every read. Each chunk is scanned alone; chunk totals (one row per clock and partition) are scanned in turn and
    give each chunk what lies before it.
    """
    order = [F.col(key), F.col("arrival"), F.col("id")]
    parts = max(requests.sparkSession.sparkContext.defaultParallelism, -(-requests.count() // chunk_rows))
    ranged = checkpointed(requests.repartitionByRange(parts, *order).withColumn("_chunk", F.spark_partition_id()))
    inside = _scan(ranged, Window.partitionBy(key, "_chunk").orderBy("arrival", "id"))
    totals = inside.groupBy(key, "_chunk").agg(F.sum("delay").alias("_len"), F.max("_peak").alias("_top"))
    chunks = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_ahead", F.coalesce(F.sum("_len").over(chunks), F.lit(0)))
    totals = totals.withColumn("_above", F.max(F.col("_top") - F.col("_ahead")).over(chunks))
    joined = inside.join(totals.select(key, "_chunk", "_ahead", "_above"), [key, "_chunk"])
    peak = F.greatest(F.col("_peak") - F.col("_ahead"), F.coalesce(F.col("_above"), F.col("_peak") - F.col("_ahead")))
    return joined.withColumn("start", F.col("_ahead") + F.col("_sum") + peak).drop(
        "_from", "_sum", "_peak", "_chunk", "_ahead", "_above")


def next_available(scheduled: DataFrame, key: str = "host", before: DataFrame | None = None) -> DataFrame:
    """When each clock is free after the batch: key, free_at. Clocks of ``before`` without a request keep their time."""
    ends = scheduled.select(key, (F.col("start") + F.col("delay")).alias("free_at"))
    if before is not None:
        ends = ends.unionByName(before.select(key, "free_at"))
    return ends.groupBy(key).agg(F.max("free_at").alias("free_at"))
