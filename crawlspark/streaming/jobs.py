"""Streams: exact dedupe, the continuous crawl, and the politeness clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlspark.operators import html, politeness
from crawlspark.plans.discovery import fold
from crawlspark.sources.store import CrawlStore

SALTS = 16


def dedupe_stream(stream: DataFrame, column: str = "html", within: str | None = None, time: str = "accessed_time") -> DataFrame:
    """First row per content hash, in the order of arrival.

    State holds hashes only. A text that many rows share is first thinned out per salt, so its rows spread over tasks
    and at most one per salt meets the others. ``within`` bounds the state: copies are dropped while the watermark of
    that length on ``time`` still keeps their hash.
    """
    rows = stream.withColumn("html_hash", html.content_hash(F.col(column)))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in stream.columns if c != column]), F.lit(SALTS)))
    if within is None:
        return rows.dropDuplicates(["html_hash", "_salt"]).dropDuplicates(["html_hash"]).drop("_salt")
    rows = rows.withWatermark(time, within)
    return (rows.dropDuplicatesWithinWatermark(["html_hash", "_salt"]).dropDuplicatesWithinWatermark(["html_hash"])
            .drop("_salt"))


def _start(stream: DataFrame, work, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def crawl_stream(stream: DataFrame, store: CrawlStore, checkpoint: str, **inputs) -> StreamingQuery:
    """Fold a stream of fetches into the store, one wave per micro-batch.

    The wave's marker names the checkpoint and the batch. It is written last, so a batch that comes again, whether the
    driver was lost before the marker or between the marker and the stream's own commit, is folded exactly once.
    """
    def work(batch: DataFrame, number: int) -> None:
        fold(store, batch, batch=(checkpoint, number), **inputs)

    return _start(stream, work, checkpoint)


def schedule_stream(stream: DataFrame, path: str, checkpoint: str, key: str = "host",
                    max_clock_rows: int | None = None) -> StreamingQuery:
    """Schedule a stream of requests (id, key, arrival, delay), batch after batch.

    Writes ``path/schedule/batch=k`` and the clocks after it as ``path/clocks/batch=k``; a repeated batch overwrites
    its own folders. Within a batch clocks are scanned as in :func:`politeness.schedule`, so one busy host is cut into
    chunks and does not hold up a task.
    """
    spark = stream.sparkSession
    kind = T.StructType([f for f in stream.schema.fields if f.name == key]).add("free_at", T.LongType())

    def work(batch: DataFrame, number: int) -> None:
        before = spark.read.schema(kind).parquet(f"{path}/clocks/batch={number - 1}") if number else spark.createDataFrame([], kind)
        done = politeness.schedule(batch, before, key, max_clock_rows)
        done.write.mode("overwrite").parquet(f"{path}/schedule/batch={number}")
        written = spark.read.schema(done.schema).parquet(f"{path}/schedule/batch={number}")
        politeness.next_available(written, key, before).write.mode("overwrite").parquet(f"{path}/clocks/batch={number}")

    return _start(stream, work, checkpoint)
