"""Crawling a table of fetches from the start URLs until the frontier is empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.checkpoints import checkpointed
from crawlspark.operators import tables
from crawlspark.plans.wave import crawl_wave
from crawlspark.schemas import conform
from crawlspark.sources.inputs import fetches_of
from crawlspark.sources.store import CrawlStore


def fold(store: CrawlStore, fetches: DataFrame, wave: int | None = None, popped: DataFrame | None = None, batch: tuple[str, int] | None = None,
         now: int | None = None, **inputs) -> int:
    """Run one wave over ``fetches`` and commit it. Popped pages without a fetch stay in state CRAWLING.

    With ``now`` the wave's requests are scheduled from then on, after the clocks that earlier waves left in the store.

    A wave number, or a ``batch`` (stream, number), that the store has finished already is skipped.
    """
    if wave is not None and wave <= store.wave():
        return wave
    if batch is not None and store.has_batch(*batch):
        return store.wave()
    if now is not None:
        inputs |= {"now": now, "clocks": store.clocks()}
    delta = crawl_wave(store.state(), fetches, marks=store.marks(), **inputs)
    if popped is not None:
        missed = popped.join(fetches.select(F.col("requested_url").alias("url")), "url", "left_anti")
        missed = missed.join(delta["page"].select("id"), "id", "left_anti")
        kept = store.open_pages().join(missed.select("id"), "id", "left_semi").withColumn("page_type_code", F.lit("CRAWLING"))
        delta["page"] = delta["page"].unionByName(conform(kept, "page"))
    return store.commit(delta, wave, batch)


def discover(store: CrawlStore, fetches: DataFrame, per_wave: int | None = None, max_waves: int | None = None,
             now: int | None = None, until: int | None = None, **inputs) -> int:
    """Pop, look up the fetches, fold; until no page is in state FRONTIER. Returns the number of waves.

    With ``now`` (seconds) the crawl obeys its schedule: every wave's requests (pages, downloads, robots files, sitemaps)
    wait for their host's and address' clocks, the table ``schedule`` says when each starts, a wave begins when the last
    request of the one before has started, and none begins at ``until`` or later.

    Fetches laid out by :func:`crawlspark.sources.inputs.write_fetches` are read by folder, so a wave reads what it pops.
    Each wave starts from the committed files, so the plan does not grow. Its fetches are written out once, as a wave
    reads their text three times. Every page leaves the frontier once, so the loop ends on cyclic sites too.
    """
    waves = 0
    while (max_waves is None or waves < max_waves) and (now is None or until is None or now < until):
        popped = tables.pop_frontier(store.open_pages(), per_wave)
        if popped.isEmpty():
            break
        popped = checkpointed(popped)
        batch = checkpointed(fetches_of(fetches, popped))
        fold(store, batch, popped=popped, now=now, **inputs)
        waves += 1
        now = None if now is None else max(now, store.now() or now)
    return waves
