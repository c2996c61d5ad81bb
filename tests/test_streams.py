import datetime
import random
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from crawlspark import schemas
from crawlspark.operators import politeness
from crawlspark.plans.discovery import fold
from crawlspark.sources.inputs import read_input, stream_input
from crawlspark.sources.store import CrawlStore
from crawlspark.streaming import jobs

A = "https://a.gov.si"
T0 = datetime.datetime(2024, 1, 1)


def fetch(seq, path, html):
    return (seq, A + path, A + path, 200, "text/html", html, None, "1", T0 + datetime.timedelta(seconds=seq))


def put(spark, folder, rows):
    spark.createDataFrame(rows, schemas.schema("fetches")).coalesce(1).write.mode("append").parquet(folder)


def folder():
    return tempfile.mkdtemp(prefix="run-")


def run_dedupe(stream, out):
    (stream.select("seq", "html").writeStream.format("parquet").option("checkpointLocation", out + "/c").trigger(availableNow=True)
     .start(out + "/o").awaitTermination())


def test_dedupe_stream_keeps_one_row_per_text(spark):
    rnd = random.Random(2)
    source, out = folder(), folder()
    texts = ["hot" if i % 3 == 0 else f"t{rnd.randint(0, 40)}" for i in range(300)]
    for part in range(3):
        put(spark, source, [fetch(i, f"/{i}/", texts[i]) for i in range(part * 100, part * 100 + 100)])
    run_dedupe(jobs.dedupe_stream(stream_input(spark, source, max_files=1)), out)
    got = spark.read.schema("seq long, html string").parquet(out + "/o").collect()
    assert sorted(r.html for r in got) == sorted(set(texts))
    # A later run of the same query remembers what it has seen.
    put(spark, source, [fetch(900, "/900/", "hot"), fetch(901, "/901/", "fresh")])
    run_dedupe(jobs.dedupe_stream(stream_input(spark, source, max_files=1)), out)
    assert sorted(r.html for r in spark.read.schema("seq long, html string").parquet(out + "/o").collect()) == sorted({*texts, "fresh"})


def test_bounded_dedupe_stream(spark):
    source, out = folder(), folder()
    put(spark, source, [fetch(i, f"/{i}/", f"t{i % 5}") for i in range(50)])
    run_dedupe(jobs.dedupe_stream(stream_input(spark, source), within="1 hour"), out)
    assert spark.read.schema("seq long, html string").parquet(out + "/o").count() == 5


def test_crawl_stream(spark):
    source, checkpoint = folder(), folder()
    store = CrawlStore(spark, folder()).reset([A + "/"])
    put(spark, source, [fetch(1, "/", '<a href="/x"></a><a href="/y"></a>')])
    jobs.crawl_stream(stream_input(spark, source, max_files=1), store, checkpoint).awaitTermination()
    put(spark, source, [fetch(2, "/x/", "<p>x"), fetch(3, "/y/", "<p>x")])
    jobs.crawl_stream(stream_input(spark, source, max_files=1), store, checkpoint).awaitTermination()
    assert store.wave() == 2
    assert sorted((r.url, r.page_type_code) for r in store.page().collect()) == [(A + "/", "HTML"), (A + "/x/", "HTML"), (A + "/y/", "DUPLICATE")]
    assert read_input(spark, source).count() == 3


def test_crawl_stream_folds_a_batch_once(spark):
    """The driver dies after the wave's marker and before the stream's own commit: the batch comes again."""
    source, checkpoint, path = folder(), folder(), folder()
    store = CrawlStore(spark, path).reset([A + "/"])
    put(spark, source, [fetch(1, "/", '<a href="/x"></a><img src="/i.png"><a href="/d.pdf"></a>')])
    jobs.crawl_stream(stream_input(spark, source, max_files=1), store, checkpoint).awaitTermination()
    commits = [p for p in Path(checkpoint, "commits").iterdir() if p.name.lstrip(".").split(".")[0] == "0"]
    for file in commits:
        file.unlink()
    again = CrawlStore(spark, path)
    jobs.crawl_stream(stream_input(spark, source, max_files=1), again, checkpoint).awaitTermination()
    assert again.wave() == 1 and again.table("image").count() == 1 and again.table("page_data").count() == 1
    put(spark, source, [fetch(2, "/x/", "<p>x")])
    jobs.crawl_stream(stream_input(spark, source, max_files=1), again, checkpoint).awaitTermination()
    assert again.wave() == 2


def test_schedule_stream_equals_the_batch(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.randint(1, 3), i, rnd.randint(1, 9)) for i in range(200)]
    source, out = folder(), folder()
    for part in range(4):
        spark.createDataFrame(rows[part * 50:part * 50 + 50], "id long, host long, arrival long, delay long").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long, host long, arrival long, delay long").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.schedule_stream(stream, out, out + "/c", max_clock_rows=30).awaitTermination()
    got = {r.id: r.start for r in spark.read.parquet(out + "/schedule").collect()}
    want = politeness.schedule(spark.createDataFrame(rows, "id long, host long, arrival long, delay long"))
    assert got == {r.id: r.start for r in want.collect()}
    clocks = spark.read.parquet(out + "/clocks").filter(F.col("batch") == 3).select("host", "free_at")
    assert {r.host: r.free_at for r in clocks.collect()} == {r.host: r.free_at for r in politeness.next_available(want).collect()}


def test_batches_come_again_after_a_reset(spark):
    source, path = folder(), folder()
    put(spark, source, [fetch(1, "/", '<a href="/x"></a>')])
    store = CrawlStore(spark, path).reset([A + "/"])
    batch = read_input(spark, source)
    assert fold(store, batch, batch=("c", 0)) == 1 and fold(store, batch, batch=("c", 0)) == 1
    store.reset([A + "/"])
    assert not store.has_batch("c", 0)
    assert fold(store, batch, batch=("c", 0)) == 3
    assert sorted((r.url, r.page_type_code) for r in store.page().collect()) == [(A + "/", "HTML"), (A + "/x/", "FRONTIER")]
