"""Crawl tables as Parquet files, versioned by wave.

Finished pages are only ever appended: a wave adds ``page_done/wave=k``, and lists in ``page_gone/wave=k`` the earlier
rows it replaces; inside a wave the rows of a type are a folder, so a reader of one type opens no other. Pages still to
visit carry no text and are rewritten as ``page_open/wave=k``. A wave counts once its marker in ``commits`` is written,
which is last; running it again replaces what an interrupted run left behind. A wave that folds a batch of a stream names
both in its marker, so a batch that comes again is known whatever wave it was. The marker also keeps the largest ids given
out, so the next wave numbers its rows without reading the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlspark.operators import tables
from crawlspark.schemas import schema, seed_tables

_APPENDED = ("data_type", "page_type", "site", "site_mode", "image", "page_data", "link")
_OPEN = ("FRONTIER", "CRAWLING")
_LOGGED = ("rejects", "schedule", "clock")
# Tables with ids, and the files that hold them.
_NUMBERED = {"page": ("page_open", "page_done"), "site": ("site",), "image": ("image",), "page_data": ("page_data",)}
_EXTRA = {"schedule": "id long, seq long, kind string, url string, domain string, ip string, arrival long, delay long, start long",
          "clock": "kind string, name string, free_at long",
          "page_gone": "id long, in_wave int", "rejects": "url string, reason string", "site_mode": "domain string, mode string",
          "commits": "committed boolean, stream string, batch long, " + ", ".join(f"max_{n} long" for n in _NUMBERED)}


class CrawlStore:
    """Reads and writes the crawl tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def reset(self, seeds: list[str] | None = None) -> "CrawlStore":
        """Start over: empty tables, the type dimensions, and the start URLs. Later waves are no longer read."""
        return self._begin(seed_tables(self.spark, seeds))

    def reset_from(self, urls: DataFrame) -> "CrawlStore":
        """Start over with a table of start URLs (column ``url``) instead of a list."""
        state = seed_tables(self.spark, [])
        state["page"] = tables.add_to_frontier(state["page"], urls.select("url"))
        return self._begin(state)

    def _begin(self, state: dict[str, DataFrame]) -> "CrawlStore":
        self._write(self._marked() + 1, state["page"], {n: state[n] for n in _APPENDED if n in state}, first=True)
        return self

    def _schema(self, name: str) -> T.StructType:
        if name in _EXTRA:
            return T.StructType.fromDDL(_EXTRA[name])
        return schema("page" if name.startswith("page_open") or name == "page_done" else name)

    def _raw(self, name: str) -> DataFrame:
        """All rows of a table with their wave."""
        return self.spark.read.schema(self._schema(name).add("wave", T.IntegerType())).option("basePath", f"{self.path}/{name}").parquet(
            f"{self.path}/{name}")

    def _exists(self) -> bool:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def _marked(self) -> int:
        if not self._exists():
            return -1
        return self._raw("commits").agg(F.max("wave").alias("w")).first().w

    def wave(self) -> int:
        """Last finished wave."""
        return self._marked()

    def _start(self) -> int:
        """Wave of the last reset."""
        return self._raw("commits").filter("committed = false").agg(F.max("wave").alias("w")).first().w

    def _current(self, name: str) -> DataFrame:
        return self._raw(name).filter(F.col("wave").between(self._start(), self._marked()))

    def table(self, name: str) -> DataFrame:
        if name == "page":
            return self.page()
        return self._current(name).drop("wave")

    def open_pages(self) -> DataFrame:
        return self._raw("page_open").filter(F.col("wave") == self._marked()).drop("wave")

    def done_pages(self, with_wave: bool = False) -> DataFrame:
        gone = self._current("page_gone").select("id", F.col("in_wave").alias("wave"))
        rows = self._current("page_done").join(gone, ["id", "wave"], "left_anti")
        return rows.select(*schema("page").names, *(["wave"] if with_wave else []))

    def page(self) -> DataFrame:
        return self.open_pages().unionByName(self.done_pages())

    def state(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in (*_APPENDED, "page")}

    def clocks(self) -> tuple[DataFrame, DataFrame]:
        """When each host (domain, free_at) and each address (ip, free_at) is free. A wave adds the clocks it has moved;
        clocks only go forward, so the latest time counts."""
        rows = self._current("clock")
        return tuple(rows.filter(F.col("kind") == kind).groupBy(F.col("name").alias(kind)).agg(F.max("free_at").alias("free_at")) for kind in ("domain", "ip"))

    def now(self) -> int | None:
        """When the last request of all scheduled waves starts; null without any."""
        return self._current("schedule").agg(F.max("start").alias("t")).first().t

    def marks(self) -> dict[str, int]:
        """The largest id given out in each numbered table, as the last marker says."""
        row = self._raw("commits").filter(F.col("wave") == self._marked()).first()
        return {n: row[f"max_{n}"] for n in _NUMBERED if row[f"max_{n}"] is not None}

    def _marks_after(self, wave: int, before: dict[str, int]) -> dict[str, int]:
        """Marks with the rows that a wave has just written; only its own files are read."""
        tops = [self._raw(file).filter(F.col("wave") == wave).agg(F.max("id").alias("top")).select(F.lit(n).alias("name"), "top")
                for n, files in _NUMBERED.items() for file in files]
        found: dict[str, int] = {n: 0 for n in _NUMBERED} | before
        for r in reduce(DataFrame.unionByName, tops).collect():
            found[r.name] = max(found[r.name], r.top or 0)
        return found

    def has_batch(self, stream: str, number: int) -> bool:
        """Whether a wave since the last reset has folded this batch."""
        return not self._current("commits").filter((F.col("stream") == stream) & (F.col("batch") == number)).isEmpty()

    def commit(self, delta: dict[str, DataFrame], wave: int | None = None, batch: tuple[str, int] | None = None) -> int:
        """Write the result of a wave. ``wave`` is given when a batch may come twice: a finished one is skipped.
        ``batch`` names the batch of a stream that the wave folds."""
        wave = self._marked() + 1 if wave is None else wave
        if wave > self._marked():
            self._write(wave, delta["page"], delta, batch=batch)
        return wave

    def _put(self, name: str, wave: int, rows: DataFrame, *by: str) -> None:
        rows.write.mode("overwrite").partitionBy(*by).parquet(f"{self.path}/{name}/wave={wave}")

    def _write(self, wave: int, page: DataFrame, rest: dict[str, DataFrame], first: bool = False, batch: tuple[str, int] | None = None) -> None:
        is_open = F.col("page_type_code").isin(*_OPEN)
        waiting = page.filter(is_open)
        gone = empty_gone = self.spark.createDataFrame([], self._schema("page_gone"))
        if not first:
            waiting = tables.remove_pages(self.open_pages(), page).unionByName(waiting)
            gone = self.done_pages(with_wave=True).select("id", F.col("wave").alias("in_wave")).join(
                page.select("id"), "id", "left_semi")
        self._put("page_gone", wave, gone if not first else empty_gone)
        self._put("page_done", wave, page.filter(~is_open), "page_type_code")
        self._put("page_open", wave, waiting)
        for name in _APPENDED:
            self._put(name, wave, rest[name] if name in rest else self.spark.createDataFrame([], self._schema(name)))
        for name in _LOGGED:
            rows = rest[name] if name in rest else self.spark.createDataFrame([], self._schema(name))
            self._put(name, wave, rows.select(self._schema(name).names))
        marks = self._marks_after(wave, {} if first else self.marks())
        row = (not first, *(batch or (None, None)), *(marks[n] for n in _NUMBERED))
        self._put("commits", wave, self.spark.createDataFrame([row], self._schema("commits")).coalesce(1))
