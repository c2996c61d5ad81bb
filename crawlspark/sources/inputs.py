"""Readers of the input tables, with their schemas given instead of inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.schemas import conform, schema

PART, MOST_DIGITS = "url_part", 4


def read_input(spark: SparkSession, path: str, table: str = "fetches") -> DataFrame:
    """Parquet scan of an input table."""
    return spark.read.schema(schema(table)).parquet(path)


def stream_input(spark: SparkSession, path: str, table: str = "fetches", files: str | None = None,
                 max_files: int | None = None) -> DataFrame:
    """Parquet file stream of an input table. ``path`` is a folder; ``files`` a name pattern inside it."""
    reader = spark.readStream.schema(schema(table))
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _part(url: Column, digits: int) -> Column:
    return F.substring(F.md5(url), 1, digits)


def write_fetches(fetches: DataFrame, path: str, digits: int = 3) -> None:
    """Lay fetches out for discovery: ``16 ** digits`` folders by a hash of the requested URL, sorted by it inside.

    The ranges that tasks write follow the sizes, so a large folder is written by several tasks.
    """
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must be 1 to {MOST_DIGITS}")
    rows = conform(fetches, "fetches").withColumn(PART, _part(F.col("requested_url"), digits))
    ranges = rows.repartitionByRange(PART, "requested_url", "seq").sortWithinPartitions(PART, "requested_url")
    ranges.write.partitionBy(PART).parquet(path)


def read_fetches(spark: SparkSession, path: str) -> DataFrame:
    """Fetches that :func:`write_fetches` has laid out; the column ``url_part`` names the folder."""
    return spark.read.schema(schema("fetches").add(PART, "string")).parquet(path)


def fetches_of(fetches: DataFrame, urls: DataFrame) -> DataFrame:
    """The fetches of some URLs (column ``url``). Of fetches that are laid out only the folders of these URLs are read.

    The names of the folders come to the driver, which are at most 70,000 however many URLs there are.
    """
    columns = [c for c in fetches.columns if c != PART]
    if PART in fetches.columns:
        names = F.array(*[_part(F.col("url"), k) for k in range(1, MOST_DIGITS + 1)])
        wanted = [r[PART] for r in urls.select(F.explode(names).alias(PART)).distinct().collect()]
        fetches = fetches.filter(F.col(PART).isin(wanted)) if wanted else fetches.filter(F.lit(False))
    asked = urls.select(F.col("url").alias("requested_url")).distinct()
    return fetches.join(asked, "requested_url", "left_semi").select(columns)
