"""What several operators use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from crawlspark.checkpoints import scratch_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Writers of Parquet look at the size of a row group first after 100 rows; here after each row.
SMALL_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def staged(df: DataFrame, name: str = "stage", clean: bool = False, large: bool = False) -> DataFrame:
    """Write ``df`` below the shared folder and go on from the written rows: lineage is cut, a lost executor costs nothing.

    With ``clean`` the shuffle files of the write go as soon as it ends, and not when the driver next collects its
    garbage: the written rows don't need them, so they don't stand on disk beside the next shuffle.

    ``large`` is for rows of megabytes: a row group ends with the row that takes it beyond a few MB. A reader decodes up to
    4,096 rows of a row group at once, so with the groups that Spark writes else it would hold all rows of a file.
    """
    folder, conf = scratch_folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(DROP_SHUFFLES)
    conf.set(DROP_SHUFFLES, "true" if clean else before)
    try:
        df.write.options(compression="zstd", **(SMALL_GROUPS if large else {})).parquet(folder)
    finally:
        conf.set(DROP_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.staged_in = folder
    return out


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run in here send rows to Python in batches of 8 MB, or one row, instead of 64 MB.

    A batch is copied as it grows and stands in both processes, beside the heap, once for each task.
    """
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, "8m")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def released(result: DataFrame, *before: DataFrame) -> DataFrame:
    """``result``, a staged frame, after the folders of the staged frames that it was made from are deleted.

    A written table needs nothing that stood before it, so a lost executor costs no more than with the folders kept.
    """
    for df in before:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_in)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    return result


def tasks(df: DataFrame) -> int:
    """Shuffle partitions of the session, for repartitions by key."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, after ``names``."""
    out: list[str] = []
    for name in names:
        while name.lower() in {c.lower() for c in [*df.columns, *out]}:
            name += "_"
        out.append(name)
    return out
