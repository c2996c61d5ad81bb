"""Dense surrogate ids without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlspark.checkpoints import checkpointed


def with_rank(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """Position of each row, from 1, in the order of ``order`` (which must be unique).

    Rows are range-partitioned and sorted, and written once so that partition numbers cannot change on a retry. Only
    one count per partition goes through a small window.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    placed = checkpointed(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    # One row per partition, so the ordered window over them has a fixed small bound.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    position = F.col("_row").bitwiseAND((1 << 33) - 1)
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_before") + position + 1).drop("_part", "_row", "_before"))


def max_id(table: DataFrame, column: str = "id") -> int:
    """Largest id in use; one number, from Parquet statistics or a map-side maximum."""
    return table.agg(F.coalesce(F.max(column), F.lit(0)).alias("m")).first().m


def assign_ids(new: DataFrame, existing_max: int | Column, order: list[str], column: str = "id") -> DataFrame:
    """Give ``new`` rows the ids after ``existing_max``, in the order of ``order``."""
    base = F.lit(existing_max) if isinstance(existing_max, int) else existing_max
    return with_rank(new, order, "_rank").withColumn(column, (base + F.col("_rank")).cast("long")).drop("_rank")
