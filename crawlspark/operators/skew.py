"""Joins of rows with a skewed key to a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; folds before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def lookup(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key) where a few keys may hold most of ``left``.

    A plain equi-join on purpose: adaptive execution cuts an oversized shuffle partition by the map tasks that wrote it,
    so one key, or any number of them, is read by several tasks, each with its copy of the few ``right`` rows. That
    needs no counting pass, no list of heavy keys and no second column that tells their rows apart.
    """
    return left.join(right, key, how)
