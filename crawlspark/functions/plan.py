"""Plan shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame) -> DataFrame:
    """Keep costly columns from being copied into the filters that follow.

    Catalyst moves a filter below the projection that computes its columns by copying their expressions. It does not
    move one below a generator, so the row passes through a one-element ``inline``. Narrow, and inside codegen.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
