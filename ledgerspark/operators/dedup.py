"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    The rank-1 filter is planned as a group limit before and after the shuffle,
    so every map task ships one row per key at most, however often it repeats.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", position).where(F.col("_n") == 1).drop("_n")
