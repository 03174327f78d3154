"""Exact, linearly interpolated quantiles of a decimal column per group."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

BANDS_PER_E = 64
_BAND_ZERO = 100_000


def _band(value: Column) -> Column:
    """Number of the 1.6 % wide band that holds the value, rising with the value.

    There are no more bands than the logarithm of a double allows, whatever
    the number of rows or of distinct values.
    """
    def steps(size: Column) -> Column:
        return F.floor(F.ln(size.cast("double")) * BANDS_PER_E) + _BAND_ZERO

    return F.when(value > 0, steps(value)).when(value < 0, -steps(-value)).otherwise(F.lit(0)).cast("bigint")


def grouped_quantiles(
    df: DataFrame, group: str, value: str, quantiles: dict[str, Decimal], scale: int | None = 4
) -> DataFrame:
    """One row per group with a decimal column per named quantile; without a scale, quantiles of doubles stay doubles.

    percentile() would hold every distinct value of a group in one buffer.
    Here values are counted per group and value, a first pass over band counts
    finds the bands that contain the wanted positions, and only the values of
    those bands are put in order.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("_group"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_band", _band(F.col("_value")))
    )
    by_band = counts.groupBy("_group", "_band").agg(F.sum("_rows").alias("_band_rows"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    placed = by_band.select(
        "_group",
        "_band",
        "_band_rows",
        F.coalesce(F.sum("_band_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_band_rows").over(whole).alias("_total"),
    )

    def position(quantile: Decimal) -> Column:
        return F.lit(quantile) * (F.col("_total") - 1)

    def holds(start: Column, rows: Column, rank: Column) -> Column:
        return (start <= rank) & (rank < start + rows)

    wanted = [
        side(position(q)).cast("bigint") for q in quantiles.values() for side in (F.floor, F.ceil)
    ]
    hit = F.lit(False)
    for rank in wanted:
        hit = hit | holds(F.col("_start"), F.col("_band_rows"), rank)
    bands = placed.where(hit).select(
        F.col("_group").alias("_b_group"), F.col("_band").alias("_b_band"), "_start", "_total"
    )

    in_band = (
        Window.partitionBy("_group", "_band").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = counts.join(
        bands,
        F.col("_group").eqNullSafe(F.col("_b_group")) & (F.col("_band") == F.col("_b_band")),
    ).withColumn("_first", F.col("_start") + F.coalesce(F.sum("_rows").over(in_band), F.lit(0)))

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(F.col("_first"), F.col("_rows"), rank), F.col("_value")))

    ends = []
    for name, q in quantiles.items():
        where = position(q)
        ends += [
            at(F.floor(where).cast("bigint")).alias(f"_{name}_lo"),
            at(F.ceil(where).cast("bigint")).alias(f"_{name}_hi"),
            F.max(where - F.floor(where)).cast("decimal(5,4)").alias(f"_{name}_part"),
        ]
    result = ranked.groupBy("_group").agg(*ends)

    def between(name: str) -> Column:
        low, part = F.col(f"_{name}_lo"), F.col(f"_{name}_part")
        found = low + (F.col(f"_{name}_hi") - low) * part
        return found if scale is None else found.cast(f"decimal(18,{scale})")

    return result.select(
        F.col("_group").alias(group),
        *[between(n).alias(n) for n in quantiles],
    )
