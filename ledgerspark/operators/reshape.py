"""Wide one-row aggregates turned into report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def metric_rows(df: DataFrame, metrics: dict[str, Column], name: str, value: str) -> DataFrame:
    """Compute all metrics in one pass and return one (name, value) row each."""
    wide = df.agg(*[metric.alias(f"m{i}") for i, metric in enumerate(metrics.values())])
    rows = F.array(
        *[
            F.struct(F.lit(label).alias(name), F.col(f"m{i}").alias(value))
            for i, label in enumerate(metrics)
        ]
    )
    return wide.select(F.inline(rows))


def column_values(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One (column name, text value) row per row and column."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(c).cast("string").alias(value)) for c in columns]
    )
    return df.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    return metric_rows(
        df, {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "column_name", "null_rows"
    )
