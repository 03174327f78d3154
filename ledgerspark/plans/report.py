"""Run report rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerspark.plans.quality import dataset_summary


def row_count(df: DataFrame, dataset: str, metric: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(dataset).alias("dataset"), F.lit(metric).alias("metric"), F.col("value").cast("string").alias("value")
    )


def run_report(
    raw: Mapping[str, DataFrame],
    clean: Mapping[str, DataFrame],
    checks: DataFrame,
    files: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw and clean row counts, check totals and written files as (dataset, metric, value)."""
    parts = [row_count(df, name, "raw_rows") for name, df in raw.items()]
    parts += [row_count(df, name, "clean_rows") for name, df in clean.items()]
    # both totals in one row each, so that the checks are in the plan once
    totals = [
        F.struct(F.lit(metric).alias("metric"), F.col(metric).cast("string").alias("value"))
        for metric in ("checks_passed", "checks_failed")
    ]
    parts.append(dataset_summary(checks).select("dataset", F.inline(F.array(*totals))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    if files:
        written = result.sparkSession.createDataFrame(
            [(name, "file", path) for name, path in files.items()], "dataset string, metric string, value string"
        )
        result = result.unionByName(written)
    return result
