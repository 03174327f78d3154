"""File writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def write_csv(df: DataFrame, path: str) -> int:
    """Write a CSV with header; blanks at the ends of a text are kept."""
    counted, rows = _counted(df)
    writer = counted.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return rows.get["rows"]


#: JSON text of a gzip file is read by one task, so files are bounded.
JSON_FILE_ROWS = 500_000


def write_jsonl(df: DataFrame, path: str) -> int:
    """Write JSON lines in gzip files of at most JSON_FILE_ROWS rows, which the reader opens as it does plain ones."""
    counted, rows = _counted(df)
    writer = counted.write.mode("overwrite").option("compression", "gzip")
    writer.option("maxRecordsPerFile", JSON_FILE_ROWS).json(path)
    return rows.get["rows"]


def write_parquet(
    df: DataFrame, name: str, folder: str, partition_by: str | None = None, small: bool = False
) -> int:
    """Write a table and return its row count, observed during the write.

    Rows of one partition value are brought together by a rebalance, which
    splits a value that holds many rows over several files and tasks. small
    is for tables of bounded size that should be a single file.
    """
    laid_out = df
    if small:
        laid_out = df.coalesce(1)
    elif partition_by:
        laid_out = df.hint("rebalance", partition_by)
    counted, rows = _counted(laid_out)
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{folder.rstrip('/')}/{name}")
    return rows.get["rows"]
