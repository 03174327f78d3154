"""File readers with explicit schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspark import schemas
from ledgerspark.functions.text import null_if_missing_token


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with header; texts that mean "no value" become null."""
    df = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    texts = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[null_if_missing_token(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.PROJECTS)


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.EMPLOYEES)


def read_salary_history(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.SALARY_HISTORY)


def read_transactions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A JSON array, or one JSON object per line with lines=True.

    An array is one task per file; lines split, so large feeds should use them.
    """
    return spark.read.schema(schemas.TRANSACTIONS).option("multiLine", not lines).json(path)


def parse_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def read_events(spark: SparkSession, folder: str, pattern: str = "events_*.jsonl") -> DataFrame:
    """All matching JSON-lines files; a time that does not parse becomes null."""
    path = f"{folder.rstrip('/')}/{pattern}"
    try:
        events = spark.read.schema(schemas.EVENTS).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no files match {path}") from error
        raise
    return parse_event_time(events)


def read_event_stream(
    spark: SparkSession, source: str = "text", **options: str
) -> DataFrame:
    """Raw event messages as one string column, from files or from Kafka.

    For Kafka pass kafka.bootstrap.servers and subscribe; reading starts at the
    earliest offset unless told otherwise.
    """
    if source == "kafka":
        options = {"startingOffsets": "earliest"} | options
    raw = spark.readStream.format(source).options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"))
