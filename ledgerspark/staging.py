"""Intermediate tables in the folder that all executors share.

A staged table cuts the lineage: its rows survive the loss of an executor, and
values that depend on the physical layout (row positions) are fixed once.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Options of the Parquet writer: delta encodings for numbers and text, then zstd.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerspark-"))
    return spark.sparkContext.getCheckpointDir()


def staged_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/ledgerspark/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write df once as Parquet, with options of the writer, and read it back with its own schema."""
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def session_of_parts(spark: SparkSession) -> SparkSession:
    """A session with the settings of spark, in which a side of a join that is dealt by one of several keys stays as it lies.

    Spark's own default deals both sides anew by all keys. It is another session, as the setting is not one for all joins;
    a frame is planned in the session of the frame that it begins with.
    """
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if other.conf.isModifiable(name):
            other.conf.set(name, value)
    other.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return other


def stage_buckets(
    df: DataFrame, label: str, *keys: str, in_order: bool | Sequence[str] = False, reader: SparkSession | None = None
) -> DataFrame:
    """Stage df in buckets by keys, in order of them or of other columns if asked for: a join on them shuffles the other side only and reads df where it lies.

    A task writes a file for each bucket that it has rows of; df dealt by keys to bucket_count partitions has one each.

    The frame is of the session reader, or that of df. The catalog knows the files just long enough to hand out the frame; they stay, and the folder's owner removes them.
    """
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", staged_path(spark, label)).options(**COMPACT)
    buckets = writer.bucketBy(bucket_count(spark), *keys)
    order = keys if in_order is True else tuple(in_order or ())
    (buckets.sortBy(*order) if order else buckets).saveAsTable(name)
    staged = (reader or spark).table(name)
    spark.sql(f"DROP TABLE {name}")
    return staged
