"""Join helpers: fan-out guards and left joins that tolerate missing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

NULL_KEY_SPREAD = 4096


def key_profile(df: DataFrame, key: str, dataset: str) -> DataFrame:
    """One row: non-null key rows, distinct keys, keys that repeat."""
    copies = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("key_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_copies") > 1).alias("repeated_keys"),
    ).select(F.lit(dataset).alias("dataset"), F.lit(key).alias("key"), "key_rows", "distinct_keys", "repeated_keys")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def one_row_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The lookup side of a join; reading a repeated key fails the job.

    The check is part of the join's plan, so the lookup table is read once.
    It sits on the key, which makes the join shuffle its side anew: both
    inputs are then plain shuffles, the shape that adaptive execution splits
    when one key holds a large part of the facts. Null keys cannot match and
    are left out.
    """
    grouped = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_copies"), *[F.any_value(c).alias(c) for c in columns])
    )
    fails = F.raise_error(F.concat(F.lit(f"duplicate {key}, the join would fan out: "), F.col(key)))
    return grouped.select(
        F.when(F.col("_copies") == 1, F.col(key)).otherwise(fails).alias(key), *columns
    )


def left_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    spread_by: str,
    also: Column | None = None,
) -> DataFrame:
    """Left join on fact_key = lookup_key that does not pile up null keys.

    Rows without a key match nothing, yet a plain shuffle join sends all of
    them to one partition. Here their join key is a text spread over spread_by
    instead. The condition that the real key is there keeps such a text from
    matching, so the result is that of the plain join. Both are expressions of
    the condition: no column is added to the rows that are shuffled.
    """
    spread = F.coalesce(
        F.col(fact_key),
        F.concat(F.lit("no key "), F.pmod(F.xxhash64(spread_by), F.lit(NULL_KEY_SPREAD)).cast("string")),
    )
    right = lookup.withColumnRenamed(lookup_key, "_lookup_key")
    matches = (spread == F.col("_lookup_key")) & F.col(fact_key).isNotNull()
    if also is not None:
        matches = matches & also
    return facts.join(right, matches, "left").drop("_lookup_key")
