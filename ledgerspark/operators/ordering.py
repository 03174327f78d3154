"""Positions in a sort order that no single task has to hold.

An unpartitioned window moves every row into one task, and a window over a hot
key moves that key's rows into one task. Here the rows are range-partitioned on
the full order, numbered inside their partition and staged once; what is left
to add is one offset per partition, a table with as many rows as there are
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerspark.staging import COMPACT, stage_table

_BEFORE = (Window.unboundedPreceding, -1)


def _range_parts(df: DataFrame, order: Sequence[str], label: str, keep: Sequence[str] | None = None) -> DataFrame:
    """df, or its columns in keep, plus _part (range partition) and _pos (row position inside it), staged."""
    keep = df.columns if keep is None else keep
    by = [F.col(c).asc_nulls_last() for c in order]
    laid_out = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(*keep, F.monotonically_increasing_id().alias("_position"))
    )
    staged = stage_table(laid_out, label, **COMPACT)
    # monotonically_increasing_id holds the partition above bit 33, the row below it
    return staged.select(
        *keep,
        F.shiftrightunsigned("_position", 33).alias("_part"),
        F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )


def add_dense_key(df: DataFrame, order: Sequence[str], key: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Number the rows 1..n in the given total order; of the columns, those in keep remain (all, unless given)."""
    parts = _range_parts(df, order, f"dense-{key}", keep)
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range partition, so this unpartitioned window stays tiny
    before = Window.orderBy("_part").rowsBetween(*_BEFORE)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return parts.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(key), *(df.columns if keep is None else keep)
    )


def add_sum_before(df: DataFrame, order: Sequence[str], amount: str, total: str) -> DataFrame:
    """The sum of amount over all rows that come earlier in the given total order."""
    parts = _range_parts(df, order, f"sum-{total}")
    before = Window.orderBy("_part").rowsBetween(*_BEFORE)
    # one row per range partition, as in add_dense_key
    offsets = parts.groupBy("_part").agg(F.sum(amount).alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.sum(amount).over(Window.partitionBy("_part").orderBy("_pos").rowsBetween(*_BEFORE))
    return parts.withColumn("_inside", inside).join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.coalesce("_inside", F.lit(0))).alias(total)
    )


def add_group_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[str], rank: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """row_number() per group in a total order, for groups of any size; keep, with the group in it, as in add_dense_key."""
    parts = _range_parts(df, [*group, *order], f"rank-{rank}", keep)
    pieces = parts.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(*_BEFORE)
    # Only groups that continue from an earlier partition have an offset, and a
    # partition can continue one group at most: no more rows than partitions.
    continued = pieces.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_part").alias("_g_part"),
        F.sum("_rows").over(before).alias("_offset"),
    ).where(F.col("_offset").isNotNull())
    inside = Window.partitionBy(*group, "_part").orderBy("_pos")
    local = parts.withColumn("_local", F.row_number().over(inside))
    same_piece = F.col("_part") == F.col("_g_part")
    for c in group:
        same_piece = same_piece & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return local.join(F.broadcast(continued), same_piece, "left").select(
        *(df.columns if keep is None else keep),
        (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).cast("bigint").alias(rank),
    )


def add_queue_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], closes: str, rank: str) -> DataFrame:
    """First in, first out in one queue per group: a closing row gets the rank of the opening row that it takes out.

    closes is a boolean column without nulls; opening rows are ranked 1, 2, ... per group. A closing row that finds its
    queue empty takes nothing and has a null rank. order has to be total and decides ties.

    Let the balance be the openings less the closings so far. A closing finds the queue empty where it takes the balance
    below zero and below all balances before, so sums and minima are enough, and those of a range partition add up to
    two offsets: what came in before it, and the least balance before it. A group of any size spreads over tasks.
    """
    parts = _range_parts(df, [*group, *order], f"queue-{rank}").withColumns(
        {"_opening": F.when(F.col(closes), 0).otherwise(1), "_step": F.when(F.col(closes), -1).otherwise(1)}
    )
    inside = Window.partitionBy(*group, "_part").orderBy("_pos")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.withColumns({"_opened": F.sum("_opening").over(so_far), "_balance": F.sum("_step").over(so_far)})
    pieces = local.groupBy(*group, "_part").agg(
        F.sum("_opening").alias("_in"), F.sum("_step").alias("_sum"), F.min("_balance").alias("_low")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(*_BEFORE)
    # as in add_group_rank, no more rows with offsets than partitions
    continued = (
        pieces.withColumns({"_in_before": F.sum("_in").over(before), "_sum_before": F.sum("_sum").over(before)})
        .withColumn("_low_before", F.min(F.coalesce("_sum_before", F.lit(0)) + F.col("_low")).over(before))
        .where(F.col("_in_before").isNotNull())
        .select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("_part").alias("_g_part"), "_in_before", "_sum_before", "_low_before")
    )
    same_piece = F.col("_part") == F.col("_g_part")
    for c in group:
        same_piece = same_piece & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    sum_before = F.coalesce("_sum_before", F.lit(0))
    opened = F.col("_opened") + F.coalesce("_in_before", F.lit(0))
    balance = F.col("_balance") + sum_before
    least = F.least(F.lit(0), F.coalesce("_low_before", F.lit(0)), F.coalesce(F.col("_least") + sum_before, F.lit(0)))
    taken = F.when(balance >= least, opened - balance + least)
    return (
        local.withColumn("_least", F.min("_balance").over(inside.rowsBetween(*_BEFORE)))
        .join(F.broadcast(continued), same_piece, "left")
        .select(*df.columns, F.when(F.col(closes), taken).otherwise(opened).cast("bigint").alias(rank))
    )
