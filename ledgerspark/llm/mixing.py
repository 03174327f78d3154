"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are dealt into blocks of a fixed number of rows. With integer weights p that sum to Q, block j of a
source may run from slot floor(j Q / p) on and must run before slot ceil((j + 1) Q / p); earliest deadline first over
one slot at a time keeps every source within one block of its share at all times. The schedule repeats after Q slots,
so it is computed once for one cycle and looked up by every block. When a source runs out, the others go on in
proportion to their weights in a new phase. No row is dropped or repeated.

The driver sees one row per source and phase, and cycles of Q slots: sources are a bounded list, which is checked.
"""

from __future__ import annotations

from collections.abc import Mapping
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window, functions as F

from ledgerspark.staging import stage_table

#: Rows of a block.
BLOCK_ROWS = 64
#: Weights derived from row counts sum to about this.
CYCLE = 1000
#: More sources than this are refused.
MAX_SOURCES = 10_000
#: Rows that are put in order in one group, on average.
BUCKET_ROWS = 4096
#: Rows of the mixture over which a running total is summed in one group.
STRETCH_ROWS = 1 << 14


def cycle_slots(weights: Mapping[str, int]) -> list[str]:
    """Which source runs in each slot of a cycle: earliest deadline first among the released blocks."""
    q, sources = sum(weights.values()), sorted(weights)
    released: list[list[tuple[int, int, str]]] = [[] for _ in range(q)]
    for s in sources:
        for j in range(weights[s]):
            released[j * q // weights[s]].append((-(-(j + 1) * q // weights[s]), len(released), s))
    ready: list[tuple[int, int, str]] = []
    slots = []
    for t in range(q):
        for block in released[t]:
            heappush(ready, block)
        slots.append(heappop(ready)[2])
    return slots


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[dict]:
    """Runs of one set of active sources: first slot, first block of each source, length and the cycle."""
    left, done, start, out = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    while active := {s: weights[s] for s in left if left[s] > 0}:
        slots = cycle_slots(active)
        at = {s: [] for s in active}
        for i, s in enumerate(slots):
            at[s].append(i)
        # a source ends after the slot of its last block; the phase ends with the first that does
        ends = {s: ((left[s] - 1) // p) * len(slots) + at[s][(left[s] - 1) % p] + 1 for s, p in active.items()}
        length = min(ends.values())
        ran = {s: length // len(slots) * p + sum(i < length % len(slots) for i in at[s]) for s, p in active.items()}
        out.append({"start": start, "from": {s: done[s] for s in active}, "ran": ran, "cycle": len(slots), "at": at})
        for s in active:
            left[s] -= ran[s]
            done[s] += ran[s]
        start += length
    return out


def integer_weights(rows: Mapping[str, int], power: float, cycle: int = CYCLE) -> dict[str, int]:
    """Weights in proportion to rows ** power, at least 1 each."""
    raised = {s: n**power for s, n in rows.items()}
    total = sum(raised.values()) or 1
    return {s: max(1, round(cycle * x / total)) for s, x in raised.items()}


def pfair_mix(
    docs: DataFrame, weights: Mapping[str, int] | None = None, power: float = 0.5, block_rows: int = BLOCK_ROWS,
    source: str = "source", row_id: str = "doc_id",
) -> DataFrame:
    """docs plus _source, _block, _slot and _place: the row's block in its source, the block's slot, the place in it.

    Ordering by (_slot, _place) gives the mixture. weights gives integers for every source; without them they follow
    the row counts raised to power. A null source is a source of its own, named ''. Inside a source, rows are in the order of a
    hash of their id, ties by id; rows that repeat an id are told apart by their content's hash, and rows that are
    wholly equal are interchangeable. Columns of docs with these names are replaced. An empty table stays empty.
    """
    docs = docs.drop("_source", "_block", "_slot", "_place", "_bucket")
    named = docs.withColumn("_source", F.coalesce(F.col(source).cast("string"), F.lit("")))
    spark = docs.sparkSession
    counted = named.groupBy("_source").agg(F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = {r["_source"]: r["rows"] for r in counted}
    chosen = dict(weights) if weights is not None else integer_weights(rows, power)
    if missing := sorted(s for s in rows if chosen.get(s, 0) < 1):
        raise ValueError(f"no weight for {missing[:5]}")
    plan = phases({s: -(-n // block_rows) for s, n in rows.items()}, chosen)

    # position of a row in its source: a bucket's place among the source's buckets plus the place in the bucket
    buckets = spark.createDataFrame([(s, -(-n // BUCKET_ROWS)) for s, n in rows.items()], "_source string, _buckets bigint")
    shuffled = F.xxhash64(F.lit("mix"), F.col(row_id))
    spread = named.join(F.broadcast(buckets), "_source").withColumn("_bucket", F.pmod(shuffled, F.col("_buckets")))
    sizes = stage_table(spread.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_many")), "mix-buckets")
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_source", "_bucket", F.coalesce(F.sum("_many").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_source", "_bucket").orderBy(shuffled, row_id, F.xxhash64(*docs.columns))
    placed = (
        spread.withColumn("_rank", F.row_number().over(inside) - 1).join(offsets, ["_source", "_bucket"])
        .withColumn("_position", F.col("_offset") + F.col("_rank"))
        .withColumn("_block", F.floor(F.col("_position") / block_rows))
    )
    runs, cycles = [], []
    for k, p in enumerate(plan):
        for s, first in p["from"].items():
            share = len(p["at"][s])
            runs.append((s, first, first + p["ran"][s], k, p["start"], p["cycle"], share))
            cycles += [(s, k, j, i) for j, i in enumerate(p["at"][s])]
    run = spark.createDataFrame(runs, "_source string, _from bigint, _to bigint, _phase int, _start bigint, _cycle bigint, _share bigint")
    slot = spark.createDataFrame(cycles, "_source string, _phase int, _turn bigint, _at bigint")
    return (
        placed.join(F.broadcast(run), "_source").where("_block >= _from and _block < _to")
        .withColumn("_turn", (F.col("_block") - F.col("_from")) % F.col("_share"))
        .join(F.broadcast(slot), ["_source", "_phase", "_turn"])
        .select(
            *docs.columns, "_source", "_block",
            (F.col("_start") + F.floor((F.col("_block") - F.col("_from")) / F.col("_share")) * F.col("_cycle") + F.col("_at")).alias("_slot"),
            (F.col("_position") % block_rows).alias("_place"),
        )
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, all of them, laid out in the order of the mixture."""
    mixed = pfair_mix(docs, **options)
    return mixed.repartitionByRange("_slot", "_place").sortWithinPartitions("_slot", "_place").select(*docs.columns)


def laid_positions(docs: DataFrame) -> DataFrame:
    """docs, which have to be read from files, plus _position: the row's number, from 0, in the order of the files.

    Spark's writers number files as the tasks are, so a table that in_mixed_order has laid out is numbered in the order
    of the mixture. One offset per file is broadcast.
    """
    rows = docs.drop("_position", "_file", "_row").select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    files = stage_table(rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")), "mix-files")
    # a number that has outgrown its leading zeros makes a longer name
    before = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return rows.join(F.broadcast(offsets), "_file").withColumn("_position", F.col("_offset") + F.col("_row")).drop("_file", "_row", "_offset")


def total_before(rows: DataFrame, position: str, amount: str, total: str) -> DataFrame:
    """rows plus total: the sum of amount over all rows of a smaller position; positions are 0, 1, 2 and so on.

    Stretches of STRETCH_ROWS rows are summed in groups of their own; one offset per stretch is broadcast.
    """
    parts = rows.withColumn("_stretch", F.floor(F.col(position) / STRETCH_ROWS))
    sums = parts.groupBy("_stretch").agg(F.sum(amount).alias("_sum"))
    before = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_stretch", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_stretch").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.withColumn(total, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_stretch")
        .withColumn(total, F.col(total) + F.col("_offset"))
        .drop("_stretch", "_offset")
    )
