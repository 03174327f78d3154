"""Cosine join of vectors in epsilon grid order.

On unit vectors, cosine >= c means distance <= eps = sqrt(2 - 2c). Vectors are projected on their leading principal
axes, which never lengthens a distance, and sorted by the grid cells of width eps there. The sorted sequence is cut
into intervals. Two intervals meet only if their boxes come within eps; a meeting pair is halved again and again, and
parts whose boxes are too far apart are skipped, before the rest is compared exactly in double precision.

Equal vectors are one member with a count. A pair of intervals returns link counts and, for connectivity, the root
of each vector among the two intervals: never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.graph import components
from ledgerspark.llm.tables import scratch, stage

#: Leading principal axes of the grid.
AXES = 8
#: Vectors of an interval, and of a part that is compared without further halving.
INTERVAL, LEAF = 4096, 256
#: The axes are fitted on at most this many vectors, those with the smallest hashes; they decide on speed alone.
FIT_ROWS = 4096
_SLACK = 1e-9


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors at length one, with their size and a digest of their values."""
    for batch in batches:
        ids, sizes, digests, units = [], [], [], []
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            items = value.values
            if items is None or not len(items) or items.null_count or key is None:
                continue
            v = items.to_numpy().astype(np.float64) + 0.0
            high = np.abs(v).max()
            if not np.isfinite(v).all() or high == 0:
                continue
            ids.append(key)
            sizes.append(len(v))
            digests.append(xxhash.xxh3_128_digest(v.tobytes()))
            v = v / high
            units.append(v / np.sqrt(v @ v))
        offsets = np.cumsum([0, *sizes], dtype=np.int32)
        values = np.concatenate(units) if units else np.empty(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, values)],
            names=["vec_id", "dims", "digest", "unit"],
        )


def principal_axes(sample: np.ndarray, axes: int) -> np.ndarray:
    """Orthonormal columns, strongest first; fewer than asked for if there are fewer dimensions."""
    centred = sample - sample.mean(0)
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :axes]


def _padded(lists: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _project(batches: Iterator[pa.RecordBatch], axes: np.ndarray, eps: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = _padded(batch.column(3), len(axes)) @ axes
        cells = np.floor(places / eps).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.tolist(), pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"])


def _intervals(batches: Iterator[pa.RecordBatch], axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per stretch of the sorted sequence: ids, copies, sizes, vectors, and its box on the axes."""
    held: list[pa.RecordBatch] = []

    def pack(rows: pa.Table) -> pa.RecordBatch:
        units = _padded(rows["unit"].combine_chunks(), len(axes))
        places = units @ axes
        return pa.RecordBatch.from_arrays(
            [pa.array([rows["rep"].to_pylist()], pa.list_(pa.int64())), pa.array([rows["copies"].to_pylist()], pa.list_(pa.int64())),
             pa.array([rows["dims"].to_pylist()], pa.list_(pa.int32())), pa.array([units.tobytes()], pa.binary()),
             pa.array([places.min(0).tolist()], pa.list_(pa.float64())), pa.array([places.max(0).tolist()], pa.list_(pa.float64()))],
            names=["reps", "copies", "dims", "units", "low", "high"],
        )

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= INTERVAL:
            rows = pa.Table.from_batches(held)
            whole = rows.num_rows // INTERVAL * INTERVAL
            for at in range(0, whole, INTERVAL):
                yield pack(rows.slice(at, INTERVAL))
            held = rows.slice(whole).to_batches()
    if sum(b.num_rows for b in held):
        yield pack(pa.Table.from_batches(held))


def _find(root: np.ndarray, at: np.ndarray) -> np.ndarray:
    while (root[at] != at).any():
        at = root[at]
    return at


def _link(batches: Iterator[pa.RecordBatch], axes: np.ndarray, cosine: float, eps: float) -> Iterator[pa.RecordBatch]:
    """(rep, links, root) of the vectors of two intervals that link with one of the other, or of the same."""
    for batch in batches:
        for row in batch.to_pylist():
            same = row["a"] == row["b"]
            names = ["a"] if same else ["a", "b"]
            units = [np.frombuffer(row[f"units_{s}"]).reshape(-1, len(axes)) for s in names]
            dims = [np.array(row[f"dims_{s}"]) for s in names]
            copies = [np.array(row[f"copies_{s}"]) for s in names]
            places = [u @ axes for u in units]
            x, y = 0, len(names) - 1
            links = [np.zeros(len(u), np.int64) for u in units]
            shift = 0 if same else len(units[0])
            root = np.arange(shift + len(units[y]))

            def compare(i: int, n: int, j: int, m: int) -> None:
                """Rows i..n of the first against rows j..m of the second; in one interval only with i <= j."""
                p, q = places[x][i:n], places[y][j:m]  # noqa: B023
                gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
                if gap @ gap > eps * eps:
                    return
                if max(n - i, m - j) > LEAF:
                    mid, cut = (i + n) // 2, (j + m) // 2
                    for a, b in ((i, mid), (mid, n)):
                        for c, d in ((j, cut), (cut, m)):
                            if a < b and c < d and not (same and a > c):  # noqa: B023
                                compare(a, b, c, d)
                    return
                close = units[x][i:n] @ units[y][j:m].T >= cosine  # noqa: B023
                close &= dims[x][i:n, None] == dims[y][None, j:m]  # noqa: B023
                if same and i == j:  # noqa: B023
                    close = np.triu(close, 1)
                if not close.any():
                    return
                links[x][i:n] += close @ copies[y][j:m]  # noqa: B023
                links[y][j:m] += copies[x][i:n] @ close  # noqa: B023
                left, right = np.nonzero(close)
                ends = _find(root, left + i), _find(root, right + j + shift)  # noqa: B023
                for u, v in np.unique(np.stack([np.minimum(*ends), np.maximum(*ends)], 1), axis=0).tolist():
                    u, v = _find(root, np.array([u]))[0], _find(root, np.array([v]))[0]  # noqa: B023
                    root[max(u, v)] = min(u, v)  # noqa: B023

            compare(0, len(units[x]), 0, len(units[y]))
            reps = np.concatenate([np.array(row[f"reps_{s}"], np.int64) for s in names])
            counts = np.concatenate(links)
            got = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps[got]), pa.array(counts[got]), pa.array(reps[_find(root, got)])], names=["rep", "links", "root"]
            )


def cosine_links(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding, further columns ignored).

    A vector that is null, empty or zero, or holds null or non-finite components, links with nothing; so does one
    with a null vec_id. Vectors of different sizes never link. Repeated rows count as vectors of their own in n_links; a
    vec_id that comes with several vectors links with all that any of them does.
    component_id is the smallest vec_id that links reach; kept is vec_id = component_id. An empty table stays empty.
    """
    with scratch(vectors.sparkSession):
        return stage(_cosine_links(vectors, cosine), "grid-result", keep=True)


def _cosine_links(vectors: DataFrame, cosine: float) -> DataFrame:
    eps = math.sqrt(2 - 2 * cosine) + _SLACK
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding"))
    valid = stage(rows.mapInArrow(_unit, "vec_id bigint, dims int, digest binary, unit array<double>"), "grid-vectors")
    groups = valid.groupBy("digest", "dims").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    result = rows.select("vec_id")
    sample = valid.select("vec_id", "digest", "dims", "unit").orderBy(F.xxhash64("digest")).limit(FIT_ROWS).collect()
    if not sample:
        return result.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    width = valid.agg(F.max("dims")).first()[0]
    fitted = np.zeros((len(sample), width))
    for i, row in enumerate(sample):
        fitted[i, : row["dims"]] = row["unit"]
    axes = principal_axes(fitted, min(AXES, width))

    distinct = valid.join(groups, ["digest", "dims"]).where("vec_id = rep").dropDuplicates(["digest", "dims"])
    placed = stage(
        distinct.select("rep", "copies", "dims", "unit")
        .mapInArrow(partial(_project, axes=axes, eps=eps), "rep bigint, copies bigint, dims int, unit array<double>, cell array<int>"),
        "grid-cells",
    )
    packed = "reps array<bigint>, copies array<bigint>, dims array<int>, units binary, low array<double>, high array<double>"
    intervals = stage(
        placed.repartitionByRange("cell", "rep").sortWithinPartitions("cell", "rep").drop("cell")
        .mapInArrow(partial(_intervals, axes=axes), packed).withColumn("interval", F.monotonically_increasing_id()),
        "grid-intervals",
    )
    boxes = intervals.select("interval", "low", "high").withColumn(
        "strip", F.explode(F.sequence(F.floor(F.col("low")[0] / eps), F.floor(F.col("high")[0] / eps)))
    )
    x, y = boxes.alias("x"), boxes.withColumn("strip", F.explode(F.array(*(F.col("strip") + i for i in (-1, 0, 1))))).alias("y")
    apart = F.aggregate(
        F.zip_with(
            F.zip_with("x.low", "y.high", lambda a, b: a - b), F.zip_with("y.low", "x.high", lambda a, b: a - b),
            lambda a, b: F.greatest(a, b, F.lit(0.0)),
        ),
        F.lit(0.0), lambda s, g: s + g * g,
    )
    meeting = (
        x.join(y, (F.col("x.strip") == F.col("y.strip")) & (F.col("x.interval") <= F.col("y.interval")) & (apart <= eps * eps))
        .select(F.col("x.interval").alias("a"), F.col("y.interval").alias("b")).distinct()
    )

    def side(name: str) -> DataFrame:
        return intervals.select(F.col("interval").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("reps", "copies", "dims", "units")))

    found = stage(
        meeting.join(side("a"), "a").join(side("b"), "b")
        .mapInArrow(partial(_link, axes=axes, cosine=cosine, eps=eps), "rep bigint, links bigint, root bigint"),
        "grid-links",
    )
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = (
        groups.join(linked, "rep", "left").join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("digest", "dims", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component"))
    )
    known = valid.select("vec_id", "digest", "dims").join(classes, ["digest", "dims"]).select("vec_id", "n", "component")
    lonely = rows.select("vec_id", "embedding").where(~_is_valid()).select("vec_id", F.lit(0).cast("bigint").alias("n"), F.col("vec_id").alias("component"))
    return known.unionByName(lonely).select(
        "vec_id", F.col("n").alias("n_links"), F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept")
    )


def _is_valid():
    """The test of _unit as a column."""
    item = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(item, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists(item, lambda v: v != 0), F.lit(False))
