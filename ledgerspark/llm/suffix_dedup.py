"""Removal of byte strings that occur more than once, by suffix arrays of shards that Spark deals out by content.

A string of `length` bytes that occurs twice has the same least k-gram (its anchor, by hash) at the same place both
times. So each text is cut into contexts, one per anchor: all bytes of the strings whose anchor it is. Strings of two
contexts can be equal only if the anchors are. Contexts whose anchor occurs once are never moved; of equal contexts one
is, with their number. The rest goes, by anchor, to shards. There suffix_sort sorts all suffixes by external induced
sorting, and a string that shares `length` bytes with a neighbour in that order occurs elsewhere.

An anchor with very many different contexts (a phrase that many texts share) is made longer, to the left or to the
right, until few are left; anchors of full length hold one string. No task gets more contexts of one anchor than
MOST_CONTEXTS. Contexts and anchors are told apart by two 64-bit hashes over their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.suffix_sort import SuffixSorter
from ledgerspark.llm.tables import frugal, scratch, stage

#: Bytes of text whose anchors are found together, and of contexts that are sorted together, so that both stay in the
#: processor's cache; one text or anchor may have more.
TEXT_BYTES, SHARD_BYTES = 64 << 10, 256 << 10
#: Anchors with more different contexts are made longer.
MOST_CONTEXTS = 2048
#: Fixed odd factors of the hash of byte strings.
_LEFT, _RIGHT, _BYTE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_DOC = "doc_id bigint, text_hash bigint"


def anchor_size(length: int) -> int:
    """The largest power of two up to a third of length."""
    return 1 << (length // 3).bit_length() - 1


def _twice(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of strings twice as long, from those of their halves."""
    left = h[:-step] * _LEFT
    left ^= left >> np.uint64(29)
    left += h[step:] * _RIGHT
    left ^= left >> np.uint64(32)
    return left


def _find(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text number, first start, number of starts, place of the anchor, anchor hash, context hash) of all contexts."""
    n, size = len(data), anchor_size(length)
    hashes, step = (data.astype(np.uint64) + np.uint64(1)) * _BYTE, 1
    hashes ^= hashes >> np.uint64(31)
    while step < size:
        hashes, step = _twice(hashes, step), step * 2
    bits = np.uint64(max(20, n.bit_length()))
    key = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)  # on ties the first place
    window, step = length - size + 1, 1
    while 2 * step <= window:
        key, step = np.minimum(key[:-step], key[step:]), step * 2
    rest = window - step
    if rest:
        key = np.minimum(key[:-rest], key[rest:])
    anchor = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)  # of the string from each place on
    sizes = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(ends)), sizes)[: len(anchor)]
    inside = np.flatnonzero(np.arange(len(anchor)) + length <= ends[text])
    new = np.flatnonzero(np.diff(anchor[inside], prepend=-1))
    low, count = inside[new], np.diff(np.append(new, len(inside)))
    at = anchor[low]
    long = _twice(hashes, size)
    room = count - 1 + length - 2 * size  # the context's hash covers it with strings of twice the anchor's size
    pieces = -(-(2 * length - size) // (2 * size))
    digest = count.astype(np.uint64) * _BYTE
    for i in range(pieces):
        digest = (digest ^ long[low + room * i // (pieces - 1)]) * _LEFT
        digest ^= digest >> np.uint64(30)
    return text[low], low - (ends - sizes)[text[low]], count, at - low, hashes[at].view(np.int64), digest.view(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    frugal()
    names = ["doc_id", "text_hash", "anchor", "context", "low", "starts", "place"]
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary())
        stops = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data, row = np.frombuffer(texts.buffers()[2] or b"", np.uint8), 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(stops, stops[row] + TEXT_BYTES, side="right")) - 1)
            mine = data[stops[row] : stops[stop]]
            if len(mine) >= length:
                of, low, count, place, anchor, context = _find(mine, stops[row + 1 : stop + 1] - stops[row], length)
                ids = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays(
                    [ids.column(0).take(pa.array(of)), ids.column(1).take(pa.array(of)), pa.array(anchor), pa.array(context),
                     pa.array(low.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(place.astype(np.int32))],
                    names=names,
                )
            row = stop


def _sort(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Contexts by anchor to (anchor, context, level, first, last start of a string that occurs elsewhere)."""
    frugal()

    def marks(rows: list[tuple[int, int, int, int, bytes, int]]) -> pa.RecordBatch:
        sizes = np.array([len(r[4]) for r in rows], np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        twice = np.zeros(int(sizes.sum()) + len(rows), bool)
        for positions, common in SuffixSorter([r[4] for r in rows], length).scan():
            same = np.flatnonzero(common >= length)
            twice[positions[same]] = True
            twice[positions[same - 1]] = True
        first, last = np.zeros(len(rows), np.int32), np.full(len(rows), -1, np.int32)
        at = np.flatnonzero(twice)
        of = np.searchsorted(begin, at, side="right") - 1
        last[of] = at - begin[of]
        first[of[::-1]] = (at - begin[of])[::-1]
        copied = np.array([r[2] > 1 for r in rows])
        first, last = np.where(copied, 0, first), np.where(copied, np.array([r[3] for r in rows]) - 1, last)
        kept = last >= first
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[5] for r in rows], pa.int32()),
             pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=["anchor", "context", "level", "first", "last"],
        ).filter(pa.array(kept))

    held, size = [], 0
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held and row[0] == held[-1][0] and row[1] == held[-1][1]:
                continue  # a row of docs that came twice
            if size >= SHARD_BYTES and row[0] != held[-1][0]:
                yield marks(held)
                held, size = [], 0
            held.append(row)
            size += len(row[4])
    if held:
        yield marks(held)


def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Texts with the contexts to take from them, to contexts."""
    frugal()
    for batch in batches:
        out, size = [], 0
        for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
            data = text.as_py()
            for c in wanted.as_py():
                piece = data[c["low"] : c["low"] + c["starts"] - 1 + length]
                out.append((c["anchor"], c["context"], c["copies"], c["starts"], c["place"], piece))
                size += len(piece)
            if size >= SHARD_BYTES:
                yield _rows(out)
                out, size = [], 0
        if out:
            yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    names = ["anchor", "context", "copies", "starts", "place", "bytes"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def _lengthen(pieces: DataFrame, length: int) -> DataFrame:
    """Each context of a frequent anchor as at most two with longer anchors: strings that reach far to the left, and the others.

    pieces has size, the anchor's. The result has a row per part, with the context it comes from and its shift in it.
    """
    left = f"cast(({length} - size + 1) div 2 as int)"
    by = pieces.withColumn("reach", F.expr(left)).withColumn("turn", F.expr("place - reach"))  # the last start of the left part
    parts = by.selectExpr("*", f"""inline(array(
        named_struct('shift', 0, 'parts', least(starts, turn + 1), 'to', size + reach, 'from', turn),
        named_struct('shift', greatest(0, turn + 1), 'parts', starts - greatest(0, turn + 1), 'to', {length} + 1 - reach, 'from', place)))
    """).where("parts > 0")
    return parts.selectExpr(
        "xxhash64(anchor, `from` = place, substring(bytes, `from` + 1, `to`)) as anchor", "anchor as old_anchor", "context as old_context",
        "shift", "copies", "parts as starts", "`from` - shift as place", "`to` as size", f"substring(bytes, shift + 1, parts - 1 + {length}) as bytes",
    ).withColumn("context", F.expr("xxhash64('part', bytes)"))


def _repeated_in_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """(anchor, context, first, last) of contexts with strings that occur elsewhere, last and first being starts.

    A context has its level: how often its anchor was made longer. From the last level up, what was found is handed to
    the contexts that it was made from, so that each level is read and joined once. Equal parts of contexts are put
    together behind the last level; up to there they are counted once, and a level is written as the tasks read it.
    """
    open_ = contexts.withColumn("size", F.lit(anchor_size(length)))
    few, levels = [], []
    while True:
        each = open_.select("anchor", "context").distinct() if levels else open_
        many = stage(each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_CONTEXTS).select("anchor"), "frequent-anchors")
        if many.isEmpty():
            few.append(open_)
            break
        few.append(open_.join(many, "anchor", "left_anti"))
        parts = stage(_lengthen(open_.join(many, "anchor", "left_semi"), length), "anchor-parts")
        levels.append(parts.select("anchor", "context", "old_anchor", "old_context", "shift").distinct())
        open_ = parts.select(*contexts.columns, "size")
    columns = ["anchor", "context", "copies", "starts", "bytes", "level"]
    cold, *longer = (some.withColumn("level", F.lit(k)).select(*columns) for k, some in enumerate(few))
    if longer:
        parts = reduce(DataFrame.unionByName, longer)
        shared = parts.groupBy("anchor").agg(F.sum("copies").alias("all")).where("all > 1").select("anchor")
        cold = cold.unionByName(
            parts.join(shared, "anchor", "left_semi").groupBy("anchor", "context")
            .agg(F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in columns[3:]])
        )
    marks = stage(
        cold.repartition("anchor").sortWithinPartitions("anchor", "context")
        .mapInArrow(partial(_sort, length=length), "anchor bigint, context bigint, level int, first int, last int"),
        "repeated",
    )

    def of(level: int) -> DataFrame:
        return marks.where(F.col("level") == level).drop("level")

    found = of(len(levels))
    for k, parts in reversed(list(enumerate(levels))):
        older = found.join(parts, ["anchor", "context"]).selectExpr(
            "old_anchor as anchor", "old_context as context", "first + shift as first", "last + shift as last"
        )
        found = of(k).unionByName(older)
    return found


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and covered stretches to (doc_id, n_bytes, spans, kept)."""
    frugal()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sizes, spans, kept = [], [], []
            for text, covered in zip(part.column(1), part.column(2), strict=True):
                data, merged = text.as_py(), []
                for span in sorted((s["from"], s["to"]) for s in covered.as_py() or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1] = (merged[-1][0], max(merged[-1][1], span[1]))
                    else:
                        merged.append(span)
                edges = [0, *(e for span in merged for e in span), len(data)]
                sizes.append(len(data))
                spans.append([{"from": a, "to": b} for a, b in merged])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if merged else data)
            kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """(doc_id, n_bytes, spans array<(from, to)>, kept binary) of every row of docs (doc_id, text; further columns ignored).

    A byte is removed if a string of length bytes that covers it also starts anywhere else, in the same text or in
    another; strings never cross texts, may overlap, and are judged on the input. spans are the maximal removed
    stretches, kept is what is left. A null text counts as empty; texts shorter than length keep everything. Rows with a
    repeated doc_id and equal texts are texts of their own, and so copies of each other. An empty table gives an empty
    result. Memory: a text, or TEXT_BYTES of texts; of contexts those of one anchor, or
    SHARD_BYTES, with waiting suffixes on disk.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )
    spark = docs.sparkSession
    with scratch(spark):
        found = texts.mapInArrow(
            partial(_contexts, length=length), f"{_DOC}, anchor bigint, context bigint, low int, starts int, place int"
        )
        shared = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
        places = stage(found.join(shared, "anchor", "left_semi"), "places")
        chosen = places.groupBy("anchor", "context").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash", "low", "starts", "place")).alias("one")
        ).select("anchor", "context", "copies", "one.*")
        wanted = chosen.groupBy("doc_id", "text_hash").agg(
            F.collect_list(F.struct("anchor", "context", "copies", "low", "starts", "place")).alias("wanted")
        )
        to_cut = texts.alias("t").join(
            wanted.alias("w"), F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.text_hash") == F.col("w.text_hash"))
        ).select("text", "wanted")
        contexts = stage(
            to_cut.mapInArrow(
                partial(_slices, length=length), "anchor bigint, context bigint, copies bigint, starts int, place int, bytes binary"
            ),
            "contexts",
        )
        marks = _repeated_in_contexts(contexts, length)
        covered = places.join(marks, ["anchor", "context"]).groupBy("doc_id", "text_hash").agg(
            F.collect_set(F.expr(f"named_struct('from', low + first, 'to', low + last + {length})")).alias("covered")
        )
        cut = texts.alias("t").join(
            covered.alias("c"), F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.text_hash") == F.col("c.text_hash")), "left"
        ).select("t.doc_id", "text", "covered")
        return stage(
            cut.mapInArrow(_remove, "doc_id bigint, n_bytes bigint, spans array<struct<from: int, to: int>>, kept binary"), "kept-bytes", keep=True
        )
