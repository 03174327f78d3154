"""Jaccard join of word n-gram sets by parity sketches.

Every document becomes a set of 64-bit shingle hashes. Sets of one size band (a power of two) share a sketch of m
words: each shingle XORs its hash into one word, so a pair whose symmetric difference is d differs in at most d
words and agrees in m - d. By the pigeonhole principle the d + 1 most telling words of both (those that hold most
shingles, in one order for all documents) then have a word in common. Documents that share a word are candidates.
A second sketch of 1,024 bits, in which each shingle flips one bit, bounds the difference from below by its Hamming
distance; what passes is verified on the whole texts. A set near the lower end of its band also joins the band below.

Pairs inside a group are never all emitted. First every document is compared with the smallest id of each group it
is in, batch by batch before the shuffle, so a frequent word travels once per batch. The verified links give
components. In groups that still hold several components, sketches are compared across components: first only the
likeliest pair of each two components is verified, then every pair that is left and that sketches do not rule out.
That loses no connection: two members of one component need no further link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspark.llm.graph import components
from ledgerspark.llm.tables import frugal, scratch, stage

BITS = 1024
#: Members of an open group that are compared with each other in one cell.
GROUP_BLOCK = 1024
#: About so many documents, chosen by a hash, in which common shingles are looked for, and how many of those are used.
SAMPLE_ROWS, COMMON_SHINGLES = 8192, 100_000
_SIGNATURE = "doc_id bigint, n_shingles bigint, digest bigint, bits array<bigint>, keys array<bigint>"
_SIGNATURE_AND_TEXT = f"{_SIGNATURE}, text string"
_U = np.uint64
_NONE = np.empty(0, _U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; a shorter text is one shingle, an empty one has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, _U)
    for i in range(width):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + hashed[i : i + count])
    return np.unique(out)


def difference_bound(a: int, b: int, num: int, den: int) -> int:
    """Largest symmetric difference of sets of a and b members with den * intersection >= num * union."""
    return (den - num) * (a + b) // (den + num)


def _band_words(band: int, num: int, den: int) -> int:
    top = (2 << band) - 1
    return 2 * (difference_bound(top, top * den // num, num, den) + 1)


def band_keys(hashes: np.ndarray, num: int, den: int, common: np.ndarray = _NONE) -> np.ndarray:
    """The keys under which a set is looked up, in its band and, near the lower end, in the band below.

    common holds sorted hashes of shingles that count for less; any set of them is right, as long as all documents
    use the same one.
    """
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.int64)
    at = np.searchsorted(common, hashes)
    rare = np.append(common, _U(0))[at] != hashes if len(common) else np.ones(n, bool)
    own = n.bit_length() - 1
    bands = [(own, n * den // num)]
    if own and -(-n * num // den) < (1 << own):
        bands.append((own - 1, (1 << own) - 1))
    found = []
    for band, partner in bands:
        m = _band_words(band, num, den)
        spread = _mix(hashes ^ _U(0xD6E8FEB86659FD93 + band))
        word = (spread % _U(m)).astype(np.int64)
        order = np.argsort(word, kind="stable")
        starts = np.flatnonzero(np.diff(word[order], prepend=-1))
        used = word[order][starts]
        parity = np.zeros(m, _U)
        parity[used] = np.bitwise_xor.reduceat(hashes[order], starts)
        held = np.zeros(m, np.int64)
        held[used] = np.diff(np.append(starts, n))
        telling = np.zeros(m, np.int64)
        telling[used] = np.add.reduceat(rare[order].astype(np.int64), starts)
        keys = _mix(parity + _mix(np.arange(m, dtype=_U) + _U(band << 32)))
        take = min(m, difference_bound(n, partner, num, den) + 1)
        found.append(keys[np.lexsort((keys, -held, -telling))[:take]])
    return np.concatenate(found).view(np.int64)


def bit_sketch(hashes: np.ndarray) -> np.ndarray:
    """Each shingle flips one of BITS bits: the Hamming distance of two sketches never exceeds the difference."""
    flips = np.bincount((hashes >> _U(17)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _sign(
    batches: Iterator[pa.RecordBatch], width: int, num: int, den: int, common: np.ndarray, with_text: bool
) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows: list[tuple] = []
            for text in part.column(1):
                h = shingle_hashes(text.as_py(), width)
                rows.append((len(h), xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63), bit_sketch(h), band_keys(h, num, den, common)))
            lists = [
                pa.ListArray.from_arrays(
                    np.cumsum([0, *(len(r[i]) for r in rows)], dtype=np.int32), np.concatenate([r[i] for r in rows])
                )
                for i in (2, 3)
            ]
            text = {"text": part.column(1)} if with_text else {}
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0),
                "n_shingles": pa.array([r[0] for r in rows], pa.int64()),
                "digest": pa.array([r[1] for r in rows], pa.int64()),
                "bits": lists[0],
                "keys": lists[1],
                **text,
            })


def _shingles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        for text in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text.as_py(), width).view(np.int64))], names=["shingle"])


def _common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that several documents of a sample hold; they only decide which words go first."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) < int(share * (1 << 32))
    sample = docs.where(chosen).select("text")
    held = sample.mapInArrow(partial(_shingles, width=width), "shingle bigint").groupBy("shingle").count().where(F.col("count") >= 4)
    found = held.orderBy(F.desc("count"), "shingle").limit(COMMON_SHINGLES).select("shingle").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(_U))


def _lead(batches: Iterator[pa.RecordBatch], pairs: bool) -> Iterator[pa.RecordBatch]:
    """Of each batch: its smallest id under each key, or the distinct (smallest id, other id) pairs under any key."""
    frugal()
    for batch in batches:
        lists = batch.column(1)
        keys = lists.flatten().to_numpy(zero_copy_only=False)
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False))
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        if not pairs:
            yield pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(ids[first])], names=["key", "doc_id"])
            continue
        lead = np.repeat(ids[first], np.diff(np.append(first, len(keys))))
        both = np.unique(np.stack([lead, ids], 1)[lead != ids], axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], width: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        kept, known = [], {}
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            if a[i] not in known:  # rows of one leader come together
                known = {a[i]: shingle_hashes(batch.column(2)[i].as_py(), width)}
            x, y = known[a[i]], shingle_hashes(batch.column(3)[i].as_py(), width)
            same = len(np.intersect1d(x, y, assume_unique=True))
            kept.append(den * same >= num * (len(x) + len(y) - same))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept, pa.bool_())), batch.column(1).filter(pa.array(kept, pa.bool_()))], names=["a", "b"])


def _possible(x: str, y: str, num: int, den: int) -> Column:
    """False only where sizes or bit sketches rule a link out; x and y are prefixes or suffixes of the columns."""
    n = [F.col(c) for c in (x.format("n_shingles"), y.format("n_shingles"))]
    bits = [F.col(c) for c in (x.format("bits"), y.format("bits"))]
    apart = reduce(add, (F.bit_count(bits[0][i].bitwiseXOR(bits[1][i])) for i in range(BITS // 64)))
    return (
        (den * F.least(*n) >= num * F.greatest(*n)) & ((den + num) * apart.cast("bigint") <= (den - num) * (n[0] + n[1]))
    )


def _verified(pairs: DataFrame, met: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of the distinct pairs (a, b) that link; met has the signatures and texts of all their documents."""
    for side in "ab":
        pairs = pairs.hint("merge").join(met.select(F.col("doc_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n_shingles", "digest", "bits"))), side)
    possible = stage(
        pairs.where(_possible("{}_a", "{}_b", num, den)).select("a", "b", (F.col("digest_a") == F.col("digest_b")).alias("equal")),
        "parity-candidates",
    )
    checked = _checked(possible.where("not equal").select("a", "b"), met, width, num, den)
    return possible.where("equal").select("a", "b").unionByName(checked)


def _checked(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts link."""
    with_text = [
        pairs.hint("merge").join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side) for side in "ab"
    ]
    return with_text[0].join(with_text[1].hint("merge"), ["a", "b"]).select("a", "b", "text_a", "text_b").mapInArrow(
        partial(_verify, width=width, num=num, den=den), "a bigint, b bigint"
    )


def _unsettled(members: DataFrame) -> DataFrame:
    """Members of the groups that hold more than one part, with the number of their group."""
    group = Window.partitionBy("key")
    return (
        members.withColumn("low", F.min("part").over(group)).withColumn("high", F.max("part").over(group))
        .withColumn("size", F.count(F.lit(1)).over(group)).where("low < high").drop("low", "high")
    )


def _across(rows: dict[str, np.ndarray], num: int, den: int, every: bool) -> np.ndarray | None:
    """Pairs of rows in different parts that may link: for each two parts the likeliest one, or every one."""
    ids, parts, n, bits = (rows[c] for c in ("doc_id", "part", "n_shingles", "bits"))
    lo, hi = rows["lo"][0], rows["hi"][0]
    left = np.flatnonzero(rows["block"] == lo)
    right = left if lo == hi else np.flatnonzero(rows["block"] == hi)
    found = []
    for i in range(0, len(left), 256):
        for j in range(i if lo == hi else 0, len(right), 256):
            x, y = left[i : i + 256], right[j : j + 256]
            total = n[x][:, None] + n[y]
            small = np.minimum(n[x][:, None], n[y])
            may = (parts[x][:, None] != parts[y]) & (den * small >= num * (total - small))
            if lo == hi and i == j:
                may = np.triu(may, 1)
            p, q = np.nonzero(may)
            if not len(p):
                continue
            a, b = x[p], y[q]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64)
            near = (den + num) * apart <= (den - num) * (n[a] + n[b])
            a, b, score = a[near], b[near], apart[near] / np.maximum(1, n[a] + n[b])[near]
            if not len(a):
                continue
            pairs = np.stack([np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])], 1)
            if not every:
                one, two = np.minimum(parts[a], parts[b]), np.maximum(parts[a], parts[b])
                order = np.lexsort((pairs[:, 1], pairs[:, 0], score, two, one))
                one, two = one[order], two[order]
                pairs = pairs[order][np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))]
            found.append(pairs)
    return np.concatenate(found) if found else None


def _compare(batches: Iterator[pa.RecordBatch], num: int, den: int, every: bool) -> Iterator[pa.RecordBatch]:
    """_across for every cell of sorted rows."""
    frugal()
    held: pa.Table | None = None

    def pairs_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {c: rows[c].to_numpy() for c in ("key", "doc_id", "n_shingles", "part", "block", "lo", "hi")}
        columns["bits"] = rows["bits"].combine_chunks().flatten().to_numpy().view(_U).reshape(-1, BITS // 64)
        keys = np.stack([columns[c] for c in ("key", "lo", "hi")], 1)
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))).tolist()
        known = [
            some for start, stop in zip(starts, [*starts[1:], len(keys)], strict=True) if stop - start > 1
            and (some := _across({c: v[start:stop] for c, v in columns.items()}, num, den, every)) is not None
        ]
        if known:
            both = np.unique(np.concatenate(known), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        last = np.ones(rows.num_rows, bool)
        for c in ("key", "lo", "hi"):
            values = rows[c].to_numpy()
            last &= values == values[-1]
        whole = rows.num_rows - int(last.sum())  # the last cell may go on in the next batch
        if whole:
            yield from pairs_of(rows.slice(0, whole))
        held = rows.slice(whole)
    if held is not None:
        yield from pairs_of(held)


def _candidates(members: DataFrame, num: int, den: int, every: bool) -> DataFrame:
    """Distinct pairs of members of one group and different parts that may link.

    A large group is cut into blocks by a hash, and each two blocks are compared in a cell of their own.
    """
    blocks = F.ceil(F.col("size") / GROUP_BLOCK)
    cells = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks)).withColumn(
        "cell", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi"))))
    ).select("key", "doc_id", "n_shingles", "part", "bits", "block", "cell.lo", "cell.hi")
    return (
        cells.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
        .mapInArrow(partial(_compare, num=num, den=den, every=every), "a bigint, b bigint").distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text, further columns are ignored).

    Words are what ASCII white space separates, with A-Z in lower case. Documents link when
    den * intersection >= num * union of their distinct shingles. A null or empty text has no shingles and links
    with nothing. A null doc_id is reported with its count and no component. Rows that repeat a doc_id count as one
    document for linking: what any of them links with, all do. Component is the smallest doc_id that links reach.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    with scratch(docs.sparkSession):
        return stage(_near_duplicates(docs, width, num, den), "parity-result", keep=True)


def _near_duplicates(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    sign = partial(_sign, width=width, num=num, den=den, common=_common_shingles(docs, width))
    signed = stage(docs.mapInArrow(partial(sign, with_text=False), _SIGNATURE), "parity-sketches")
    keyed = signed.where("doc_id is not null and n_shingles > 0").select("doc_id", "keys")
    inside = keyed.mapInArrow(partial(_lead, pairs=True), "a bigint, b bigint")
    leaders = keyed.mapInArrow(partial(_lead, pairs=False), "key bigint, doc_id bigint")
    across = leaders.select(F.min("doc_id").over(Window.partitionBy("key")).alias("a"), F.col("doc_id").alias("b")).where("a < b")
    stars = stage(inside.unionByName(across).distinct(), "parity-stars")
    # all further work is on the documents that met another one under some key
    partners = stars.select(F.col("a").alias("doc_id")).unionByName(stars.select(F.col("b").alias("doc_id"))).distinct()
    met = stage(docs.join(partners.hint("merge"), "doc_id").mapInArrow(partial(sign, with_text=True), _SIGNATURE_AND_TEXT).where("n_shingles > 0"), "parity-met")
    links = stage(_verified(stars, met, width, num, den), "parity-links")
    found = components(links)

    def with_part(df: DataFrame, column: str, part: str) -> DataFrame:
        return df.join(found.select(F.col("node").alias(column), F.col("component").alias("_c")), column, "left").select(
            *df.columns, F.coalesce("_c", column).alias(part)
        )

    # groups whose members are not all connected yet
    apart = with_part(with_part(stars, "a", "in_a"), "b", "in_b").where("in_a != in_b")
    open_parts = apart.select(F.col("in_a").alias("part")).unionByName(apart.select(F.col("in_b").alias("part"))).distinct()
    open_ids = with_part(met.select("doc_id").distinct(), "doc_id", "part").join(open_parts, "part")
    members = stage(
        _unsettled(
            met.select("doc_id", "n_shingles", "bits", F.array_distinct("keys").alias("keys")).join(open_ids, "doc_id")
            .select(F.explode("keys").alias("key"), "doc_id", "n_shingles", "bits", "part")
        ),
        "parity-open",
    )
    texts = stage(
        met.select("doc_id", "text").join(members.select("doc_id").distinct().hint("merge"), "doc_id"), "parity-open-texts"
    )
    tested = stars
    for every in (False, True):
        pairs = stage(_candidates(members, num, den, every).join(tested, ["a", "b"], "left_anti"), "parity-across")
        links = stage(_checked(pairs, texts, width, num, den), "parity-links")
        if not links.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))
            if not every:
                members = stage(_unsettled(with_part(members.drop("part", "size"), "doc_id", "part")), "parity-open")
        tested = tested.unionByName(pairs)
    return signed.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs but those whose document links, directly or not, with one of a smaller doc_id; all columns."""
    later = near_duplicates(docs, width, num, den).where("doc_id != component_id").select(F.col("doc_id").alias("_later")).distinct()
    return docs.join(later, docs["doc_id"] == later["_later"], "left_anti")
