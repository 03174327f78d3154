"""Byte-level BPE: every distinct word is encoded once for all documents.

A scan splits the texts into words (pre-tokens) and numbers the distinct words of each block of documents, so a word
leaves a block once, however often it occurs, and a document becomes the sequence of its words' numbers. The words
are shuffled by themselves, which brings the copies of a word together and encodes it once; their ids go back to
the blocks that asked, and each document is put together again by position. No word can be a hot key: it has one
row per block at most. Decoding joins the ids with the token-byte table of the vocabulary, whose size is fixed.

A block is named after its place (partition, batch, row), the ids of its documents and its list of distinct words, so
blocks of copies or of empty texts are groups of their own. Should a second scan deal the documents out differently,
the words of a block would be missing, and the job fails rather than returning other ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.tables import frugal

#: Words of a block at most, but for a single document that has more.
BLOCK_WORDS = 3_000_000
#: Encoded words that a task holds before it sends them back to their blocks.
RETURN_WORDS = 200_000


def read_ranks(path: str) -> bytes:
    """The vocabulary file, base64 token and rank per line; read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(vocabulary: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines()) if token}


def spark_pattern(pattern: str) -> str:
    """The pattern for Java's engine, where white space has to be asked for as a Unicode property."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge neighbours, lowest rank and then leftmost first, until no pair is in the vocabulary."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, pa.DictionaryArray, int]]:
    """(ids, words of each document, numbered words, name) of each block of a task's batches of (doc_id, words)."""
    task = TaskContext.get()
    for number, batch in enumerate(batches):
        lengths = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            many = int(np.searchsorted(np.cumsum(lengths[at:]), BLOCK_WORDS, side="right"))
            part = batch.slice(at, max(1, many))
            words = pc.dictionary_encode(part.column(1).flatten())
            named = xxhash.xxh64(str((task.partitionId() if task else 0, number, at, len(words.dictionary))))
            named.update(pc.fill_null(part.column(0), -1).to_numpy(zero_copy_only=False).tobytes())
            for word in words.dictionary.buffers()[1:]:
                if word is not None:
                    named.update(word)
            yield part.column(0), lengths[at : at + part.num_rows], words, named.intdigest() - (1 << 63)
            at += part.num_rows


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for _, _, words, name in _blocks(batches):
        n = len(words.dictionary)
        for i in range(0, n, 65_536):
            some = words.dictionary.slice(i, 65_536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), name)), pa.array(np.arange(i, i + len(some), dtype=np.int32)), some],
                names=["block", "number", "word"],
            )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for ids, lengths, words, name in _blocks(batches):
        packed = _squeeze(words.indices.to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())),
             pa.array([lengths], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
            names=["block", "doc_ids", "lengths", "packed"],
        )


def _squeeze(numbers: np.ndarray) -> bytes:
    """32-bit numbers with the bytes of one weight together, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(packed: bytes, count: int) -> np.ndarray:
    planes = pa.decompress(packed, decompressed_size=4 * count, codec="zstd", asbytes=True) if count else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: bytes) -> Iterator[pa.RecordBatch]:
    """Of words in sorted order: per block, the words' numbers, counts of ids and ids."""
    frugal()
    ranks, last = parse_ranks(vocabulary), (None, [])
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def send() -> pa.RecordBatch:
        blocks, numbers, sizes = (np.concatenate([h[i] for h in held]) for i in range(3))
        flat = np.concatenate([h[3] for h in held])
        starts = np.cumsum(sizes) - sizes
        held.clear()
        order = np.lexsort((numbers, blocks))
        blocks, numbers, sizes, starts = blocks[order], numbers[order], sizes[order], starts[order]
        cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])).tolist()
        rows = []
        for i, j in zip(cuts, [*cuts[1:], len(blocks)], strict=True):
            many = sizes[i:j]
            reach = np.cumsum(many)
            ids = flat[np.repeat(starts[i:j] - (reach - many), many) + np.arange(int(reach[-1]))]
            rows.append((blocks[i], j - i, len(ids), _squeeze(np.diff(numbers[i:j], prepend=0)), _squeeze(many), _squeeze(ids)))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
            names=["block", "n_words", "n_ids", "numbers", "sizes", "ids"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        words = pc.dictionary_encode(batch.column(2))
        known = []
        for word in words.dictionary.to_pylist():  # sorted rows: only the first can be known from the batch before
            if word != last[0]:
                last = (word, encode_word(word.encode(), ranks))
            known.append(last[1])
        each = np.fromiter(map(len, known), np.int64, len(known))
        flat = np.array([i for ids in known for i in ids], np.int64)
        use = words.indices.to_numpy()
        sizes = each[use]
        reach = np.cumsum(sizes)
        ids = flat[np.repeat((np.cumsum(each) - each)[use] - (reach - sizes), sizes) + np.arange(int(reach[-1]))]
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), sizes, ids))
        if sum(len(h[0]) for h in held) >= RETURN_WORDS:
            yield send()
    if held:
        yield send()


def _assemble(documents: pa.Table, words: pa.Table) -> pa.Table:
    frugal()
    if documents.num_rows > 1:
        raise RuntimeError("two blocks have one name")
    parts = [
        (np.cumsum(_unsqueeze(r["numbers"], r["n_words"]).astype(np.int64)), _unsqueeze(r["sizes"], r["n_words"]).astype(np.int64), _unsqueeze(r["ids"], r["n_ids"]))
        for r in words.to_pylist()
    ]
    numbers, many_of, flat = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(3))
    flat = flat.astype("<i4")
    total_words = int(numbers.max()) + 1 if len(numbers) else 0
    sizes, starts = np.zeros(total_words, np.int64), np.zeros(total_words, np.int64)
    sizes[numbers], starts[numbers] = many_of, np.cumsum(many_of) - many_of
    out_ids, out_tokens = [], []
    for doc_ids, lengths, packed in zip(documents["doc_ids"], documents["lengths"], documents["packed"], strict=True):
        lengths = lengths.values.to_numpy()
        total = int(lengths.sum())
        mine = _unsqueeze(packed.as_py(), total)
        if total and (int(mine.max()) >= total_words or not sizes[mine].all()):
            raise RuntimeError("a block's words are missing: the documents were dealt out differently in two scans")
        out_ids += doc_ids.as_py()
        at = 0
        for n in lengths.tolist():
            use = mine[at : at + n]
            at += n
            many = sizes[use]
            reach = np.cumsum(many)
            total_ids = int(reach[-1]) if n else 0
            out_tokens.append(flat[np.repeat(starts[use] - (reach - many), many) + np.arange(total_ids)])
    offsets = np.cumsum([0, *map(len, out_tokens)], dtype=np.int64)
    if offsets[-1] >= 1 << 31:
        raise RuntimeError("a block has more than 2^31 ids; lower BLOCK_WORDS")
    values = np.concatenate(out_tokens) if out_tokens else np.empty(0, "<i4")
    return pa.Table.from_arrays(
        [pa.array(out_ids, pa.int64()), pa.ListArray.from_arrays(offsets.astype(np.int32), values)], names=["doc_id", "ids"]
    )


def encode(docs: DataFrame, vocabulary: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of docs (doc_id, text, further columns are ignored).

    Each match of the pattern is encoded by itself, without special tokens. A null or empty text has no ids. Rows
    with a null or repeated doc_id each get their own result; an empty table gives an empty one.
    """
    split = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(spark_pattern(pattern)), F.lit(0)).alias("words"),
    )
    encoded = (
        split.mapInArrow(_words, "block bigint, number int, word string")
        .repartition("word").sortWithinPartitions("word")
        .mapInArrow(
            partial(_encode, vocabulary=vocabulary), "block bigint, n_words int, n_ids int, numbers binary, sizes binary, ids binary"
        )
    )
    documents = split.mapInArrow(_documents, "block bigint, doc_ids array<bigint>, lengths array<bigint>, packed binary")
    return (
        documents.groupBy("block").cogroup(encoded.groupBy("block"))
        .applyInArrow(_assemble, "doc_id bigint, ids array<int>")
        .where("ids is not null")
    )


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: bytes) -> Iterator[pa.RecordBatch]:
    frugal()
    ranks = parse_ranks(vocabulary)
    table = [b""] * (1 + max(ranks.values(), default=-1))
    for token, rank in ranks.items():
        table[rank] = token
    data = np.frombuffer(b"".join(table), np.uint8)
    sizes = np.fromiter(map(len, table), np.int64, len(table))
    starts = np.cumsum(sizes) - sizes
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = part.column(1).flatten().to_numpy(zero_copy_only=False)
            many = sizes[ids]
            reach = np.cumsum(many)
            total = int(reach[-1]) if len(ids) else 0
            text = data[np.repeat(starts[ids] - (reach - many), many) + np.arange(total)]
            ends = np.cumsum(part.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            stops = np.concatenate([[0], np.append(0, reach)[ends]]).astype(np.int64)
            texts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), part.num_rows, [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(text))]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], names=["doc_id", "ids", "decoded"])


def decode(encoded: DataFrame, vocabulary: bytes) -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes of every id list; an empty list gives no bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decode, vocabulary=vocabulary), "doc_id bigint, ids array<int>, decoded binary"
    )
