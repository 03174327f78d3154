"""Spelling variants against plain code, over random words and over the tables."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from ledgerspark.llm import registry, spelling

FOLDER = "/root/testdata/sf0.001"


def near_of(words):
    """{word: words that differ by one inserted, deleted or replaced code point}."""
    near = {w: set() for w in words}
    holes, shorter = {}, {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), []).append(w)
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for group in holes.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    for w in words:
        for v in shorter.get(w, ()):
            near[w].add(v)
            near[v].add(w)
    return near


def variants(counts):
    near = near_of(list(counts))
    rows = {}
    for w, n in counts.items():
        form = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if form is not None and counts[form] < 2 * n:
            form = None
        rows[w] = [form, None, n, len(near[w]), counts[form] if form else None]
    for w in rows:
        root = w
        while rows[root][0]:
            root = rows[root][0]
        rows[w][1] = root
    return {(w, *row) for w, row in rows.items()}


def random_counts(rng, letters):
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(0, 9))) for _ in range(150)}
    for w in list(words):
        for _ in range(2):
            i = rng.randrange(len(w) + 1)
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    long = "x" * 30 + "y" * 3000
    words |= {long, long[:-1], "z" + long, long + "z", "x" * 30, "x" * 31, "q" * 5000}
    return {w: rng.choice([1, 2, 3, 4, 5, 8, 9, 16, 30, 80, 200]) for w in words}


@pytest.mark.parametrize("letters", ["abcé", "abcdefghijkÿ"])
def test_variants_of_random_words(spark, letters):
    counts = random_counts(random.Random(len(letters)), letters)
    rows = [(w, n, "n", "near", "o") for w, n in counts.items()] + [(None, 5, "", "", "")]
    words = spark.createDataFrame(rows, "word string, n long, node string, near string, own string")
    pairs = spelling.near_words(words.where("word is not null")).collect()
    want = near_of(list(counts))
    assert sorted((r.word, r.near) for r in pairs) == sorted((w, v) for w, others in want.items() for v in others)
    got = spelling.spelling_variants(words).collect()
    assert len(got) == len(counts) and {tuple(r) for r in got} == variants(counts)


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    one = spelling.spelling_variants(spark.createDataFrame([("alone", 3)], "word string, n long")).collect()
    assert [tuple(r) for r in one] == [("alone", None, "alone", 3, 0, None)]


def plain_query(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return variants({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})


def test_query(spark):
    docs = registry.read(spark, FOLDER, "documents").collect()
    got = registry.QUERIES["op12_spelling_trie"](spark, FOLDER).collect()
    assert {tuple(r) for r in got} == plain_query([(r.doc_id, r.text) for r in docs])
    assert sum(r.form is not None for r in got) > 20


def test_odd_documents(spark, tmp_path):
    rng = random.Random(5)
    words = ["sample", "samples", "Sample", "ÉTÉS-noir", "été×÷ÿ", "trailing", "trailin"]
    texts = [None, "", "12 34", "word " * 20000, *(" ".join(rng.choices(words, k=400)) for _ in range(30))]
    rows = [(i % 9 if i % 5 else None, t, "r", "w") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, run string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op12_spelling_trie"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == plain_query([r[:2] for r in rows]) and len(got) > 5


def test_near_words_of_a_dense_table(spark):
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(0, 9))) for _ in range(2500)}
    got = spelling.near_words(spark.createDataFrame([(w,) for w in sorted(words)], "word string")).collect()
    assert sorted((r.word, r.near) for r in got) == sorted((w, v) for w, others in near_of(list(words)).items() for v in others)


def test_counts_come_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    table = pa.table({"k": [1, None, 2], "t": ["Apple apple", "pears apple", "plums pears ÉTÉS été"]})
    sent = list(spelling._counts(iter(table.to_batches(max_chunksize=1)), spelling.unchanged, 5))
    total = Counter()
    for batch in sent:
        total.update(dict(zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True)))
    assert len(sent) == 2 and total == {"apple": 3, "pears": 2, "plums": 1}
