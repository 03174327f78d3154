"""Periodic runs against a plain search, and the query against plain code over the same tables."""

import hashlib
import random
import zlib

import pytest

from ledgerspark.llm import periods, registry

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, runs string, words string, collapsed string"  # the last three clash with names inside


def plain_runs(words):
    found = {}
    for period in range(1, len(words) // 4 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j + period - i >= max(6, 4 * period):
                found.setdefault((i, j + period - i), period)
            i = j + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    size = rng.choice([0, 1, 5, 6, 7, 30, 100, 300])
    words = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(size)]
    for _ in range(rng.randrange(4) if size else 0):
        first, period = rng.randrange(size), rng.randrange(1, 40)
        for i in range(first, rng.randrange(first, size)):
            words[i] = words[first + (i - first) % period]
    return words


@pytest.mark.parametrize("chunk", [periods.CHUNK_WORDS, 50])
def test_runs_of_random_words(spark, monkeypatch, chunk):
    monkeypatch.setattr(periods, "CHUNK_WORDS", chunk)
    rng = random.Random(chunk)
    texts = [" ".join(random_words(rng)) for _ in range(150)]
    odd = [None, "", " \t\n", "a " * 6, "a " * 5, "a b c d " * 4, "   " * 7, "é É " * 9, "x\ty\n" * 4]
    texts += odd + ["a b a a b " * 8000 + "end " + "z " * 50000]
    rows = [(i, t, "r", "w", "c") for i, t in enumerate(texts)] + [(None, "q q q q q q q", None, None, None), (3, texts[3], "", "", "")]
    got = periods.periodic_runs(spark.createDataFrame(rows, DOCS)).collect()
    want = []
    for i, text, *_ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = plain_runs(words) if len(words) < 1000 else [(0, 40000, 5), (40001, 50000, 1)]
        want.append((i, len(words), runs, collapsed(words, runs)))
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_no_documents(spark):
    assert periods.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


def test_query(spark):
    rows = registry.QUERIES["op13_word_periods"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text or "" for r in registry.read(spark, FOLDER, "documents").collect()}
    assert len(rows) == len(texts)
    planted = 0
    for r in rows:
        words = [w.decode() for w in texts[r.doc_id].encode().split()]
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words) if n < 3000 else None
        if runs is None:
            continue
        assert r.n_runs == len(runs)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
    assert planted > 5
