"""The suffix order against a plain sort, and removal of repeated bytes against plain search."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerspark.llm import registry, suffix_dedup, suffix_sort

FOLDER = "/root/testdata/sf0.001"


def shared(x, y):
    n = 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    return n


@pytest.mark.parametrize("memory", [64 << 20, 40])
def test_suffixes_in_order(monkeypatch, memory):
    """The small memory moves every run of the queues to disk."""
    monkeypatch.setattr(suffix_sort, "QUEUE_BYTES", memory)
    rng = random.Random(memory)
    for _ in range(200):
        letters = rng.choice([1, 2, 3, 20, 256])
        strings = [bytes(rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 10, 60]))) for _ in range(rng.choice([1, 2, 5]))]
        strings += rng.choice([[], [strings[0], strings[0][1:] + b"x"]])
        cap = rng.choice([4, 20, 200])
        begin = np.cumsum([0, *(len(s) + 1 for s in strings)])
        found = []
        for positions, common in suffix_sort.SuffixSorter(strings, cap).scan():
            assert common[0] == 0
            for p, c in zip(positions.tolist(), common.tolist(), strict=True):
                i = int(np.searchsorted(begin, p, side="right")) - 1
                found.append((strings[i][p - begin[i] :], i, c))
        assert [(s, i) for s, i, _ in found] == sorted(
            ((s[j:], i) for i, s in enumerate(strings) for j in range(len(s))), key=lambda x: ([b + 1 for b in x[0]] + [0], x[1]), reverse=True
        )
        for (x, *_), (y, _, c) in zip(found, found[1:]):
            assert c == min(shared(x, y), cap)


def test_queue_leaves_no_file(monkeypatch, tmp_path):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    with suffix_sort.SymbolQueue(memory=10) as queue:
        for k in range(5):
            queue.push(7, np.array([k, k + 10]), np.array([0, k]))
        queue.push(8, np.array([1]), np.array([2]))
        positions, common = queue.pop(7)
        assert positions.tolist() == [0, 10, 1, 11, 2, 12, 3, 13, 4, 14] and common.tolist() == [0, 0, 0, 1, 0, 2, 0, 3, 0, 4]
        assert queue.pop(7)[0].tolist() == [] and queue.pop(8)[0].tolist() == [1]
    assert list(tmp_path.iterdir()) == []


def plain_removal(texts, length):
    starts = defaultdict(list)
    for i, text in enumerate(texts):
        for j in range(len(text) - length + 1):
            starts[text[j : j + length]].append((i, j))
    covered = [np.zeros(len(t), bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for i, j in places:
                covered[i][j : j + length] = True
    result = []
    for text, gone in zip(texts, covered, strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))).tolist()
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        result.append((len(text), list(zip(edges[::2], edges[1::2], strict=True)), kept))
    return result


@pytest.mark.parametrize("most", [suffix_dedup.MOST_CONTEXTS, 8])
def test_removal(spark, monkeypatch, most):
    """A phrase shorter than the length stands in half of the texts; the small bound makes its anchors longer."""
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", most)
    monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", 3000)
    rng = random.Random(most)

    def some(n, letters):
        return "".join(rng.choice("abcdé fghijklmnop"[:letters]) for _ in range(n))

    phrase, long = some(15, 17), some(60, 17)
    texts = [None, "", some(5, 3), "a" * 500, "ab" * 100, some(19, 4), long[:20], long[:21], "x" + long[:20], some(9000, 17) + long]
    for _ in range(120):
        text = some(rng.choice([0, 10, 40, 200]), 17) + (phrase if rng.random() < 0.5 else "")
        text += long[rng.randrange(10) : rng.randrange(30, 60)] if rng.random() < 0.3 else ""
        texts.append(text + some(rng.choice([0, 10, 40, 200]), rng.choice([2, 17])))
    texts += [texts[20]] * 6 + ["Z" + texts[21]]
    rows = [(i, t, "a", "c", 1) for i, t in enumerate(texts)] + [(None, texts[25], "", "", 0), (30, texts[30], "", "", 0), (31, "other " + texts[40], "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, anchor string, context string, low int")
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs, 20).collect()]
    want = [(row[0], *result) for row, result in zip(rows, plain_removal([(r[1] or "").encode() for r in rows], 20), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_levels_are_joined_once_each(spark, monkeypatch):
    """A phrase one byte shorter than the length makes anchors longer up to full length; marks and each level stand in the plan once."""
    monkeypatch.setattr(suffix_dedup, "MOST_CONTEXTS", 4)
    rng = random.Random(3)
    phrase = "one phrase for all."
    texts = ["".join(rng.choices("abcdefgh", k=30)) + phrase + "".join(rng.choices("abcdefgh", k=30)) for _ in range(60)] + ["x" + phrase + "y"] * 2
    labels, plans = [], []
    stage, repeated = suffix_dedup.stage, suffix_dedup._repeated_in_contexts

    def noted_stage(df, label, **options):
        labels.append(label)
        return stage(df, label, **options)

    def noted_marks(contexts, length):
        marks = repeated(contexts, length)
        plans.append(marks._jdf.queryExecution().optimizedPlan().toString())
        return marks

    monkeypatch.setattr(suffix_dedup, "stage", noted_stage)
    monkeypatch.setattr(suffix_dedup, "_repeated_in_contexts", noted_marks)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs, len(phrase) + 1).sort("doc_id").collect()]
    assert got == plain_removal([t.encode() for t in texts], len(phrase) + 1)
    levels = labels.count("anchor-parts")
    assert levels >= 3
    assert (plans[0].count("Join Inner"), plans[0].count("Relation [")) == (levels, 2 * levels + 1)


def test_no_documents(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    docs = registry.read(spark, FOLDER, "documents").collect()
    want = plain_removal([(r.text or "").encode() for r in docs], 200)
    rows = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op11_suffix_dedup"](spark, FOLDER).collect()}
    assert rows == {
        d.doc_id: (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for d, (n, spans, kept) in zip(docs, want, strict=True)
    }
    assert sum(r[1] > 0 for r in rows.values()) > 10
