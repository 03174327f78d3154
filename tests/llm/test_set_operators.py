"""Exact dedup, joins, mixing and toxicity against plain versions, and their odd inputs."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import exact, graph, grid_join, mixing, parity_join, registry, toxicity

DOCS = "doc_id long, text string, source string, digest string, key string, part string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", "d", "k", "p") for i, t in rows], DOCS)


def parts(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(None, 1), (7, 7)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = parts({n for pair in real for n in pair}, real)
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("support", [1 / 1024, 0.2])
def test_exact(spark, support):
    texts = [None, "", " \t", "a b", "ab", "a\n b ", "é x", "éx", "z" * 4000, " ", "ab"] + ["hot"] * 20
    df = docs(spark, [*enumerate(texts), (None, "c"), (3, "a b")])
    rows = exact.exact_groups(df, support).collect()
    assert len(rows) == len(texts) + 2
    groups = defaultdict(list)
    for i, t in [*enumerate(texts), (None, "c"), (3, "a b")]:
        t = t or ""
        groups[t.translate({ord(c): None for c in exact.WHITE_SPACE})].append((-len(t), i))
    want = Counter()
    for body, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1] is not None, m[1] or 0))[1]
        for _, i in members:
            want[i, keep, len(members), i == keep, hashlib.sha256(body.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows) == want
    kept = exact.drop_copies(df, support)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in rows)
    assert exact.exact_groups(df.limit(0), support).count() == 0


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_texts(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    out = [None, "", " ", "one", "One", "two words", "a b c", "A\tb  c", "x y z v"]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([5, 12, 40, 130, 127, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(copy) // 60)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy[: len(copy) - rng.randrange(3)]))
    out += [" ".join([word() for _ in range(20)] + passage + [word() for _ in range(rng.randrange(60))]) for _ in range(20)]
    return out


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (1, 50)])
def test_parity_join(spark, k, num):
    texts = near_texts(k)
    df = docs(spark, [*enumerate(texts), (None, "a b c")])
    sets = [shingles(t, k) for t in texts]
    links = [
        (i, j) for i in range(len(texts)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    want = parts(range(len(texts)), links)
    rows = parity_join.near_duplicates(df, k, num, 100).collect()
    assert len(rows) == len(texts) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == {i: (len(sets[i]), want[i]) for i in want}
    kept = parity_join.drop_near_duplicates(df, k, num, 100)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert parity_join.near_duplicates(df.limit(0), k, num, 100).count() == 0


def test_open_group_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "GROUP_BLOCK", 4)
    test_parity_join(spark, 3, 90)


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        apart = int(np.bitwise_count((parity_join.bit_sketch(a) ^ parity_join.bit_sketch(b)).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_grid_join(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=16) for _ in range(80)]
    vectors += [v + rng.normal(size=16) * 0.12 for v in vectors[:40] for _ in range(3)] + [vectors[0], vectors[0] * 3, -vectors[1]]
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 0.0], [2.0, 0.0], [1e300] * 3, [1e-300] * 3, [-0.0, 1.0], [0.0, 1.0]]
    rows = [list(map(float, v)) for v in vectors] + odd
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows)] + [(None, [1.0, 0.0], "x")], "vec_id long, embedding array<double>, unit string")
    links = []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if not a or not b or len(a) != len(b) or None in a or None in b or not np.isfinite(a + b).all() or not any(a) or not any(b):
                continue
            a1, b1 = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
            if a1 @ b1 / np.sqrt((a1 @ a1) * (b1 @ b1)) >= 0.95:
                links.append((j, i))
    many, part = Counter(n for pair in links for n in pair), parts(range(len(rows)), links)
    got = grid_join.cosine_links(df).collect()
    assert len(got) == len(rows) + 1
    assert {r.vec_id: tuple(r)[1:] for r in got if r.vec_id is not None} == {i: (many[i], part[i], part[i] == i) for i in part}
    assert grid_join.cosine_links(df.limit(0)).count() == 0


def test_cycle_keeps_within_a_block():
    for weights in ({"a": 5, "b": 3, "c": 1}, {"a": 1}, {"a": 333, "b": 333, "c": 334}, {f"s{i}": i + 1 for i in range(30)}):
        slots, q = mixing.cycle_slots(weights), sum(weights.values())
        done = Counter()
        assert Counter(slots) == Counter(weights)
        for t, s in enumerate(slots, 1):
            done[s] += 1
            assert all(abs(done[x] - Fraction(w * t, q)) < 1 for x, w in weights.items())


def test_mixing(spark):
    rows = [(i, f"t{i}", s) for i, s in enumerate(["a"] * 300 + ["b"] * 90 + [None] * 30 + ["c"])] + [(None, None, "b"), (5, "t5", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_slot", F.lit("clash"))
    weights = {"a": 4, "b": 3, "": 2, "c": 1}
    got = mixing.pfair_mix(df, weights, block_rows=4).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    slots = defaultdict(set)
    for r in got:
        slots[r._slot].add((r._source, r._block))
    assert sorted(slots) == list(range(len(slots))) and all(len(s) == 1 for s in slots.values())
    order = [next(iter(slots[i])) for i in range(len(slots))]
    left, active = Counter(s for s, _ in order), None
    for s, _ in order:
        if active != (active := frozenset(x for x in left if left[x])):
            done, t, q = Counter(), 0, sum(weights[x] for x in active)
        done[s] += 1
        left[s] -= 1
        t += 1
        assert all(abs(done[x] - Fraction(weights[x] * t, q)) < 1 for x in active)
    assert len({(r._slot, r._place) for r in got}) == len(rows)
    laid = mixing.in_mixed_order(df.drop("_slot"), block_rows=4)
    assert laid.columns == ["doc_id", "text", "source"] and laid.count() == len(rows)
    assert mixing.pfair_mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.pfair_mix(df, {"a": 1})


def test_toxicity(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(300)}x" for _ in range(rng.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["Nasty", "vile", "awful!"]))
        rows.append((i, " ".join(words), "x"))
        if i < 400:
            labels.append((i, i % 7 == 0, toxic))
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "123 ...", "x"), (None, "a nasty one", "x"), (0, "again", "x"), (1003, "w1x " * 20000 + "vile", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _p string")
    truth = spark.createDataFrame([*labels, (None, True, True), (9999, None, True)], "doc_id long, low_quality boolean, toxic boolean")
    got = toxicity.score(df, truth, registry.CATEGORIES).collect()
    assert len(got) == len(rows)
    flagged = {r.doc_id for r in got if r.toxic}
    assert {i for i in range(400, 600) if i % 5 == 0} <= flagged and 1003 in flagged and None in flagged
    assert not flagged & ({i for i in range(400, 600) if i % 5} | {1000, 1001, 1002})
    kept = toxicity.drop_toxic(df, truth, registry.CATEGORIES)
    assert kept.count() == sum(not r.toxic for r in got) and kept.columns == ["doc_id", "text"]
    assert toxicity.score(df.limit(0), truth, registry.CATEGORIES).count() == 0
    assert not any(r.toxic for r in toxicity.score(df, truth.limit(0), registry.CATEGORIES).collect())


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (300, 3)).astype(float)
    first = x[:, 0] > 0
    models = toxicity.fit_chain(x, np.stack([first, ~first], 1), rng.integers(0, 3, 300))
    assert [len(m) for m in models] == [4, 5] and models[1][3] < 0
