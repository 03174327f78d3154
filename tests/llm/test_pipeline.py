"""The queries against their SQL, and the pipeline's stages against plain versions."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from ledgerspark.llm import bpe, mixing, registry
from tests.llm.test_set_operators import parts, shingles

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.SQL))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        duck.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = registry.QUERIES[name](spark, FOLDER)
    result = duck.execute(registry.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(str([row[columns.index(c)] for c in sorted(columns)]) for row in result.fetchall())
    assert sorted(str([row[c] for c in sorted(columns)]) for row in df.collect()) == want


def test_stages(spark):
    docs = registry.read(spark, FOLDER, "documents")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    labels = {r.doc_id: r.toxic for r in registry.read(spark, FOLDER, "labels").collect()}
    clean = stage["toxicity"](spark, docs, FOLDER)
    kept = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and not any(labels.get(i) for i in kept)
    assert kept >= {i for i, toxic in labels.items() if not toxic}

    single = stage["exact dedup"](spark, docs, FOLDER)
    bodies = {}
    for r in docs.orderBy("doc_id").collect():
        body = "".join((r.text or "").translate(dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))))
        if body not in bodies or len(r.text) > bodies[body][0]:
            bodies[body] = (len(r.text or ""), r.doc_id)
    assert single.columns == columns and {r.doc_id for r in single.collect()} == {i for _, i in bodies.values()}

    near = stage["n-gram Jaccard join"](spark, docs, FOLDER)
    sets = {r.doc_id: shingles(r.text, 5) for r in docs.collect()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert near.columns == columns and {r.doc_id for r in near.collect()} == set(parts(sets, links).values())

    mixed = stage["mixing sources to target weights"](spark, docs, FOLDER)
    assert mixed.columns == columns and sorted(r.doc_id for r in mixed.collect()) == sorted(sets)


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    texts = {r.doc_id: r.text or "" for r in registry.read(spark, FOLDER, "documents").collect()}
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path(registry.VOCABULARY)))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert 0 < len(rows) < len(texts) and len({r.doc_id for r in rows}) == len(rows)
    for r in rows:
        ids = own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_mixture_orders_the_token_stream(spark, tmp_path):
    docs = spark.createDataFrame(
        [(i % 290, f"text number {i} " * (i % 7), "en", "abc"[i % 10 // 4], 0) for i in range(300)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    stage = dict(corpus_pipeline.STAGES)
    stage["mixing sources to target weights"](spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    rows = stage["byte-level BPE encoding and decoding"](spark, spark.read.parquet(f"{tmp_path}/mixed"), "").collect()
    want = mixing.pfair_mix(docs).orderBy("_slot", "_place").collect()
    assert [r.mix_position for r in rows] == list(range(300))
    assert [(r.doc_id, r.decoded_sha256) for r in rows] == [(w.doc_id, hashlib.sha256(w.text.encode()).hexdigest()) for w in want]
    assert [r.first_token for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(300)]

    docs.coalesce(1).sortWithinPartitions("doc_id").write.parquet(f"{tmp_path}/plain")
    plain = stage["byte-level BPE encoding and decoding"](spark, spark.read.parquet(f"{tmp_path}/plain"), "").collect()
    assert [r.doc_id for r in plain] == sorted(r.doc_id for r in rows) != [r.doc_id for r in rows]


def test_total_before_over_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH_ROWS", 8)
    rows = mixing.total_before(spark.range(50).selectExpr("id", "id * id as n"), "id", "n", "before").collect()
    assert {r.id: r.before for r in rows} == {i: sum(j * j for j in range(i)) for i in range(50)}
