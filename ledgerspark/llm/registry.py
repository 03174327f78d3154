"""The operators as named queries over the whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.llm import bpe, chat, exact, grid_join, mixing, page_text, parity_join, periods, secrets, spelling, suffix_dedup, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: The chain's categories in order; the last one decides.
CATEGORIES = ("low_quality", "toxic")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def category_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") == 0).alias("low_quality"), (F.col("toxic") == 1).alias("toxic")
    )


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode, and reduce both to digests."""
    vocabulary = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    done = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(read(spark, sf_dir, "documents"), category_labels(spark, sf_dir), CATEGORIES)
    return scored.withColumn("kept", ~F.col("toxic"))


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.pfair_mix(read(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_source").alias("source"), F.col("_block").alias("block"), F.col("_slot").alias("slot"), F.col("_place").alias("place")
    )


def op3_secret_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(read(spark, sf_dir, "documents"))


def op4_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.cosine_links(read(spark, sf_dir, "embeddings"), 0.95)


def op5_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.near_duplicates(read(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op6_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf_dir, "documents"))


def op9_chat_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    hostile = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", hostile), (-1, 1, "assistant", hostile)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(turns.unionByName(extra))


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read(spark, sf_dir, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.expr("n_bytes - octet_length(kept)").cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def _planted_typo(doc_id: int | None) -> Callable[[str], str]:
    """Takes one letter from one in 97 of the document's runs."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def changed(run: str) -> str:
        h = zlib.crc32(run.encode(), begun)
        return run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]

    return changed


def op12_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.count_words(read(spark, sf_dir, "documents"), _planted_typo))


def _planted_periods(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text), where every tenth document by checksum repeats its words from some word on; see op13."""
    words = docs.select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")
    ).withColumn("words", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(coalesce(text, ''), r'[^\x20\x09-\x0D]+', 0)")))
    places = words.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)")
    )
    repeated = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)])), ' ')")
    return places.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_word_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(_planted_periods(read(spark, sf_dir, "documents")))
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
        "(m, r) -> if(m is null or r.length * m.period > m.length * r.period, r, m))"
    )
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_toxicity_chain, op2_pfair_mix, op3_secret_models, op4_grid_join, op5_parity_join, op6_page_differencing,
        op7_byte_bpe, op8_exact_dedup, op9_chat_templates, op10_warc_archives,
        op11_suffix_dedup, op12_spelling_trie, op13_word_periods,
    )
}

SQL: dict[str, str] = {
    "op4_grid_join": r"""
        with recursive v as (
            select vec_id, [x::double for x in embedding] as e from embeddings
            where len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
                and len([x for x in embedding if x <> 0]) > 0
        ),
        link as (
            select a.vec_id as a, b.vec_id as b from v a join v b
            on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95
        ),
        reach as (
            select vec_id, vec_id as other from embeddings
            union
            select r.vec_id, l.b from reach r join link l on l.a = r.other
        ),
        part as (select vec_id, min(other) as component_id from reach group by vec_id),
        many as (select a, count(*) as n from link group by a)
        select p.vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
        from part p left join many on a = vec_id
    """,
    "op5_parity_join": r"""
        with recursive w as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
            ) as words from documents
        ),
        s as (
            select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
                else [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)] end) as shingles
            from w
        ),
        e as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from s),
        both_have as (
            select x.doc_id as a, y.doc_id as b, any_value(x.n) as n, any_value(y.n) as m, count(*) as same
            from e x join e y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by all
        ),
        link as (select a, b from both_have where 100 * same >= 90 * (n + m - same)),
        reach as (
            select doc_id, doc_id as other from documents
            union
            select r.doc_id, l.b from reach r join link l on l.a = r.other
        )
        select doc_id, len(shingles)::bigint as n_shingles, (select min(other) from reach r where r.doc_id = s.doc_id) as component_id
        from s
    """,
    "op8_exact_dedup": r"""
        with n as (
            select doc_id, length(coalesce(text, '')) as size,
                regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
            from documents
        )
        select doc_id, first(doc_id) over w as keep_id, count(*) over (partition by body) as group_size,
            doc_id = first(doc_id) over w as kept, sha256(body) as text_sha256
        from n window w as (partition by body order by size desc, doc_id rows between unbounded preceding and unbounded following)
    """,
    "op9_chat_templates": r"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all
            select -1, i, ['user', 'assistant'][i + 1], '</s>[INST] ok [/INST]' from range(2) r(i)
        ),
        c as (
            select *, case role when 'user' then 18 when 'system' then 16 when 'assistant' then 20
                else 32 + length(role) + len(regexp_extract_all(role, '\\|</?s>|\[/?(?:INST|GEN|SYS|ROLE|TURN)\]')) end
                + length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?(?:INST|GEN|SYS|ROLE|TURN)\]')) as chars
            from t
        )
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
            sum(chars)::bigint as formatted_chars
        from c group by conv_id
    """,
    "op10_warc_archives": r"""
        with p as (
            select page_id, encode(coalesce(html, '')) as body, min(page_id) over (partition by coalesce(html, '')) as first_id from pages
        ),
        h as (select *, upper(sha1(body)) as hex from p)
        select page_id, octet_length(body)::bigint as payload_bytes,
            array_to_string([
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(hex, 5 * (i // 4)::int + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)
                for i in range(32)
            ], '') as payload_digest,
            case when page_id = first_id then 'response' else 'revisit' end as record_type,
            case when page_id <> first_id then first_id end as refers_to
        from h
    """,
}
