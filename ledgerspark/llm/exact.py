"""Exact deduplication with a split for heavy hitters, in DataFrame operations only.

A Misra-Gries summary (DataFrame.freqItems) names the digests that may hold more than a share of all rows; there are
never more of them than one over that share. Their winners are computed with map-side aggregation, checked against
the true count and broadcast, so copies of a frequent text are settled where they are read. All other digests, none
of them frequent, are grouped by an ordinary shuffle of narrow rows. Texts themselves are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.staging import stage_table

#: Digests with more than this share of all rows count as frequent; at most 1 / SUPPORT of them are broadcast.
SUPPORT = 1 / 1024
WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _winner(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.min(F.struct((-F.col("length")).alias("shortness"), "doc_id")).alias("best"), F.count(F.lit(1)).alias("group_size")
    ).select("digest", F.col("best.doc_id").alias("keep_id"), "group_size")


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of docs (doc_id, text, further columns ignored).

    Texts are equal when they are after deleting ASCII white space; a null text counts as empty, and empty texts are
    equal to each other. The row with the longest original text stays, on a tie the one with the smallest doc_id, a
    null doc_id before all others. Rows that repeat a doc_id and its text all count in group_size and are kept or
    dropped together, as a doc_id names one document. An empty table gives an empty result.
    """
    rows = stage_table(
        docs.select(
            "doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
            F.length(F.coalesce("text", F.lit(""))).alias("length"),
        ),
        "exact-digests",
    )
    candidates = rows.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    total = rows.agg((F.count(F.lit(1)) * support).alias("least"))
    # written once: the summary depends on the order of its merges, and both branches below must see the same one
    frequent = stage_table(
        _winner(rows.join(F.broadcast(candidates), "digest", "left_semi"))
        .join(F.broadcast(total), F.col("group_size") > F.col("least")).drop("least"),
        "exact-frequent",
    )
    marked = rows.join(
        F.broadcast(frequent.select("digest", F.col("keep_id").alias("_keep"), F.col("group_size").alias("_size"))), "digest", "left"
    )
    settled = marked.where("_size is not null").select(
        "doc_id", "digest", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size")
    )
    others = marked.where("_size is null").select("doc_id", "digest", "length")
    shuffled = others.join(_winner(others), "digest").select("doc_id", "digest", "keep_id", "group_size")
    return settled.unionByName(shuffled).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns."""
    kept = exact_groups(docs, support).where("kept").select(
        F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest")
    ).distinct()
    digest = F.unhex(F.sha2(normalised(docs["text"]), 256))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (digest == kept["_digest"]), "left_semi")
