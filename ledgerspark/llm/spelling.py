"""Spelling variants: words one edit apart, found by walking a trie whose edges are a distributed table.

A state (word, position, node, edits) says that the first position letters of word lead to node with so many edits; a
node is the prefix that it stands for. Level by level the states are joined with the edges that leave their nodes.
States without an edit follow their own letter, and branch to every other one as replacement, insertion or deletion:
two words that differ by one edit differ by it at their first mismatch, so every pair is met once from either side.
States with an edit follow their own letters only; they are kept in a table of their own. Edges are built level by level
from the states without an edit. An edge carries all letters up to the next node where words part (or end), or up to
the end of the only word below it, so the number of levels is the number of such nodes on a path, however long the
words are. An edge also carries three 64-bit filters of what follows its child: the first letter, the first three and
all letters of the words below. They never miss one; a state with an edit that can't reach the end is mostly not made.

The mismatch of two such words lies in the second half of the word, counted from its beginning or from its end. So two
tries are walked, of the words and of the reversed words, and states branch in the second half only, where few edges
leave a node. Edges of the first two levels (at most one per pair of letters) are broadcast, all others are shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.tables import scratch, stage

#: Levels whose edges are broadcast: there are no more of them than letters and pairs of letters.
BROADCAST_LEVELS = 2
LETTERS = "[A-Za-zÀ-ÿ]"
#: Words, and letters of words, that a task counts before it sends the counts on.
HELD_WORDS, HELD_LETTERS = 1 << 18, 1 << 24


def _counts(
    batches: Iterator[pa.RecordBatch], change: Callable[[object], Callable[[str], str]], least_letters: int
) -> Iterator[pa.RecordBatch]:
    """(word, n) of (key, text); a word comes again in a later batch when it occurs again."""
    runs = re.compile(f"{LETTERS}{{{least_letters},}}")
    counts: Counter[str] = Counter()
    letters = 0

    def send() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            lowered = text.as_py().encode().lower().decode()  # bytes have A-Z as their only upper case
            changed = change(key.as_py())
            for run, n in Counter(map(re.Match.group, runs.finditer(lowered))).items():
                word = changed(run)
                if len(word) >= least_letters:
                    letters += 0 if word in counts else len(word)
                    counts[word] += n
            if len(counts) >= HELD_WORDS or letters >= HELD_LETTERS:
                yield send()
                counts.clear()
                letters = 0
    if counts:
        yield send()


def unchanged(key: object) -> Callable[[str], str]:
    return str


def count_words(
    docs: DataFrame, change: Callable[[object], Callable[[str], str]] = unchanged, least_letters: int = 5, least_count: int = 3,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(word, n) of the maximal runs of Latin letters of all texts that have enough letters and occurrences.

    Only A-Z are lower-cased. change(key) is a function that may replace a run, but not by a longer one; it is called once
    for all occurrences of a run in a document. A null text has no runs, a null key is passed as None. Runs are counted where
    they are read, and again after the shuffle, so a frequent word is one row per task.
    """
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key), F.col(text))
    found = texts.mapInArrow(partial(_counts, change=change, least_letters=least_letters), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


#: How many first letters low and high share, found bit by bit; low and high bound a group of sorted words.
_SHARED = (
    "aggregate(sequence(30, 0, -1), 0, (k, b) -> if(k + shiftleft(1, b) <= char_length(low) "
    "and left(low, k + shiftleft(1, b)) = left(high, k + shiftleft(1, b)), k + shiftleft(1, b), k))"
)


#: Letters that the filters of a node look at, from the node on; the last one looks at all of them.
_AHEAD = ("1", "3", "char_length(word)")


def _bit(position: str, letters: str) -> str:
    return f"shiftleft(1L, int(pmod(xxhash64(substr(word, {position} + 1, {letters})), 64)))"


def _may(position: str) -> str:
    """Whether a word below child may go on as word does from position; never false where one does."""
    return " and ".join(f"(ahead{i} & {_bit(position, letters)}) <> 0" for i, letters in enumerate(_AHEAD))


def _state(position: str, near: str, when: str) -> str:
    return f"if({when}, named_struct('word', word, 'position', int({position}), 'node', child, 'near', {near}), null)"


def _inside(position: str, when: str) -> str:
    return _state(position, "cast(null as string)", f"not leaf and {when} and {_may(f'({position})')}")


#: Branches of a state without an edit along an edge that starts with another letter than its own.
_BRANCHES = ", ".join([
    _state("position", "child", "leaf and levenshtein(substr(word, position + 1), label, 1) = 1"),
    _inside("position + char_length(label)", "own <> '' and startswith(substr(word, position + 2), substr(label, 2))"),
    _inside("position + char_length(label) - 1", "startswith(substr(word, position + 1), substr(label, 2))"),
    _inside("position + char_length(label) + 1", "startswith(substr(word, position + 2), label)"),
])
#: The step of a state with an edit along the edge of its own letter.
_STEP = ", ".join([
    _state("position", "child", "leaf and substr(word, position + 1) = label"),
    _inside("position + char_length(label)", "startswith(substr(word, position + 1), label)"),
])


def _moved(joined: DataFrame, states: str) -> DataFrame:
    return joined.selectExpr(f"inline(filter(array({states}), s -> s is not null))")


def _walk(words: DataFrame) -> DataFrame | None:
    """(word, near): the pairs whose first mismatch lies in the second half of word, staged; None without words."""
    at_own = words.select("word", F.lit(0).alias("position"), F.lit("").alias("node"))
    edited = None
    found = []
    while True:
        at_own = at_own.withColumn("own", F.expr("substr(word, position + 1, 1)"))
        groups = at_own.groupBy("node", "own").agg(F.min("word").alias("low"), F.max("word").alias("high"))
        edges = stage(
            groups.selectExpr("node", "own as letter", f"left(low, {_SHARED}) as child", "low = high as leaf")
            .selectExpr("node", "letter", "child", "substr(child, char_length(node) + 1) as label", "leaf"),
            "trie-edges",
        )
        if edges.isEmpty():
            break
        small = F.broadcast if len(found) < BROADCAST_LEVELS else lambda df: df
        followed = stage(
            at_own.join(small(edges.where("not leaf").select("node", F.col("letter").alias("own"), "child")), ["node", "own"])
            .selectExpr("word", "char_length(child) as position", "child as node"),
            "trie-words",
        )
        filters = followed.groupBy(F.col("node").alias("child")).agg(
            *[F.expr(f"bit_or({_bit('position', letters)})").alias(f"ahead{i}") for i, letters in enumerate(_AHEAD)]
        )
        edges = edges.join(filters, "child", "left")
        branching = at_own.where("2 * char_length(node) >= char_length(word) - 1")
        states = _moved(branching.join(small(edges), "node").where("letter <> own"), _BRANCHES)
        if edited is not None:
            own_edges = small(edges.withColumnRenamed("letter", "own"))
            at_edge = edited.withColumn("own", F.expr("substr(word, position + 1, 1)"))
            states = states.unionByName(_moved(at_edge.join(own_edges, ["node", "own"]), _STEP))
        states = stage(states, "trie-states")
        found.append(states.where("near is not null").select("word", "near"))
        edited = states.where("near is null").drop("near")
        at_own = followed
    return reduce(DataFrame.unionByName, found) if found else None


def near_words(words: DataFrame) -> DataFrame:
    """(word, near) of all pairs of words that differ by exactly one inserted, deleted or replaced code point.

    words has distinct values in word, the empty word included or not, and no null; further columns are ignored. Every
    pair appears in both directions, once each. An empty table gives an empty result.
    """
    ahead = _walk(words)
    if ahead is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    back = _walk(words.select(F.reverse("word").alias("word"))).select(F.reverse("word").alias("word"), F.reverse("near").alias("near"))
    return ahead.unionByName(back).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms (word, form) followed to the last one. A chain ends, as every form is more frequent."""
    steps = forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNull().alias("last"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"), F.col("last").alias("done"))
        moved = steps.where("not last").join(ahead, "root").select("word", F.col("further").alias("root"), F.col("done").alias("last"))
        steps = stage(moved.unionByName(steps.where("last")), "roots")
        if steps.where("not last").isEmpty():
            return steps.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of words (word, n).

    form is the word one edit away that occurs most often (on a tie the smallest in code point order), if it occurs at
    least ratio times as often as the word, else null; form_n is its count. root is reached by following forms. n_near
    counts the words one edit away. Rows with a null word are left out. An empty table gives an empty result.
    """
    with scratch(words.sparkSession):
        words = stage(words.where("word is not null").select("word", "n"), "words")
        pairs = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        best = pairs.groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rarity"), "near")).alias("best")
        )
        often = -F.col("best.rarity") >= ratio * F.col("n")
        forms = stage(
            words.join(best, "word", "left").select(
                "word", F.when(often, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                F.when(often, -F.col("best.rarity")).alias("form_n"),
            ),
            "forms",
        )
        return stage(
            forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n"), "spelling-variants", keep=True
        )
