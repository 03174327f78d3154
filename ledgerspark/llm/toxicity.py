"""Toxicity by a classifier chain over indicators of words and beginnings of words.

The categories are predicted in order. The linear model of a category sees which of a learned list of words a text
holds and the probabilities of the categories before it. In training, those probabilities come from models that
did not see the row (out of fold), so a later model meets inputs as uncertain as they will be in use.

Models are fitted on a bounded sample of the labelled rows: at most SAMPLE_PER_CLASS rows of each combination of
labels, those with the smallest hash of their id. Scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import partial, reduce
from itertools import product
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerspark.llm.tables import frugal
from ledgerspark.staging import stage_table

#: Labelled rows of each combination of labels that are used for training, at most.
SAMPLE_PER_CLASS = 3000
#: Words that the models look for: for each category, those that tell its classes apart best in the sample.
WORDS_PER_CATEGORY = 400
FOLDS = 3
#: A text with at least this probability of the last category is toxic.
THRESHOLD = 0.35
#: Lengths of the beginnings of words that are looked for beside whole words.
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Lower-case words of a text and, marked by a star, their first letters: inflected words share those."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {f"{w[:k]}*" for w in words for k in STEMS if len(w) > k}


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 150) -> np.ndarray:
    """Weights and, last, intercept of a ridge-penalised logistic regression, classes weighted alike.

    Accelerated gradient steps of a fixed size. Without both classes there is nothing to tell apart: never is predicted.
    """
    if not len(y) or y.min() == y.max():
        return np.append(np.zeros(x.shape[1]), -30.0)
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    # largest eigenvalue of x'x by power iterations: bounds the curvature
    v = np.ones(x.shape[1]) / np.sqrt(x.shape[1])
    for _ in range(8):
        v = x.T @ (weight * (x @ v))
        v /= np.linalg.norm(v)
    rate = 1 / (0.3 * np.linalg.norm(x.T @ (weight * (x @ v))) + penalty)
    w = momentum = np.zeros(x.shape[1])
    ridge = np.append(np.full(x.shape[1] - 1, penalty), 0)
    for k in range(steps):
        step = momentum - rate * (x.T @ (weight * (_logistic(x @ momentum) - y)) + ridge * momentum)
        momentum = step + k / (k + 3) * (step - w)
        w = step
    return w


def _apply(x: np.ndarray, model: np.ndarray) -> np.ndarray:
    return _logistic(x @ model[:-1] + model[-1])


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """One model per column of labels; model k has k more inputs, the probabilities of the columns before it."""
    models: list[np.ndarray] = []
    seen = x
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        out_of_fold = np.empty(len(y))
        for fold in np.unique(folds):
            held = folds == fold
            out_of_fold[held] = _apply(seen[held], fit_linear(seen[~held], y[~held]))
        models.append(fit_linear(seen, y))
        seen = np.hstack([seen, out_of_fold[:, None]])
    return models


def apply_chain(x: np.ndarray, models: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty((len(x), len(models)))
    for k, model in enumerate(models):
        out[:, k] = _apply(np.hstack([x, out[:, :k]]), model)
    return out


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        words = [sorted(words_of(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["doc_id", "words"])


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str]) -> tuple[dict[str, int], list[np.ndarray]]:
    """The learned words with their places, and the models of the chain.

    labels has doc_id and a boolean column per category; rows with nulls, ids that repeat and ids without a text are
    not used. What reaches the driver is bounded: the words, and of each sampled row the places of its words.
    """
    usable = (
        labels.select("doc_id", *categories).dropna().groupBy("doc_id")
        .agg(*(F.max(c).alias(c) for c in categories), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    )
    parts = [
        usable.where(reduce(and_, (F.col(c) == F.lit(v) for c, v in zip(categories, values, strict=True))))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS)
        for values in product((False, True), repeat=len(categories))
    ]
    sample = stage_table(reduce(DataFrame.unionByName, parts), "toxicity-sample")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(sample.select("doc_id")), "doc_id")
    held = stage_table(
        texts.mapInArrow(_split, "doc_id bigint, words array<string>").groupBy("doc_id").agg(F.first("words").alias("words"))
        .join(sample, "doc_id").withColumn("word", F.explode_outer("words")).drop("words"),
        "toxicity-words",
    )
    totals = sample.agg(*(F.sum(F.col(c).cast("int")).alias(c) for c in categories), F.count(F.lit(1)).alias("all")).first()
    per_word = held.where("word is not null").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col(c).cast("int")).alias(c) for c in categories)
    ).where("n > 1")
    chosen: dict[str, int] = {}
    for c in categories:
        yes, no = float(totals[c] or 0), float((totals["all"] or 0) - (totals[c] or 0))
        if not yes or not no:
            continue
        a, b = F.col(c) / yes, (F.col("n") - F.col(c)) / no
        strength = F.abs(a - b) / F.sqrt((a + b) * (1 / yes + 1 / no) / 2)
        for row in per_word.orderBy(strength.desc(), "word").limit(WORDS_PER_CATEGORY).collect():
            chosen.setdefault(row["word"], len(chosen))
    spark = docs.sparkSession
    places = spark.createDataFrame(list(chosen.items()), "word string, place int")
    rows = (
        held.join(F.broadcast(places), "word", "left").groupBy("doc_id", *categories)
        .agg(F.collect_list("place").alias("places"), F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).alias("fold"))
        .orderBy("doc_id").collect()
    )
    x = np.zeros((len(rows), len(chosen)), np.float32)
    for i, row in enumerate(rows):
        x[i, row["places"]] = 1
    y = np.array([[bool(row[c]) for c in categories] for row in rows]).reshape(len(rows), len(categories))
    return chosen, fit_chain(x, y, np.array([row["fold"] for row in rows]))


def probabilities(texts: Sequence[str | None], places: dict[str, int], models: list[np.ndarray]) -> np.ndarray:
    x = np.zeros((len(texts), len(places)), np.float32)
    for i, text in enumerate(texts):
        x[i, [places[w] for w in places.keys() & words_of(text)]] = 1
    return apply_chain(x, models)


def _score(batches: Iterator[pa.RecordBatch], places: dict[str, int], models: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The columns of docs, text first, plus _p: the probabilities of all categories, null without any words."""
    frugal()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            p = probabilities(part.column(0).to_pylist(), places, models)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p.tolist(), pa.list_(pa.float64()))], names=[*part.schema.names, "_p"])


def _with_probabilities(docs: DataFrame, model: tuple[dict[str, int], list[np.ndarray]]) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField("_p", T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(partial(_score, places=model[0], models=model[1]), schema)


def _toxic(threshold: float) -> Column:
    # a text without words is not toxic, whatever the intercepts say
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)) & (F.element_at("_p", -1) >= threshold)


def score(docs: DataFrame, labels: DataFrame, categories: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the probability p_<category> of each category and toxic, for every row of docs.

    toxic: the last category has at least the threshold. A null or empty text holds no words and is never toxic; nor is anything where the
    labels do not hold both classes. Rows with null or repeated ids each get their own result; an empty table gives an
    empty one. Further columns are ignored.
    """
    marked = _with_probabilities(docs.select("text", "doc_id"), train(docs, labels, categories))
    return marked.select(
        "doc_id", *(F.get("_p", F.lit(k)).alias(f"p_{c}") for k, c in enumerate(categories)), _toxic(threshold).alias("toxic")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, categories: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score does not call toxic, with all their columns, a column _p excepted."""
    plain = docs.drop("_p")
    ordered = plain.select("text", *(c for c in plain.columns if c != "text"))
    model = train(docs, labels, categories)
    return _with_probabilities(ordered, model).where(~_toxic(threshold)).select(*plain.columns)
