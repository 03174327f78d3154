"""Secrets in text by fixed rules and by character Markov models, in DataFrame operations only.

Two first-order models over printable ASCII are trained from labelled samples. Random strings are drawn by hashing, equally
many from each of ten alphabets, so the class does not depend on what the rules find. Ordinary ones are the distinct tokens
of the texts outside of the rules' spans, as they stand and in one other form that names have (over all rows; distinct, so
that copies of one text don't decide), and a calendar of dates and times. Every token outside of the rules' spans is scored,
whatever its characters, by a model that has not seen it; it is a secret where the log-likelihood ratio passes a bound that
grows with its length. The whole model is one array of 4 x 95 x 95 weights, whatever the size of the input. A number of
digits alone is not told from other numbers: to a model of pairs they are alike.

A text with n matches costs n log n steps, also where it is one huge row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerspark.staging import stage_table

# fixed values: the rules, in the order of their kinds
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 8, "access": 16, "hex": 32}

TOKEN = r"[A-Za-z0-9+/_-]{12,}={0,2}"
#: A token is a secret where random is that many times likelier than ordinary, in natural logarithms,
THRESHOLD = math.log(1000)
#: and where the ratio is at least this much per pair of characters: more than a pair that neither class has (0.4).
PAIR_THRESHOLD = 0.5
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: The alphabets of the random sample, and its strings per alphabet and characters per string.
ALPHABETS = (
    _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOWER, _UPPER, _DIGITS + _LOWER, _DIGITS + _UPPER, _UPPER + _LOWER,
    _DIGITS + _UPPER + _LOWER, _DIGITS + _UPPER + _LOWER + "+/", _DIGITS + _UPPER + _LOWER + "-_",
)
RANDOM_STRINGS, RANDOM_LENGTH = 2000, 32
#: Days of the calendar, every 25th from 1970 on, and the forms in which each of them is an ordinary token.
CALENDAR_DAYS, CALENDAR_STEP = 1000, 25
CALENDAR_FORMS = ("yyyy-MM-dd'T'HH-mm-ss'Z'", "yyyyMMddHHmmss", "yyyyMMdd'T'HHmmss", "yyyy/MM/dd/HH", "yyyy-MM-dd_HH-mm-ss")
#: Pairs added to each row of a model, and parts of the tokens, each scored by a model of the others.
PRIOR, FOLDS = 20.0, 4
_FIRST, _SIZE = 32, 95


def _running(values: Column, size: Column, merge: Callable[[Column, Column], Column], neutral: int) -> Column:
    """merge of all values up to each place (an associative function of integers), by doubling."""

    def step(done: Column, k: Column) -> Column:
        ahead = F.concat(F.array_repeat(F.lit(neutral), F.call_function("shiftleft", F.lit(1), k)), done)
        return F.zip_with(done, F.slice(ahead, F.lit(1), F.size(done)), lambda a, b: merge(a, b))

    return F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(size, F.lit(1)))).cast("int")), values, step)


def _with_matches(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """df with an array of (start, end, token) for every pattern: leftmost non-overlapping matches in text, in code points."""
    # columns of their own, so that no pattern runs twice
    found = df.withColumns(
        {f"_f_{k}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for k, p in patterns.items()}
        | {f"_g_{k}": F.transform(F.split("text", p, -1), F.length) for k, p in patterns.items()}
    )
    ends = found.withColumns({
        f"_e_{k}": _running(
            F.zip_with(f"_g_{k}", f"_f_{k}", lambda gap, f: gap + F.coalesce(F.length(f), F.lit(0))), F.size(f"_g_{k}"),
            lambda a, b: a + b, 0,
        )
        for k in patterns
    })

    def spans(k: str) -> Column:
        # both arrays are walked once; looked up inside a lambda, the sums would be made again for every match
        placed = F.zip_with(f"_f_{k}", f"_e_{k}", lambda f, end: F.struct((end - F.length(f)).alias("start"), end.alias("end"), f.alias("token")))
        return F.filter(placed, lambda s: s["token"].isNotNull())  # the text behind the last match

    return ends.select(*df.columns, *(spans(k).alias(k) for k in patterns))


def _rule_spans(kind: str, value: Callable[[Column], Column]) -> Column:
    held = F.filter(kind, lambda s: F.length(value(s["token"])) >= LEAST[kind])
    return F.transform(
        held, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"))
    )


def _outside(df: DataFrame) -> DataFrame:
    """df (base, tokens, further columns) with only those tokens that overlap no span of base.

    All spans are put in order of their starts. A token is overlapped by one that starts before it (or with it) and ends
    inside or behind it, which the greatest end so far tells, or by the next one, which the least start from there on tells.
    """
    events = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("kind"), s["end"].alias("end"), F.lit("").alias("token"))),
        F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), F.lit(1).alias("kind"), t["end"].alias("end"), t["token"].alias("token"))),
    ))
    last = (1 << 31) - 1
    ends = F.transform("_events", lambda e: F.when(e["kind"] == 0, e["end"]).otherwise(0))
    starts = F.transform(F.reverse("_events"), lambda e: F.when(e["kind"] == 0, e["start"]).otherwise(last))
    merged = (
        df.withColumn("_events", F.when(F.size("base") > 0, events))
        .withColumn("_ends", _running(ends, F.size("_events"), F.greatest, 0))
        .withColumn("_starts", F.reverse(_running(starts, F.size("_events"), F.least, last)))
    )
    judged = F.zip_with("_events", F.arrays_zip("_ends", "_starts"), lambda e, near: F.struct(
        ((e["kind"] == 1) & (near["_ends"] <= e["start"]) & (near["_starts"] >= e["end"])).alias("free"), e.alias("token")))
    free = F.transform(F.filter(judged, lambda x: x["free"]), lambda x: x["token"])
    kept = F.transform(free, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["token"].alias("token")))
    return merged.withColumn("tokens", F.when(F.size("base") > 0, kept).otherwise(F.col("tokens"))).select(*df.columns)


def _codes(token: Column) -> Column:
    """Numbers of the pairs of characters of a token, first to last."""
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c) - _FIRST)
    return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * _SIZE + b)


def random_sample(spark: SparkSession, strings: int = RANDOM_STRINGS) -> DataFrame:
    """(token) strings of RANDOM_LENGTH characters drawn from each alphabet by hashing; the same ones in every run."""
    drawn = spark.range(strings).select(
        "id", F.posexplode(F.array(*map(F.lit, ALPHABETS))).alias("alphabet", "letters"))
    place = lambda i: F.pmod(F.xxhash64("id", "alphabet", i), F.length("letters")).cast("int") + 1
    return drawn.select(F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(RANDOM_LENGTH)), lambda i: F.substring(F.col("letters"), place(i), F.lit(1))), ""
    ).alias("token"))


def calendar_sample(spark: SparkSession) -> DataFrame:
    """(token) dates with times of day, in the usual forms."""
    moment = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) + F.make_dt_interval(
        (F.col("id") * CALENDAR_STEP).cast("int"), F.lit(0), F.lit(0), F.pmod(F.xxhash64("id"), F.lit(86_400)).cast("decimal(18,6)")
    )
    return spark.range(CALENDAR_DAYS).select(
        F.explode(F.array(*(F.date_format(moment, form) for form in CALENDAR_FORMS))).alias("token"))


def _derived(token: Column) -> Column:
    """One other form of a name, chosen by its hash: in capitals, with a separator, a capital or a number in its middle, or
    a run of its middle letter."""
    half = F.floor(F.length(token) / 2).cast("int")
    begin, end = F.left(token, half), F.substring(token, half + 1, F.length(token))
    number = F.pmod(F.xxhash64(token), F.lit(100)).cast("string")
    forms = [F.upper(token), *(F.concat(begin, F.lit(mark), end) for mark in ("_", "-", "/", "___", "---", "///")),
             F.concat(begin, F.upper(F.left(end, F.lit(1))), F.substring(end, F.lit(2), F.length(token))), F.concat(begin, number, end),
             F.call_function("repeat", F.left(end, F.lit(1)), F.length(token))]
    return F.get(F.array(*forms), F.pmod(F.xxhash64(token, F.lit("form")), F.lit(len(forms))).cast("int"))


def _fold(token: Column) -> Column:
    return F.pmod(F.xxhash64(token, F.lit("fold")), F.lit(FOLDS)).cast("int")


def _weights(ordinary: DataFrame) -> Column:
    """Scalar array of log-likelihood ratios, smoothed: for every fold, of all pairs of characters; ordinary has (token).

    The model of a fold has not seen the tokens of that fold: a rare pair would else be ordinary because of the very token
    that is judged. PRIOR pairs are added to each row, half of them alike, half as often as the class has the second character.
    """
    spark = ordinary.sparkSession
    names = ordinary.distinct()
    usual = names.select(_fold(F.col("token")).alias("fold"), F.explode(F.array("token", _derived(F.col("token")))).alias("token"))
    labelled = usual.withColumn("random", F.lit(False)).unionByName(
        calendar_sample(spark).select(F.lit(-1).alias("fold"), "token", F.lit(False).alias("random"))  # in every model
    ).unionByName(random_sample(spark).select(F.lit(-1).alias("fold"), "token", F.lit(True).alias("random")))
    counts = labelled.select("fold", "random", F.explode(_codes(F.col("token"))).alias("id")).groupBy("id").agg(
        F.count_if("random").alias("r"),
        *(F.count_if(~F.col("random") & (F.col("fold") != f)).alias(f"o{f}") for f in range(FOLDS)),
    )
    grid = spark.range(_SIZE * _SIZE).select(F.col("id").cast("int").alias("id")).join(counts, "id", "left").na.fill(0)
    cells = grid.select("id", "r", F.posexplode(F.array(*(f"o{f}" for f in range(FOLDS)))).alias("fold", "o"))
    # 95 rows in each group, whatever the size of the input
    before, after = Window.partitionBy("fold", F.floor(F.col("id") / _SIZE)), Window.partitionBy("fold", F.col("id") % _SIZE)

    def likely(n: str) -> Column:
        share = (F.sum(n).over(after) + 1) / (F.sum(n).over(Window.partitionBy("fold")) + _SIZE)
        return F.log((F.col(n) + PRIOR / 2 * (share + 1 / _SIZE)) / (F.sum(n).over(before) + PRIOR))

    weight = cells.select("fold", "id", (likely("r") - likely("o")).alias("weight"))
    return weight.agg(F.transform(F.array_sort(F.collect_list(F.struct("fold", "id", "weight"))), lambda x: x["weight"])).scalar()


def _score(token: Column, weights: Column) -> Column:
    start = _fold(token) * (_SIZE * _SIZE)
    scored = F.zip_with(_codes(token), F.array_repeat(start, F.length(token) - 1), lambda pair, fold: pair + fold)
    return F.aggregate(scored, F.lit(0.0), lambda total, i: total + F.get(weights, i))


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD, pair_threshold: float = PAIR_THRESHOLD) -> DataFrame:
    """(doc_id, spans array<struct<start,kind,end>>) of every row of docs (doc_id, text, further columns ignored).

    Spans are in code points, end exclusive, by start and then kind; kind is the index in KINDS. Matches of one rule
    do not overlap, those of different rules may; markov spans are whole tokens and lie outside of all others. A null or empty
    text has no spans. Every row gets a result, also with a null or repeated doc_id. An empty table gives an empty result.
    """
    matched = _with_matches(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
        # a shorter hex run is no match and holds none
        {"assign": ASSIGN, "access": ACCESS, "hex": HEX.replace("+", "{32,}"), "tokens": TOKEN},
    )
    base = F.concat(
        # the second group ends the match, so the match alone gives it again
        _rule_spans("assign", lambda token: F.regexp_extract(token, ASSIGN, 2)),
        _rule_spans("access", lambda token: token), _rule_spans("hex", lambda token: token),
    )
    found = stage_table(_outside(matched.select("doc_id", base.alias("base"), "tokens")), "secret-tokens")
    weights = _weights(found.select(F.explode("tokens.token").alias("token")))
    bound = lambda t: F.greatest(F.lit(threshold), pair_threshold * (F.length(t["token"]) - 1))
    scored = F.filter("tokens", lambda t: _score(t["token"], F.col("weights")) >= bound(t))
    added = F.transform(
        scored, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("markov")).alias("kind"), t["end"].alias("end"))
    )
    return found.withColumn("weights", weights).select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))


def described(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def secret_digests(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts by kind, the digest of the rules' spans and all spans as text."""
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)
    ]
    rules = F.filter("spans", lambda s: s["kind"] < KINDS.index("markov"))
    return find_secrets(docs, threshold).select(
        "doc_id", *counts[:3], F.sha2(described(rules), 256).alias("base_sha256"), described(F.col("spans")).alias("spans"), counts[3]
    )
