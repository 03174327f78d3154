import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.functions.dates import date_key, hours_between, parse_date, year_month
from ledgerspark.functions.numeric import percentage
from ledgerspark.functions.text import WHITE_SPACE, is_blank, null_if_missing_token, strip, title_case


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_strip_equals_python(spark):
    texts = ["a b", " a", "a\t", "　a\xa0", "\x1ca\x1f", "", "  ", "\t \n", "\xe9 ", "  x  ", "-", "~\x7f"]
    assert values(spark, texts, strip) == [t.strip() for t in texts]
    assert values(spark, texts + [None], is_blank) == [t.strip() == "" for t in texts] + [True]
    assert all(c.isspace() for c in WHITE_SPACE)


def test_title_case_equals_python(spark):
    texts = ["in progress", "ON HOLD", "on-hold", "it's", "a1b", "x  y", "\xe9tat d'art", ""]
    assert values(spark, texts, title_case) == [t.title() for t in texts]


def test_only_plain_iso_days_parse(spark):
    good = {"2020-02-29": dt.date(2020, 2, 29), " 2020-01-01 ": dt.date(2020, 1, 1), "\t2020-01-01\n": dt.date(2020, 1, 1)}
    bad = [
        "2021-02-29", "2020-13-01", "99999-01-01", "99999-1-01", "2020-1-1", "2020-1-1T1", "2020-1-1 1", "2020-01-1T",
        "2020-01-T1", "+202-01-01", "01/02/2020", "-999", "", " ", None, "2020-01-01x", "2020",
    ]
    texts = list(good) + bad
    assert values(spark, texts, parse_date) == list(good.values()) + [None] * len(bad)


def test_the_day_of_an_iso_time(spark):
    texts = ["2020-02-29T10:11:12", "2020-02-29 10:11", "2020-02-29T23:59:59.5", "2021-02-29T10:11:12", "2020-02-29T"]
    assert values(spark, texts, parse_date) == [dt.date(2020, 2, 29)] * 3 + [None] * 2


def test_missing_tokens(spark):
    assert values(spark, ["#N/A", "<NA>", "-nan", "", "x", None], null_if_missing_token) == [None] * 4 + ["x", None]


def test_parsing_equals_the_strict_pattern(spark):
    import random

    rng = random.Random(11)
    texts = ["".join(rng.choice("0129- T+") for _ in range(rng.choice([9, 10, 10, 10, 11]))) for _ in range(3000)]
    texts += [f"{rng.randint(1, 9999):04d}-{rng.randint(0, 13):02d}-{rng.randint(0, 32):02d}" for _ in range(1000)]
    assert values(spark, texts, parse_date) == values(
        spark, texts, lambda t: F.try_to_date(strip(t), "yyyy-MM-dd")
    )


def test_date_keys_and_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 7), dt.datetime(2024, 3, 7, 1, 2)), (None, None)], "d date, ts timestamp")
    rows = df.select(date_key(F.col("d")), year_month(F.col("d")), year_month(F.col("ts"))).collect()
    assert rows == [(20240307, "2024-03", "2024-03"), (None, None, None)]


def test_hours_floor_each_side_to_its_second(spark):
    row = spark.sql("select timestamp'2024-01-01 00:00:00.9' as a, timestamp'2024-01-01 00:00:03.3' as b")
    assert row.select(hours_between(F.col("a"), F.col("b"))).first()[0] == 3 / 3600


def test_percentage_of_nothing_is_null(spark):
    assert spark.range(1).select(percentage(F.lit(1), F.lit(0))).first()[0] is None
