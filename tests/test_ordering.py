import random

from pyspark.sql import functions as F

from ledgerspark.operators.dedup import first_per_key
from ledgerspark.operators.ordering import add_dense_key, add_group_rank
from tests.helpers import plan


def test_dense_keys_follow_the_order(spark):
    values = random.Random(1).sample(range(100_000), 5000)
    df = spark.createDataFrame([(str(v),) for v in values], "id string").repartition(7)
    got = add_dense_key(df, ["id"], "k").collect()
    assert {r.id: r.k for r in got} == {v: i + 1 for i, v in enumerate(sorted(map(str, values)))}


def test_dense_keys_of_nothing(spark):
    assert add_dense_key(spark.createDataFrame([], "id string"), ["id"], "k").collect() == []


def test_group_rank_with_one_group_holding_most_rows(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"g{rng.randint(0, 40)}", rng.randint(0, 300), i) for i in range(6000)]
    rows += [(None, 1, 6000), (None, None, 6001)]
    df = spark.createDataFrame(rows, "g string, t int, id int").repartition(5)
    got = {r.id: r.n for r in add_group_rank(df, ["g"], ["t", "id"], "n").collect()}
    want, seen = {}, {}
    for g, t, i in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert got == want


def test_the_hot_group_is_ranked_in_several_tasks(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.col("id").alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = add_group_rank(df, ["g"], ["t"], "n")
        assert ranked.where(F.col("n") != F.col("t") + 1).count() == 0
        tasks = ranked.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", None), ("a", 1), ("b", None)], "k string, t int")
    first = first_per_key(df, ["k"], [F.col("t").asc_nulls_last()])
    assert sorted(first.collect()) == [("a", 1), ("b", None)]
    text = plan(first)
    assert "WindowGroupLimit" in text and "Partial" in text
