"""The load moves few bytes: changes stay in their buckets, whole numbers are checked by bitmaps; results are the plain ones."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

from ledgerspark.plans import warehouse as wh
from ledgerspark.sources.testdata import TestData
from ledgerspark.staging import bucket_count, stage_buckets
from tests.helpers import history


def changes(spark):
    rng = random.Random(5)
    start = dt.date(1969, 12, 20)
    rows = [
        {
            "employee_id": rng.choice(["", "=", "a", "b", "long", None]), "new_role": rng.choice(["r", "s", None]),
            "effective_date": rng.choice([None, start + dt.timedelta(days=rng.randint(0, 30))]), "new_salary": Decimal(rng.randint(1, 2)),
        }
        for _ in range(300)
    ]
    return rows, history(spark, *rows)


def staged(spark, past):
    return stage_buckets(wh.history_states(past, bucket_count(spark)), "states", "_who", "_when")


def test_versions_of_staged_changes_equal_brute_force(spark):
    rows, past = changes(spark)
    less = lambda v: (v is not None, v)  # noqa: E731  nulls first
    want = Counter()
    for who in {r["employee_id"] for r in rows}:
        mine = [r for r in rows if r["employee_id"] == who]
        days = sorted({r["effective_date"] for r in mine}, key=lambda d: (d is not None, d or dt.date.min))
        for day, following in zip(days, [*days[1:], None]):
            today = sorted((r for r in mine if r["effective_date"] == day), key=lambda r: (r["new_salary"], less(r["new_role"])))
            for r in today:
                last = r is today[-1]
                end = (following or dt.date(9999, 12, 31)) if last else day
                want[who, r["new_salary"], r["new_role"], day, end, last and following is None] += 1
    for versions in (wh.history_versions(past, staged(spark, past)), wh.history_versions(past)):
        got = versions.select("employee_id", "salary", "role", "valid_from", "valid_to", "is_current").collect()
        assert Counter(tuple(r) for r in got) == want


def test_staged_changes_stay_in_their_buckets(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        past = changes(spark)[1]
        plan = wh.history_versions(past, staged(spark, past))._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [at for at, line in enumerate(plan) if "Exchange" in line]
    assert exchanges and not [at for at in exchanges if "salary" in plan[at + 1] or "_last" in plan[at + 1]]


def test_whole_numbers_are_checked_by_bitmaps(spark):
    rng = random.Random(7)
    used = [rng.choice([None, 0, -5, 5, 40_000, 1 << 40, rng.randint(-70_000, 70_000)]) for _ in range(400)]
    known = [n for n in used if n is not None and n % 3] + [None, 9]
    table = spark.createDataFrame([(n,) for n in used], "n bigint")
    target = spark.createDataFrame([(n,) for n in known], "key bigint")
    twice = wh._unique_violations(table, ["n"])
    assert twice.first().violations == sum(c - 1 for n, c in Counter(used).items() if n is not None)
    assert "bitmap" in twice._jdf.queryExecution().executedPlan().toString()
    missing = sum(n is not None and n not in known for n in used)
    assert missing and wh._orphan_rows(table, "n", target, "key").first().violations == missing
    assert wh._orphan_rows(table.where("n % 3 <> 0"), "n", target, "key").first().violations == 0
    assert wh._orphan_rows(table, "n", target.limit(0), "key").first().violations == sum(n is not None for n in used)
    text = wh._orphan_rows(table.selectExpr("cast(n as string) n"), "n", target.selectExpr("cast(key as string) key"), "key")
    assert text.first().violations == missing


def test_costs_are_sums_of_rounded_prices(spark, tmp_path, monkeypatch):
    day = "timestamp_ntz'2020-01-31 10:00:00'"
    line = "stack(5, 1,0.005D, 1,0.015D, 1,-10.25D, 2,999999999999.99D, 3,cast(null as double)) as (l_orderkey, l_extendedprice)"
    frames = {
        "lineitem": spark.sql(f"select *, {day} as l_shipdate from (select {line})"),
        "orders": spark.sql(f"select o, 1 as o_custkey, 'F' as o_orderstatus, 2D as o_totalprice, {day} as o_orderdate, '2-HIGH' as o_orderpriority from values 1, 2, 3 as (o)").withColumnRenamed("o", "o_orderkey"),
        "customer": spark.sql("select 1 as c_custkey, 'c' as c_name, 1 as c_nationkey, 0D as c_acctbal, 'IT' as c_mktsegment"),
        "nation": spark.sql("select 1 as n_nationkey, 'n' as n_name, 1 as n_regionkey"),
        "region": spark.sql("select 1 as r_regionkey, 'r' as r_name"),
    }
    data = TestData(spark, str(tmp_path))
    monkeypatch.setattr(data, "table", frames.__getitem__)
    got = {r.project_id: (r.actual_cost, r.start_date, r.end_date) for r in data.projects.collect()}
    assert got == {
        "PRJ1": (Decimal("-10.22"), "2020-01-31", "2020-01-31"), "PRJ2": (Decimal("999999999999.99"), "2020-01-31", "2020-01-31"),
        "PRJ3": (None, "2020-01-31", "2020-01-31"),
    }
    assert "decimal(24,2)" not in data.projects._jdf.queryExecution().executedPlan().toString()
