"""The fact looks its keys up on narrow rows; the keys are those of the whole dimensions."""

import datetime as dt
import random

import pytest

from ledgerspark.operators.employees import clean_employees
from ledgerspark.operators.projects import clean_projects
from ledgerspark.plans import load, warehouse as wh
from tests.helpers import employees, history, projects, transactions


@pytest.fixture(scope="module")
def star(spark, as_of):
    rng = random.Random(3)
    start = dt.date(2019, 1, 1)
    people = [f"e{i}" for i in range(12)] + ["e3", "e11", None]  # two of them are there twice
    changes = [(f"e{rng.randint(0, 8)}", start + dt.timedelta(days=30 * rng.randint(0, 20)), f"r{rng.randint(0, 1)}") for _ in range(60)]
    rows = [
        {
            "transaction_id": f"t{rng.randint(0, 70)}", "project_id": rng.choice(["p1", "p2", "p10", "p9", None]),
            "approved_by": rng.choice(["e1", "e10", "e11", "e3", "e5", "gone", None]), "vendor_id": rng.choice(["V1", None]),
            "transaction_date": rng.choice(["?", str(start + dt.timedelta(days=rng.randint(-40, 700)))]), "invoice_ref": f"i{i}",
        }
        for i in range(80)
    ]
    return wh.Star(
        clean_projects(projects(spark, *[{"project_id": p, "project_manager_id": "e1"} for p in ("p1", "p10", "p2")])),
        lambda: clean_employees(employees(spark, *[{"employee_id": e} for e in people]), as_of),
        history(spark, *[{"employee_id": e, "effective_date": day, "new_role": role} for e, day, role in changes]),
        transactions(spark, *rows),
    )


def test_keys_are_those_of_the_dimensions(star):
    columns = ["invoice_ref", "transaction_id", "project_key", "employee_key", "vendor_key", "date_key"]
    whole = wh.fact_rows(star._transactions, star.dim_project, star.dim_vendor, star.dim_employee)
    fact = star.fact_transactions.collect()
    got = sorted((tuple(r[c] for c in columns) for r in fact), key=str)
    assert got == sorted((tuple(r[c] for c in columns) for r in whole.collect()), key=str)
    assert len(got) > 80 and any(r[2] for r in got) and any(r[3] for r in got) and any(r[4] is None for r in got)
    keys = sorted({(r.transaction_key, r.transaction_id) for r in fact})
    assert [k for k, _ in keys] == list(range(1, 81)) and [i for _, i in keys] == sorted(i for _, i in keys)


def test_lookups_shuffle_no_whole_transactions(spark, star):
    # a vendor is the one lookup that is left to the planner
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = wh.stage_transactions(star._transactions.where("vendor_id is not null"))
        fact = wh.keyed_fact(rows, wh.with_project_keys(rows, star.dim_project), star.dim_vendor.limit(0), star.dim_employee)
        plan = fact.drop("vendor_key")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = [below for line, below in zip(plan, plan[1:]) if "Exchange" in line and "invoice_ref" in below]
    assert any("Exchange" in line for line in plan) and not shuffled


def test_repeated_text_keys_are_counted_by_hash_first(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "code string, n int")
    assert wh._unique_violations(df, ["code"]).first().violations == 3
    assert wh._unique_violations(df, ["code", "n"]).first().violations == 2
    sound = wh._unique_violations(df.where("code = 'b'"), ["code"])
    assert sound.first().violations == 0
    assert "xxhash64(code" in sound._jdf.queryExecution().executedPlan().toString()


def test_the_load_reads_staged_transactions(star, tmp_path, monkeypatch):
    seen = []
    for name in ("dim_date_for", "build_dim_vendor"):
        monkeypatch.setattr(wh, name, lambda df, run=getattr(wh, name): (seen.append("_row" in df.columns), run(df))[1])
    written = load.write_star(star._projects, star._employees(), star._history, star._transactions, str(tmp_path))
    assert seen == [True, True]
    bridge = wh.build_bridge(star._transactions, written["dim_project"], written["dim_employee"])
    got = [tuple(r) for r in written["bridge_employee_project"].collect()]
    assert sorted(got) == sorted(tuple(r) for r in bridge.collect()) and got
    assert sorted(written["dim_employee"].columns) == sorted(star.dim_employee.columns)


def test_staged_transactions_are_a_file_per_block_and_not_per_bucket(spark):
    dealt = transactions(spark, *[{"transaction_id": f"t{i}"} for i in range(400)]).repartition(20)
    rows = wh.stage_transactions(dealt)
    assert len(rows.inputFiles()) <= 20  # 20 tasks with fewer rows than a block; in 4 buckets each, they were 80
    assert sorted(r.transaction_id for r in rows.collect()) == sorted(f"t{i}" for i in range(400))
    assert rows.select("_row").distinct().count() == 400


def test_a_task_of_many_blocks_fills_many_buckets(spark, star, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK_BITS", 2)
    rows = wh.stage_transactions(star._transactions.coalesce(1))
    assert rows.groupBy("_block").count().agg({"count": "max"}).first()[0] <= 4
    assert len({name.rpartition("_")[2] for name in rows.inputFiles()}) > 1  # the bucket is the end of the name
    columns = ["invoice_ref", "transaction_id", "project_key", "employee_key", "vendor_key"]
    of_project = wh.with_project_keys(rows, star.dim_project)
    fact = wh.keyed_fact(rows, of_project, star.dim_vendor, star.dim_employee).select(columns).collect()
    whole = wh.fact_rows(star._transactions, star.dim_project, star.dim_vendor, star.dim_employee).select(columns).collect()
    assert sorted(map(tuple, fact), key=str) == sorted(map(tuple, whole), key=str)


def test_small_lookups_of_the_fact_are_staged(spark, star, monkeypatch):
    seen = {}
    versions, fact = wh.employee_versions, wh.keyed_fact
    monkeypatch.setattr(wh, "employee_versions", lambda people, *rest: (seen.update(people=people), versions(people, *rest))[1])
    monkeypatch.setattr(wh, "keyed_fact", lambda rows, of_project, vendors, at: (seen.update(vendors=vendors), fact(rows, of_project, vendors, at))[1])
    wh.Star(star._projects, star._employees, star._history, star._transactions).fact_transactions
    for lookup in seen.values():  # the planner knows their size, and plans nothing that makes them
        plan = lookup._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "Join" not in plan and "Exchange" not in plan
    assert sorted(seen) == ["people", "vendors"]


def test_staged_transactions_stay_beside_what_is_joined(spark, star):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = wh.stage_transactions(star._transactions)
        fact = wh.keyed_fact(rows, wh.with_project_keys(rows, star.dim_project), star.dim_vendor.limit(0), star.dim_employee)
        of_plan = fact.drop("vendor_key")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in of_plan]
    at = next(i for i, line in enumerate(of_plan) if "FileScan" in line and "invoice_ref" in line)
    above = [of_plan[i] for i in range(at) if depth[i] < min(depth[i + 1 : at + 1])]
    assert "Bucketed: true" in of_plan[at] and sum("SortMergeJoin" in line for line in above) == 3
    assert not [line for line in above if "Exchange" in line]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
