import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators.employees import clean_employees
from ledgerspark.operators.projects import clean_projects
from ledgerspark.plans import warehouse as wh
from tests.helpers import by, employees, history, projects, transactions

OPEN = dt.date(9999, 12, 31)


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def past(spark):
    return history(
        spark,
        {"employee_id": "one", "effective_date": day("2019-01-01")},
        *[{"employee_id": "three", "effective_date": day(f"20{y}-01-01"), "new_salary": Decimal(y)} for y in (18, 19, 20)],
        {"employee_id": "tie", "effective_date": day("2019-01-01"), "new_salary": Decimal(1)},
        {"employee_id": "tie", "effective_date": day("2019-01-01"), "new_salary": Decimal(2)},
        {"employee_id": "tie", "effective_date": day("2020-01-01"), "new_salary": Decimal(3)},
        {"employee_id": "same", "effective_date": day("2019-01-01")},
        {"employee_id": "same", "effective_date": day("2019-01-01")},
        {"employee_id": "gone", "effective_date": day("2019-01-01")},
    )


@pytest.fixture(scope="module")
def people(spark):
    ids = ["one", "three", "tie", "same", "new"]
    return clean_employees(employees(spark, *[{"employee_id": i} for i in ids]), day("2026-09-16"))


@pytest.fixture(scope="module")
def dim(people, past):
    return wh.build_dim_employee(people, past).cache()


def spans(df, who):
    rows = df.where(F.col("employee_id") == who).orderBy("valid_from", "valid_to", "salary").collect()
    return [(str(r.valid_from), str(r.valid_to), r.is_current) for r in rows]


def test_versions_run_to_the_next_change(dim):
    assert spans(dim, "one") == [("2019-01-01", "9999-12-31", True)]
    assert spans(dim, "three") == [
        ("2018-01-01", "2019-01-01", False), ("2019-01-01", "2020-01-01", False), ("2020-01-01", "9999-12-31", True),
    ]


def test_changes_on_one_day_leave_one_lasting_version(dim):
    assert spans(dim, "tie") == [
        ("2019-01-01", "2019-01-01", False), ("2019-01-01", "2020-01-01", False), ("2020-01-01", "9999-12-31", True),
    ]
    assert spans(dim, "same") == [("2019-01-01", "2019-01-01", False), ("2019-01-01", "9999-12-31", True)]


def test_people_without_history_and_history_without_people(dim):
    assert spans(dim, "new") == [("2015-05-05", "9999-12-31", True)]
    assert spans(dim, "gone") == []


def test_keys_are_dense_and_ordered(dim):
    rows = dim.orderBy("employee_key").collect()
    assert [r.employee_key for r in rows] == list(range(1, len(rows) + 1))
    assert [(r.employee_id, r.valid_from) for r in rows] == sorted((r.employee_id, r.valid_from) for r in rows)


def test_one_current_and_no_overlap(dim):
    assert wh.several_current(dim).count() == 0
    assert wh.overlapping_versions(dim).count() == 0


def test_overlaps_equal_brute_force(spark):
    import random

    rng = random.Random(3)
    rows, start = [], dt.date(2020, 1, 1)
    for key in range(120):
        a = start + dt.timedelta(days=rng.randint(0, 60))
        rows.append((f"e{rng.randint(0, 8)}", key, a, a + dt.timedelta(days=rng.randint(-1, 6))))
    df = spark.createDataFrame(rows, "employee_id string, employee_key int, valid_from date, valid_to date")
    got = {(r.version_a, r.version_b) for r in wh.overlapping_versions(df).collect()}
    want = {
        (a[1], b[1]) for a in rows for b in rows
        if a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3]
    }
    assert got == want and want


def test_point_in_time(spark, dim):
    feed = transactions(
        spark,
        *[
            {"transaction_id": name, "approved_by": who, "transaction_date": when}
            for name, who, when in [
                ("on_from", "three", "2019-01-01"), ("before_to", "three", "2019-12-31"), ("on_to", "three", "2020-01-01"),
                ("too_early", "three", "2017-12-31"), ("nobody", None, "2019-06-01"), ("no_date", "three", "?"),
            ]
        ],
    )
    dated = feed.withColumn("transaction_day", F.expr("try_to_date(transaction_date, 'yyyy-MM-dd')"))
    salary = dim.select("employee_key", F.col("salary").cast("int").alias("paid"))
    got = by(wh.at_version(dated, dim).join(salary, "employee_key", "left"), "transaction_id", "paid")
    assert got == {"on_from": 19, "before_to": 19, "on_to": 20, "too_early": None, "nobody": None, "no_date": None}


@pytest.fixture(scope="module")
def star(spark, people, past):
    plans = clean_projects(
        projects(spark, {"project_id": "p1", "project_manager_id": "one"}, {"project_id": "p2", "project_manager_id": "x"})
    )
    feed = transactions(
        spark,
        {"transaction_id": "t1", "project_id": "p1", "approved_by": "one"},
        {"transaction_id": "t2", "project_id": "p1", "approved_by": "one", "vendor_id": "V2", "vendor_name": "W"},
        {"transaction_id": "t3", "project_id": "p9", "approved_by": None, "transaction_date": "2020-02-29"},
    )
    return wh.Star(plans, lambda: people, past, feed)


def test_fact_keeps_unmatched_rows(star):
    got = by(star.fact_transactions, "transaction_id", "transaction_key", "project_key", "vendor_key", "date_key")
    assert got == {"t1": (1, 1, 1, 20200115), "t2": (2, 1, 2, 20200115), "t3": (3, None, 1, 20200229)}


def test_bridge(star):
    roles = [r.project_role for r in star.bridge_employee_project.collect()]
    assert sorted(roles) == ["Approver", "Manager"]


def test_constraints_hold_and_breaks_are_counted(spark, star):
    tables = star.tables()
    assert wh.constraint_violations(tables).where("violations > 0").count() == 0
    broken = dict(tables)
    broken["dim_vendor"] = tables["dim_vendor"].unionByName(
        spark.createDataFrame([(7, "V1", None), (None, "V3", None)], "vendor_key bigint, vendor_id string, vendor_name string")
    )
    broken["dim_project"] = tables["dim_project"].where("project_id <> 'p1'")
    found = {
        (r.table_name, r.constraint_name): r.violations
        for r in wh.constraint_violations(broken).where("violations > 0").collect()
    }
    assert found == {
        ("dim_vendor", "unique(vendor_id)"): 1,
        ("dim_vendor", "not null(vendor_key)"): 1,
        ("bridge_employee_project", "project_key references dim_project"): 2,
        ("fact_transactions", "project_key references dim_project"): 2,
    }


def test_calendar(spark):
    days = wh.build_dim_date(spark)
    assert days.count() == 10_227
    got = by(days.where("date_key in (20210101, 20240229)"), "date_key", "week", "month_name", "day_of_week", "is_weekend")
    assert got == {20210101: (53, "January", "Friday", False), 20240229: (9, "February", "Thursday", False)}
