"""Loads of the star schema: what holds is published, what does not leaves the old tables in place."""

import datetime as dt
import os

import pytest

from ledgerspark.operators.employees import clean_employees
from ledgerspark.operators.projects import clean_projects
from ledgerspark.plans import load
from tests.helpers import employees, history, projects, transactions


def inputs(spark, *rows):
    day = dt.date(2019, 1, 1)
    return (
        clean_projects(projects(spark, {"project_id": "p1", "project_manager_id": "one"})),
        clean_employees(employees(spark, {"employee_id": "one"}, {"employee_id": "new"}), dt.date(2026, 9, 16)),
        history(spark, {"employee_id": "one", "effective_date": day}),
        transactions(spark, *[{"project_id": "p1", "approved_by": "one"} | row for row in rows]),
    )


def fact_ids(spark, out):
    return sorted(r.transaction_id for r in load.read_warehouse(spark, out)["fact_transactions"].collect())


def test_only_sound_versions_are_published(spark, tmp_path):
    out = str(tmp_path / "warehouse")
    with pytest.raises(FileNotFoundError):
        load.read_warehouse(spark, out)
    checks = load.run_warehouse(*inputs(spark, {"transaction_id": "t1"}), out)
    assert checks.count() > 30 and checks.where("violations <> 0").count() == 0
    first = load.published_version(spark, out)
    assert fact_ids(spark, out) == ["t1"]

    # a repeated id breaks a constraint, a vendor with two names the lookup; neither load leaves a trace
    twice = inputs(spark, {"transaction_id": "t1"}, {"transaction_id": "t1"})
    with pytest.raises(load.BrokenConstraints, match=r"fact_transactions: unique\(transaction_id\) \(1 rows\)"):
        load.run_warehouse(*twice, out)
    renamed = inputs(spark, {"transaction_id": "t2"}, {"transaction_id": "t3", "vendor_name": "Other"})
    with pytest.raises(Exception, match="vendor_id"):
        load.run_warehouse(*renamed, out)
    assert load.published_version(spark, out) == first and fact_ids(spark, out) == ["t1"]
    assert os.listdir(f"{out}/versions") == [first]

    # later loads replace it, and the one before the last goes
    load.run_warehouse(*inputs(spark, {"transaction_id": "t2"}), out)
    assert fact_ids(spark, out) == ["t2"] and len(os.listdir(f"{out}/versions")) == 2
    load.run_warehouse(*inputs(spark, {"transaction_id": "t4"}), out, calendar=(dt.date(2020, 1, 1), dt.date(2020, 12, 31)))
    assert fact_ids(spark, out) == ["t4"] and len(os.listdir(f"{out}/versions")) == 2
    assert first not in os.listdir(f"{out}/versions") and load.read_warehouse(spark, out)["dim_date"].count() == 366
    keys = load.read_warehouse(spark, out)["fact_transactions"].select("project_key", "employee_key", "vendor_key").first()
    assert tuple(keys) == (1, 2, 1)  # employees are numbered by id: new, one
