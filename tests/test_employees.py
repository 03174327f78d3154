import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest

from ledgerspark.operators.employees import (
    clean_employees,
    employee_fix_counts,
    inactive_conflicts,
    median_hire_date,
    salary_bands,
    stage_salary_bands,
)
from ledgerspark.operators.quantiles import grouped_quantiles
from tests.helpers import by, employees


@pytest.fixture(scope="module")
def raw(spark):
    return employees(
        spark,
        {"employee_id": "EMP1", "email": None, "hire_date": None},
        {"employee_id": "EMP2", "email": "  ", "hire_date": "  "},
        {"employee_id": "EMP3", "email": "\t", "hire_date": "-999"},
        {"employee_id": "EMP4", "hire_date": "99999-01-01", "years_experience": -1},
        {"employee_id": "EMP5", "hire_date": "1989-12-31", "years_experience": 0},
        {"employee_id": "EMP6", "hire_date": "1990-01-01", "years_experience": 50},
        {"employee_id": "EMP7", "hire_date": "2026-09-16", "years_experience": 51},
        {"employee_id": "EMP8", "hire_date": "2026-09-17", "years_experience": None},
        {"employee_id": "EMP9", "hire_date": " 2010-01-01 ", "manager_id": "EMP9"},
        {"employee_id": "EMP10", "manager_id": None, "role": " ", "level": None},
    )


def test_missing_email_gets_its_own_placeholder(raw, as_of):
    got = by(clean_employees(raw, as_of), "employee_id", "email")
    assert [got[f"EMP{i}"] for i in (1, 2, 3)] == [f"missing.emp{i}@example.com" for i in (1, 2, 3)]
    assert got["EMP4"] == "a@x.y"


def test_hire_dates(raw, as_of):
    got = by(clean_employees(raw, as_of), "employee_id", "hire_date")
    usable = sorted([dt.date(1990, 1, 1), dt.date(2026, 9, 16), dt.date(2010, 1, 1), dt.date(2015, 5, 5)])
    days = [(d - dt.date(1970, 1, 1)).days for d in usable]
    median = dt.date(1970, 1, 1) + dt.timedelta(days=int(np.floor(np.median(days))))
    assert got["EMP6"] == dt.date(1990, 1, 1) and got["EMP7"] == as_of and got["EMP9"] == dt.date(2010, 1, 1)
    assert {got[f"EMP{i}"] for i in (1, 2, 3, 4, 5, 8)} == {median}


def test_median_of_an_odd_number_and_of_none(spark, as_of):
    odd = employees(spark, *[{"employee_id": str(i), "hire_date": f"2020-01-0{i}"} for i in (1, 2, 9)])
    assert median_hire_date(odd, as_of).first()[0] == dt.date(2020, 1, 2)
    none = employees(spark, {"employee_id": "1", "hire_date": "x"})
    assert median_hire_date(none, as_of).first()[0] is None


def test_experience_is_clamped(raw, as_of):
    got = by(clean_employees(raw, as_of), "employee_id", "years_experience")
    assert (got["EMP4"], got["EMP5"], got["EMP6"], got["EMP7"], got["EMP8"]) == (0, 0, 50, 50, None)


def test_managers_and_unknown_texts(raw, as_of):
    got = by(clean_employees(raw, as_of), "employee_id", "manager_id", "role", "level")
    assert got["EMP9"][0] is None and got["EMP1"][0] == "EMP0000"
    assert got["EMP10"] == ("Unknown", "Unknown", "Unknown")


def test_fix_counts(raw, as_of):
    got = by(employee_fix_counts(raw, as_of), "issue", "affected_rows")
    assert got == {
        "missing_email": 3, "missing_role": 1, "missing_level": 1, "missing_manager_id": 1,
        "invalid_hire_date_format": 2, "implausible_hire_date": 2, "hire_date_imputed": 4,
        "negative_years_experience": 1, "implausible_years_experience": 1, "salary_level_mismatch": 0,
        "self_referencing_manager": 1,
    }


def test_salaries_are_capped_to_the_band_of_their_level(spark, as_of):
    pay = [100, 110, 120, 130, 1000]
    rows = [{"employee_id": f"E{i}", "salary": Decimal(p)} for i, p in enumerate(pay)]
    rows += [{"employee_id": "single", "level": "Lead", "salary": Decimal(5)}]
    df = employees(spark, *rows)
    bands = by(salary_bands(df), "level", "lower_bound", "upper_bound")
    q1, mid, q3 = np.quantile(pay, [0.25, 0.5, 0.75])
    assert bands["Mid"] == (Decimal(str(mid - 2 * (q3 - q1))), Decimal(str(mid + 2 * (q3 - q1))))
    assert bands["Lead"] == (Decimal(5), Decimal(5))
    got = by(clean_employees(df, as_of), "employee_id", "salary")
    assert got["E4"] == Decimal(160) and got["E0"] == Decimal(100) and got["single"] == Decimal(5)


def test_bands_that_nobody_reads_are_not_made(raw, as_of, monkeypatch):
    """No job and no write while the plan is built, and no quantiles in a plan that reads no salary."""
    monkeypatch.setattr("ledgerspark.operators.employees.stage_table", lambda *_: pytest.fail("a column rule writes"))
    cleaned = clean_employees(raw, as_of)
    plan = cleaned.select("employee_id", "full_name", "hire_date")._jdf.queryExecution().optimizedPlan().toString()
    assert "_band" not in plan
    assert "_band" in cleaned.select("salary")._jdf.queryExecution().optimizedPlan().toString()


def test_given_bands_give_the_same_rows(raw, as_of):
    bands = stage_salary_bands(raw)
    assert sorted(map(str, clean_employees(raw, as_of, bands=bands).collect())) == sorted(map(str, clean_employees(raw, as_of).collect()))
    assert sorted(employee_fix_counts(raw, as_of, bands).collect()) == sorted(employee_fix_counts(raw, as_of).collect())


def test_low_edge_is_not_negative(spark):
    df = employees(spark, *[{"employee_id": str(i), "salary": Decimal(p)} for i, p in enumerate([1, 50, 100])])
    assert by(salary_bands(df), "level", "lower_bound")["Mid"] == 0


def test_quantiles_equal_numpy(spark):
    rng = random.Random(7)
    groups = {
        "one": [Decimal("3.14")],
        "ties": [Decimal("5.00")] * 7 + [Decimal("6.00")] * 2,
        "signs": [Decimal(rng.randint(-500, 500)) / 100 for _ in range(200)],
        "wide": [Decimal(rng.randint(1, 10**9)) / 100 for _ in range(501)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None)]
    df = spark.createDataFrame(rows, "g string, v decimal(12,2)")
    named = {"a": Decimal("0.25"), "b": Decimal("0.50"), "c": Decimal("0.75")}
    got = by(grouped_quantiles(df, "g", "v", named), "g", "a", "b", "c")
    for g, values in groups.items():
        want = np.quantile([float(v) for v in values], [0.25, 0.5, 0.75])
        assert [float(v) for v in got[g]] == pytest.approx(list(want), abs=1e-4)


def test_inactive_conflicts(raw, as_of):
    got = by(inactive_conflicts(raw, as_of), "employee_id", "unusable_hire_date", "self_managed")
    assert got["EMP9"] == (False, True) and got["EMP3"] == (True, False) and "EMP6" not in got
