from decimal import Decimal

import pytest

from ledgerspark.operators.projects import clean_projects, risk_distribution
from tests.helpers import by, projects


@pytest.fixture(scope="module")
def clean(spark):
    money = Decimal
    return clean_projects(
        projects(
            spark,
            {"project_id": "null_budget", "actual_cost": money("5.00")},
            {"project_id": "zero_budget", "budget": money("0.00"), "actual_cost": money("5.00")},
            {"project_id": "null_actual", "budget": money("9.00")},
            {"project_id": "both_null", "priority": "Critical"},
            {"project_id": "equal", "budget": money("9.00"), "actual_cost": money("9.00")},
            {"project_id": "tab", "status": "\ton-HOLD \n", "budget": money("100.00"), "actual_cost": money("90.00")},
            {"project_id": "spaces", "status": "  not started ", "budget": money("100.00"), "actual_cost": money("90.01")},
            {"project_id": "null_status", "status": None, "priority": "High"},
            {"project_id": "dates", "start_date": "2020-01-31", "end_date": "2020-03-01"},
            {"project_id": "bad_dates", "start_date": "2020-13-31", "end_date": "99999-01-01"},
        )
    ).cache()


def test_variance_reads_the_raw_amounts(clean):
    got = by(clean, "project_id", "budget_variance", "budget", "actual_cost")
    assert got["null_budget"] == (None, Decimal("0.00"), Decimal("5.00"))
    assert got["null_actual"] == (None, Decimal("9.00"), Decimal("0.00"))
    assert got["equal"][0] == Decimal("0.00")


def test_over_budget_is_never_null(clean):
    got = by(clean, "project_id", "is_over_budget")
    assert got["zero_budget"] is True
    assert [got[k] for k in ("null_budget", "null_actual", "both_null", "equal")] == [False] * 4


def test_status_and_category(clean):
    got = by(clean, "project_id", "status", "status_category")
    assert got["tab"] == ("On-Hold", "Pending")
    assert got["spaces"] == ("Not Started", "Pending")
    assert got["null_status"] == (None, "Pending")
    assert got["equal"] == ("In Progress", "Active")


def test_utilisation_needs_a_positive_budget(clean):
    got = by(clean, "project_id", "budget_utilisation_pct")
    assert got["zero_budget"] is None and got["null_budget"] is None and got["null_actual"] is None
    assert got["equal"] == 100.0


def test_risk_takes_the_first_match(clean):
    got = by(clean, "project_id", "risk_level")
    assert got["both_null"] == "High" and got["zero_budget"] == "High"
    assert got["tab"] == "Low" and got["spaces"] == "Medium"
    assert got["null_status"] == "Medium" and got["null_actual"] == "Low"


def test_duration(clean):
    got = by(clean, "project_id", "duration_days")
    assert got["dates"] == 30 and got["bad_dates"] is None


def test_risk_distribution_counts_every_project(clean):
    assert sum(by(risk_distribution(clean), "risk_level", "projects").values()) == clean.count()


def test_column_set(clean):
    assert len(clean.columns) == 17
