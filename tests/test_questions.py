import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators.employees import clean_employees
from ledgerspark.operators.projects import clean_projects
from ledgerspark.plans import questions as qs, warehouse as wh
from tests.helpers import by, employees, history, projects, transactions

D = Decimal


@pytest.fixture(scope="module")
def inputs(spark):
    raw = [
        {"project_id": f"p{i}", "project_manager_id": "e1" if i < 5 else "e2", "budget": D(100), "actual_cost": D(50 + 10 * i),
         "department": "IT" if i < 4 else "HR", "status": "On Hold" if i == 0 else "In Progress"}
        for i in range(6)
    ]
    raw.append({"project_id": "zero", "department": "Ops", "budget": D(0), "actual_cost": D(5), "status": "Completed"})
    people = employees(
        spark,
        {"employee_id": "e1", "full_name": "Same Name", "email": "one@x"},
        {"employee_id": "e2", "full_name": "Same Name", "email": "two@x"},
    )
    past = history(
        spark,
        {"employee_id": "e1", "effective_date": dt.date(2019, 1, 1), "new_salary": D(0)},
        {"employee_id": "e1", "effective_date": dt.date(2020, 1, 1), "new_salary": D(100)},
        {"employee_id": "e1", "effective_date": dt.date(2021, 1, 1), "new_salary": D(150)},
        {"employee_id": "e1", "effective_date": dt.date(2022, 1, 1), "new_salary": D(120)},
    )
    rows = []
    for i, (project, vendor, amount, status, when) in enumerate([
        ("p0", "V1", 60_000, "Pending", "2020-01-05"), ("p0", "V1", None, "Disputed", "2020-01-06"),
        ("p1", "V2", 50_000, "Pending", "2020-03-05"), ("p2", "V3", 900, "Paid", "2020-03-07"),
        ("p9", "V1", 80_000, "Pending", "2020-03-08"), ("p3", "V4", 100, "Paid", "2021-05-01"),
    ]):
        rows.append({
            "transaction_id": f"t{i}", "project_id": project, "vendor_id": vendor, "vendor_name": f"Vendor {vendor}",
            "amount": None if amount is None else D(amount), "payment_status": status, "transaction_date": when,
            "approved_by": "e1",
        })
    feed = transactions(spark, *rows)
    plans = clean_projects(projects(spark, *raw))
    staff = clean_employees(people, dt.date(2026, 9, 16))
    return plans, staff, past, feed


@pytest.fixture(scope="module", params=["surrogate", "natural"])
def star(request, inputs):
    plans, staff, past, feed = inputs
    kind = wh.Star if request.param == "surrogate" else wh.NaturalKeyStar
    return kind(plans, lambda: staff, past, feed)


def test_dept_budget(star):
    got = by(qs.dept_budget(star.dim_project), "department", "spend_percentage", "over_budget")
    assert got == {"HR": (95.0, False)}
    assert by(qs.department_totals(star.dim_project), "department", "spend_percentage")["Ops"] is None


def test_manager_workload_keeps_namesakes_apart(star):
    got = by(qs.manager_workload(star.dim_project, star.dim_employee), "email", "active_project_count", "combined_actual_spend")
    assert got == {"one@x": (5, D("350.00"))}
    lower = qs.manager_workload(star.dim_project, star.dim_employee, ("In Progress",), 0)
    assert by(lower, "email", "active_project_count") == {"one@x": 4, "two@x": 1}


def test_vendor_concentration(star):
    got = by(qs.vendor_concentration(star.fact_transactions, star.dim_vendor), "vendor_name", "transaction_count", "risk_flag")
    assert got == {"Vendor V1": (3, "HIGH"), "Vendor V2": (1, "HIGH")}


def test_open_issues_ignores_null_amounts_and_unknown_projects(star):
    got = by(qs.open_issues(star.fact_transactions, star.dim_project), "project_id", "open_transaction_count", "open_transaction_value")
    assert got == {"p0": (2, D("60000.00"))}


def test_monthly_trend(star):
    rows = qs.monthly_trend(star.fact_transactions, star.dim_date).collect()
    assert [(r.year_month, r.monthly_spend, r.running_total, r.month_over_month_pct_change) for r in rows] == [
        ("2020-01", D(60_000), D(60_000), None),
        ("2020-03", D(130_900), D(190_900), 118.17),
        ("2021-05", D(100), D(191_000), -99.92),
    ]
    last = qs.monthly_trend(star.fact_transactions, star.dim_date, last_months=12).collect()
    assert [(r.year_month, r.running_total) for r in last] == [("2021-05", D(100))]


def test_a_second_spelling_of_a_vendor_fails(spark, inputs):
    feed = transactions(
        spark,
        {"transaction_id": "a", "vendor_name": "Vendor", "amount": D(1)}, {"transaction_id": "b", "vendor_name": "VENDOR", "amount": D(1)},
    )
    natural = wh.NaturalKeyStar(inputs[0], lambda: inputs[1], inputs[2], feed)
    with pytest.raises(Exception, match="fan out"):
        qs.vendor_spend(natural.fact_transactions, natural.dim_vendor).collect()
    built = wh.Star(inputs[0], lambda: inputs[1], inputs[2], feed)
    with pytest.raises(Exception, match="fan out"):
        wh.fact_rows(feed, built.dim_project, built.dim_vendor, built.dim_employee).collect()


def test_a_day_outside_of_the_calendar_fails(spark, inputs):
    feed = transactions(spark, {"transaction_id": "a", "transaction_date": "2031-01-01", "amount": D(1)})
    natural = wh.NaturalKeyStar(inputs[0], lambda: inputs[1], inputs[2], feed)
    assert [r.year_month for r in qs.monthly_spend(natural.fact_transactions, natural.dim_date).collect()] == ["2031-01"]
    with pytest.raises(Exception, match="outside of the calendar: 20310101"):
        qs.monthly_spend(natural.fact_transactions, wh.build_dim_date(spark)).collect()


def test_compensation_increases(star):
    got = by(qs.compensation_increases(star.dim_employee), "change_date", "increase_amount", "increase_pct")
    assert got == {dt.date(2020, 1, 1): (D(100), None), dt.date(2021, 1, 1): (D(50), 50.0)}


def test_both_forms_of_the_slow_question_agree(inputs):
    plans, staff, _, feed = inputs
    one = qs.pending_above_average_sql(plans, staff, feed)
    two = qs.pending_above_average(plans, staff, feed)
    assert one.columns == two.columns
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_issue_rate(spark, inputs):
    issues = spark.createDataFrame([("p0",), ("p0",), ("p1",), ("nowhere",)], "project_id string")
    got = qs.issue_rate(inputs[0], issues)
    assert by(got, "project_id", "had_issue")["p0"] is True and got.count() == 7
    assert got.first().issue_rate_pct == 28.57


def test_marts(star, inputs):
    cards = qs.kpi_cards(star.dim_project, star.fact_transactions).first()
    assert cards.total_budget == D(600) and cards.transaction_count == 6 and cards.transaction_amount == D(191_000)
    assert cards.over_budget_projects_pct == 14.29
    donut = by(qs.vendor_donut(star.fact_transactions, star.dim_vendor, top=1), "vendor_slice", "total_spend")
    assert donut == {"Vendor V1": D(140_000), "Other": D(51_000)}


def test_slicers(star):
    plans, facts = qs.sliced(star.dim_project, star.fact_transactions, star.dim_date, statuses=["On Hold"], years=[2020])
    assert plans.count() == 1 and facts.count() == 2
    _, unfiltered = qs.sliced(star.dim_project, star.fact_transactions, star.dim_date)
    assert unfiltered.count() == 6


def test_top_variance_orders_by_variance_then_id(inputs):
    rows = qs.top_variance(inputs[0], 3).collect()
    assert [(r.project_id, r.budget_variance) for r in rows] == [("zero", D(5)), ("p5", D(0)), ("p4", D(-10))]
