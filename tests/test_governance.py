import datetime as dt
import hmac
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.plans import governance as gov
from tests.helpers import by, employees, projects, transactions


KEY = b"sixteen bytes ok"


def test_pseudonyms_need_the_key(spark):
    rows = [("A B",), (None,), ("",), ("\u00e9" * 100,)]
    df = spark.createDataFrame(rows, "t string")
    for key in (KEY, b"k" * 64, b"k" * 200):
        got = [r.p for r in df.select(gov.pseudonym(F.col("t"), key).alias("p")).collect()]
        assert got == [None if t is None else hmac.new(key, t.encode(), "sha256").hexdigest() for (t,) in rows]
    frame = employees(spark, {"employee_id": "1"})
    with pytest.raises(ValueError, match="maskKey"):
        gov.mask_view(frame, "employees", "Executive")
    spark.conf.set(gov.KEY_SETTING, KEY.hex())
    try:
        assert gov.mask_view(frame, "employees", "Executive").first().full_name == hmac.new(KEY, b"A B", "sha256").hexdigest()
    finally:
        spark.conf.unset(gov.KEY_SETTING)


def test_classes_cover_every_column(spark):
    rows = gov.classification({"employees": employees(spark, {"employee_id": "1", "email": None})})
    got = by(rows, "column_name", "classification", "regulation", "filled_rows")
    assert len(got) == 12
    assert got["salary"] == (gov.PII_CONFIDENTIAL, gov.PRIVACY_LAWS, 1) and got["email"][2] == 0
    assert got["department"] == (gov.INTERNAL, None, 1)


def test_views_follow_the_access_table(spark):
    frames = {
        "projects": projects(spark, {"project_id": "p", "budget": Decimal(5)}),
        "employees": employees(spark, {"employee_id": "1"}),
        "transactions": transactions(spark, {"transaction_id": "t"}),
    }
    assert set(gov.persona_views(frames, "HR Team", KEY)) == {"employees"}
    assert set(gov.persona_views(frames, "Finance Team", KEY)) == {"projects", "transactions"}
    seen = gov.mask_view(frames["employees"], "employees", "Executive", KEY).first()
    assert seen.salary is None and len(seen.full_name) == 64 and seen.department == "IT"
    assert gov.mask_view(frames["employees"], "employees", "Data Engineer").first().full_name == "A B"
    assert gov.mask_view(frames["projects"], "projects", "Executive").first().budget == Decimal(5)


@pytest.mark.parametrize(
    "dataset, since, action",
    [
        ("transactions", "2024-09-17", "keep"), ("transactions", "2024-09-16", "archive"),
        ("transactions", "2021-09-16", "dispose"), ("employees", "2024-09-17", "keep"),
        ("employees", "2024-09-16", "dispose"), ("projects", None, "keep"), ("projects", "2019-09-16", "dispose"),
        ("employees_salary_history", "2020-01-01", "archive"),
    ],
)
def test_retention(spark, dataset, since, action):
    df = spark.createDataFrame([(since and dt.date.fromisoformat(since),)], "d date")
    got = gov.with_retention(df, dataset, F.col("d"), dt.date(2026, 9, 16)).first()
    assert got.retention_action == action


def test_anonymised_rows_stay_countable(spark):
    people = employees(spark, {"employee_id": "1"}, {"employee_id": "2"})
    left = F.when(F.col("employee_id") == "1", F.lit("2020-01-01").cast("date"))
    got = by(gov.anonymise(people, left, dt.date(2026, 9, 16)), "employee_id", "full_name", "email", "department", "anonymised")
    assert got == {"1": (None, None, "IT", True), "2": ("A B", "a@x.y", "IT", False)}


def test_pay_is_only_shown_in_aggregate(spark):
    people = employees(spark, {"employee_id": "1"}, {"employee_id": "2", "salary": Decimal(10)})
    row = gov.salary_by_department(people).first()
    assert (row.employees_paid, row.average_salary, row.total_compensation) == (2, 10005.0, Decimal(20010))
