"""Small frames and result readers for the tests."""

from decimal import Decimal

from ledgerspark import schemas


def _frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def projects(spark, *rows):
    base = {"project_name": "P", "department": "IT", "status": "In Progress", "priority": "Low", "region": "R"}
    return _frame(spark, schemas.PROJECTS, [base | row for row in rows])


def employees(spark, *rows):
    base = {
        "full_name": "A B", "email": "a@x.y", "hire_date": "2015-05-05", "department": "IT", "role": "Dev",
        "level": "Mid", "salary": Decimal("20000.00"), "manager_id": "EMP0000", "region": "R", "status": "Active",
        "years_experience": 5,
    }
    return _frame(spark, schemas.EMPLOYEES, [base | row for row in rows])


def history(spark, *rows):
    base = {"new_salary": Decimal("100.00"), "new_role": "Dev", "new_level": "Mid", "change_reason": "c"}
    return _frame(spark, schemas.SALARY_HISTORY, [base | row for row in rows])


def transactions(spark, *rows):
    base = {
        "vendor_id": "V1", "vendor_name": "Vendor", "category": "C", "currency": "AED",
        "transaction_date": "2020-01-15", "payment_status": "Paid",
    }
    return _frame(spark, schemas.TRANSACTIONS, [base | row for row in rows])


def events(spark, *rows):
    """Events with parsed times; ts is given as text."""
    from ledgerspark.sources.files import parse_event_time

    base = {"event_type": "login", "user_id": "u1"}
    return parse_event_time(_frame(spark, schemas.EVENTS, [base | row for row in rows]))


def by(df, key, *columns):
    """{key: value or tuple of values}, one entry per row."""
    rows = df.collect()
    if len(columns) == 1:
        return {r[key]: r[columns[0]] for r in rows}
    return {r[key]: tuple(r[c] for c in columns) for r in rows}


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().toString()
