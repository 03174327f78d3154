"""Explicit input schemas. Dates stay strings until they are parsed with a rule."""

from pyspark.sql import types as T

_STRING = T.StringType()


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


PROJECTS = _fields(
    project_id=_STRING, project_name=_STRING, department=_STRING, status=_STRING, priority=_STRING,
    region=_STRING, project_manager_id=_STRING, start_date=_STRING, end_date=_STRING,
    budget=T.DecimalType(14, 2), actual_cost=T.DecimalType(14, 2),
)

EMPLOYEES = _fields(
    employee_id=_STRING, full_name=_STRING, email=_STRING, hire_date=_STRING, department=_STRING,
    role=_STRING, level=_STRING, salary=T.DecimalType(12, 2), manager_id=_STRING, region=_STRING,
    status=_STRING, years_experience=T.IntegerType(),
)

SALARY_HISTORY = _fields(
    employee_id=_STRING, previous_salary=T.DecimalType(12, 2), new_salary=T.DecimalType(12, 2),
    previous_role=_STRING, new_role=_STRING, previous_level=_STRING, new_level=_STRING,
    effective_date=T.DateType(), change_type=_STRING, change_reason=_STRING,
)

TRANSACTIONS = _fields(
    transaction_id=_STRING, project_id=_STRING, vendor_id=_STRING, vendor_name=_STRING,
    category=_STRING, amount=T.DecimalType(14, 2), currency=_STRING, transaction_date=_STRING,
    payment_status=_STRING, approved_by=_STRING, invoice_ref=_STRING, notes=_STRING,
)

EVENTS = _fields(
    event_id=_STRING, event_type=_STRING, project_id=_STRING, user_id=_STRING, timestamp=_STRING,
    payload=T.MapType(_STRING, _STRING),
)
