"""Classification, masking, aggregate-only pay, retention."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.operators.reshape import metric_rows

INTERNAL = "Internal"
CONFIDENTIAL = "Confidential"
PII = "Personal (PII)"
PII_CONFIDENTIAL = "Personal (PII) + Confidential"
PRIVACY_LAWS = "GDPR + UAE PDPL"

# Class of every column that is not Internal.
SENSITIVE_COLUMNS = {
    "projects": {
        "budget": CONFIDENTIAL,
        "actual_cost": CONFIDENTIAL,
        "budget_variance": CONFIDENTIAL,
        "budget_utilisation_pct": CONFIDENTIAL,
        "is_over_budget": CONFIDENTIAL,
    },
    "employees": {
        "full_name": PII,
        "email": PII,
        "hire_date": PII,
        "salary": PII_CONFIDENTIAL,
    },
    "transactions": {
        "vendor_id": CONFIDENTIAL,
        "vendor_name": CONFIDENTIAL,
        "amount": CONFIDENTIAL,
        "notes": CONFIDENTIAL,
    },
    "employees_salary_history": {
        "previous_salary": PII_CONFIDENTIAL,
        "new_salary": PII_CONFIDENTIAL,
        "change_reason": CONFIDENTIAL,
    },
}

# Access level per persona and dataset.
ACCESS = {
    "Data Engineer": {
        "projects": "Read + Write",
        "employees": "Read + Write",
        "transactions": "Read + Write",
        "employees_salary_history": "Read",
    },
    "BI Analyst": {
        "projects": "Read",
        "employees": "Read",
        "transactions": "Read",
        "employees_salary_history": "None",
    },
    "Finance Team": {
        "projects": "Read",
        "employees": "None",
        "transactions": "Read + Write",
        "employees_salary_history": "Read",
    },
    "HR Team": {
        "projects": "None",
        "employees": "Read + Write",
        "transactions": "None",
        "employees_salary_history": "Read + Write",
    },
    "Executive": {
        "projects": "Read",
        "employees": "Read",
        "transactions": "Read",
        "employees_salary_history": "None",
    },
}

# The classes a persona sees in clear text; the others are masked for it.
CLEAR_CLASSES = {
    "Data Engineer": {CONFIDENTIAL, PII, PII_CONFIDENTIAL},
    "BI Analyst": {CONFIDENTIAL},
    "Finance Team": {CONFIDENTIAL, PII_CONFIDENTIAL},
    "HR Team": {CONFIDENTIAL, PII, PII_CONFIDENTIAL},
    "Executive": {CONFIDENTIAL},
}

# Years until rows leave the warehouse, and until they are disposed of.
RETENTION_YEARS = {
    "projects": {"archive": 1, "dispose": 7},
    "employees": {"dispose": 2},
    "transactions": {"archive": 2, "dispose": 5},
    "employees_salary_history": {"archive": 2, "dispose": 7},
}


#: The session setting with the key of pseudonyms, in hex digits.
KEY_SETTING = "spark.ledgerspark.maskKey"


def column_class(dataset: str, column: str) -> str:
    return SENSITIVE_COLUMNS.get(dataset, {}).get(column, INTERNAL)


def classification(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Class and regulation of every column, with the number of values it covers."""
    result = None
    for dataset, df in frames.items():
        filled = metric_rows(df, {c: F.count(c) for c in df.columns}, "column_name", "filled_rows")
        kind = F.lit(INTERNAL)
        for column, name in SENSITIVE_COLUMNS.get(dataset, {}).items():
            kind = F.when(F.col("column_name") == column, name).otherwise(kind)
        rows = filled.select(
            F.lit(dataset).alias("dataset"),
            "column_name",
            kind.alias("classification"),
            F.when(kind.isin(PII, PII_CONFIDENTIAL), PRIVACY_LAWS).alias("regulation"),
            "filled_rows",
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def mask_key(spark: SparkSession) -> bytes:
    """The key of the pseudonyms, as hex digits in the setting KEY_SETTING; a missing or short one fails."""
    key = bytes.fromhex(spark.conf.get(KEY_SETTING, None) or "")
    if len(key) < 16:
        raise ValueError(f"set {KEY_SETTING} to at least 32 hex digits: without a key, masked text could be guessed")
    return key


def pseudonym(value: Column, key: bytes) -> Column:
    """HMAC-SHA-256 of a text in lower-case hex, null for null: equal texts stay equal, and only the key tells which."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, value.cast("binary")), 256))), 256)


def mask_view(df: DataFrame, dataset: str, persona: str, key: bytes | None = None) -> DataFrame | None:
    """The dataset as the persona may see it, or None without access.

    Text that the persona may not see becomes a keyed pseudonym, which joins and counts across datasets; other types
    become null. Without key it is taken from the session's settings.
    """
    if ACCESS[persona][dataset] == "None":
        return None
    clear = CLEAR_CLASSES[persona] | {INTERNAL}
    kinds = dict(df.dtypes)
    hidden = [c for c in df.columns if column_class(dataset, c) not in clear]
    texts = {c for c in hidden if kinds[c] == "string"}
    secret = key if key is not None or not texts else mask_key(df.sparkSession)

    def shown(c: str) -> Column:
        if c in texts:
            return pseudonym(F.col(c), secret).alias(c)
        return F.lit(None).cast(kinds[c]).alias(c) if c in hidden else F.col(c)

    return df.select(*map(shown, df.columns))


def persona_views(frames: Mapping[str, DataFrame], persona: str, key: bytes | None = None) -> dict[str, DataFrame]:
    views = {name: mask_view(df, name, persona, key) for name, df in frames.items()}
    return {name: view for name, view in views.items() if view is not None}


def salary_by_department(employees: DataFrame) -> DataFrame:
    """Pay per department without any row of a person."""
    return employees.groupBy("department").agg(
        F.count("salary").alias("employees_paid"),
        F.round(F.avg(F.col("salary").cast("double")), 2).alias("average_salary"),
        F.sum(F.col("salary").cast("decimal(18,4)")).cast("decimal(28,4)").alias("total_compensation"),
    )


def retention_action(dataset: str, since: Column, as_of: dt.date) -> Column:
    """keep, archive or dispose by the years since the given date; no date means keep."""
    years = RETENTION_YEARS[dataset]

    def past(limit: int) -> Column:
        return F.add_months(since, 12 * limit) <= F.lit(as_of)

    action = F.when(past(years["dispose"]), "dispose")
    if "archive" in years:
        action = action.when(past(years["archive"]), "archive")
    return action.otherwise("keep")


def with_retention(df: DataFrame, dataset: str, since: Column, as_of: dt.date) -> DataFrame:
    return df.withColumn("retention_action", retention_action(dataset, since, as_of))


def retention_counts(marked: Mapping[str, DataFrame]) -> DataFrame:
    result = None
    for dataset, df in marked.items():
        rows = (
            df.groupBy("retention_action")
            .agg(F.count(F.lit(1)).alias("records"))
            .select(F.lit(dataset).alias("dataset"), "retention_action", "records")
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def anonymise(employees: DataFrame, since: Column, as_of: dt.date) -> DataFrame:
    """Employees past retention without name and email; the others unchanged."""
    dispose = retention_action("employees", since, as_of) == "dispose"
    hidden = [
        F.when(~dispose, F.col(c)).alias(c) if c in ("full_name", "email") else F.col(c) for c in employees.columns
    ]
    return employees.select(*hidden, dispose.alias("anonymised"))
