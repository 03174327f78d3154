"""Employee cleaning: placeholders, hire dates, experience, salary bands, managers."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.dates import parse_date
from ledgerspark.functions.text import is_blank
from ledgerspark.operators.quantiles import grouped_quantiles
from ledgerspark.operators.reshape import metric_rows
from ledgerspark.staging import stage_table

REQUIRED_TEXT = ["full_name", "department", "role", "level", "manager_id", "region", "status"]
UNKNOWN = "Unknown"
EARLIEST_HIRE = dt.date(1990, 1, 1)
MAX_EXPERIENCE = 50
BAND_WIDTH_IQR = 2
EMAIL_DOMAIN = "example.com"


def placeholder_email(domain: str) -> Column:
    return F.concat(F.lit("missing."), F.lower("employee_id"), F.lit(f"@{domain}"))


def filled_email(domain: str = EMAIL_DOMAIN) -> Column:
    return F.when(is_blank(F.col("email")), placeholder_email(domain)).otherwise(F.col("email"))


def known_or_unknown(column: str) -> Column:
    return F.when(is_blank(F.col(column)), UNKNOWN).otherwise(F.col(column))


def hire_date_invalid() -> Column:
    """There is text, and it is no date."""
    return ~is_blank(F.col("hire_date")) & parse_date(F.col("hire_date")).isNull()


def hire_date_implausible(as_of: dt.date) -> Column:
    parsed = parse_date(F.col("hire_date"))
    return F.coalesce((parsed < F.lit(EARLIEST_HIRE)) | (parsed > F.lit(as_of)), F.lit(False))


def usable_hire_date(as_of: dt.date) -> Column:
    parsed = parse_date(F.col("hire_date"))
    return F.when(~hire_date_implausible(as_of), parsed)


def clamped_experience() -> Column:
    years = F.col("years_experience")
    return F.when(years < 0, 0).when(years > MAX_EXPERIENCE, MAX_EXPERIENCE).otherwise(years)


def manager_without_self() -> Column:
    manager = known_or_unknown("manager_id")
    return F.when(F.coalesce(manager == F.col("employee_id"), F.lit(False)), None).otherwise(manager)


def median_hire_date(df: DataFrame, as_of: dt.date) -> DataFrame:
    """One row. The buffer of percentile holds one entry per plausible day at most."""
    days = F.unix_date(usable_hire_date(as_of))
    return df.agg(F.date_from_unix_date(F.floor(F.percentile(days, F.lit(0.5))).cast("int")).alias("median_hire_date"))


def salary_bands(df: DataFrame) -> DataFrame:
    """Per level: median, quartiles and the band median +- 2 IQR, low edge at least 0."""
    levels = df.select(known_or_unknown("level").alias("level"), F.col("salary").cast("decimal(12,2)").alias("salary"))
    quartiles = grouped_quantiles(
        levels, "level", "salary", {"q1": Decimal("0.25"), "median": Decimal("0.50"), "q3": Decimal("0.75")}
    )
    reach = (F.col("q3") - F.col("q1")) * BAND_WIDTH_IQR
    return quartiles.select(
        "level",
        "median",
        (F.col("q3") - F.col("q1")).cast("decimal(18,4)").alias("iqr"),
        F.greatest(F.col("median") - reach, F.lit(Decimal(0))).cast("decimal(18,4)").alias("lower_bound"),
        (F.col("median") + reach).cast("decimal(18,4)").alias("upper_bound"),
    )


def stage_salary_bands(df: DataFrame) -> DataFrame:
    """The bands as a written table, for runs that read the band edges.

    The planner sees the size of the files: bands are broadcast as long as they are small, and the employees are not
    shuffled by their few levels. The folder's owner removes the table.
    """
    return stage_table(salary_bands(df), "salary-bands")


def with_salary_band(df: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """The band edges next to every employee; bands are those of df unless given. Nothing runs here.

    Bands that are not given are the result of a grouping by the key of this join. So the optimizer knows the key to be
    unique and drops the join, with all that makes the bands, wherever nothing reads them.
    """
    bands = salary_bands(df) if bands is None else bands
    bands = bands.select(F.col("level").alias("_band_level"), "lower_bound", "upper_bound")
    return df.join(bands, known_or_unknown("level") == F.col("_band_level"), "left").drop("_band_level")


def salary_outside_band() -> Column:
    salary = F.col("salary")
    outside = (salary < F.col("lower_bound")) | (salary > F.col("upper_bound"))
    return F.coalesce(outside, F.lit(False))


def capped_salary() -> Column:
    salary = F.col("salary").cast("decimal(18,4)")
    return (
        F.when(salary < F.col("lower_bound"), F.col("lower_bound"))
        .when(salary > F.col("upper_bound"), F.col("upper_bound"))
        .otherwise(salary)
    )


def clean_employees(df: DataFrame, as_of: dt.date, domain: str = EMAIL_DOMAIN, bands: DataFrame | None = None) -> DataFrame:
    """All employee rules; two small aggregates joined into one projection. bands as in with_salary_band."""
    context = with_salary_band(df, bands).crossJoin(F.broadcast(median_hire_date(df, as_of)))
    return context.select(
        "employee_id",
        known_or_unknown("full_name").alias("full_name"),
        filled_email(domain).alias("email"),
        F.coalesce(usable_hire_date(as_of), F.col("median_hire_date")).alias("hire_date"),
        known_or_unknown("department").alias("department"),
        known_or_unknown("role").alias("role"),
        known_or_unknown("level").alias("level"),
        capped_salary().alias("salary"),
        manager_without_self().alias("manager_id"),
        known_or_unknown("region").alias("region"),
        known_or_unknown("status").alias("status"),
        clamped_experience().alias("years_experience"),
    )


def employee_fix_counts(df: DataFrame, as_of: dt.date, bands: DataFrame | None = None) -> DataFrame:
    """Rows touched by each rule, as (issue, affected_rows).

    A required text column is listed only when it has missing values. bands as in with_salary_band.
    """
    bad_date = hire_date_invalid() | hire_date_implausible(as_of)
    years = F.col("years_experience")
    self_managed = F.coalesce(known_or_unknown("manager_id") == F.col("employee_id"), F.lit(False))
    metrics = {"missing_email": F.count_if(is_blank(F.col("email")))}
    metrics |= {f"missing_{c}": F.count_if(is_blank(F.col(c))) for c in REQUIRED_TEXT}
    metrics |= {
        "invalid_hire_date_format": F.count_if(hire_date_invalid()),
        "implausible_hire_date": F.count_if(hire_date_implausible(as_of)),
        "hire_date_imputed": F.count_if(bad_date),
        "negative_years_experience": F.count_if(years < 0),
        "implausible_years_experience": F.count_if(years > MAX_EXPERIENCE),
        "salary_level_mismatch": F.count_if(salary_outside_band()),
        "self_referencing_manager": F.count_if(self_managed),
    }
    rows = metric_rows(with_salary_band(df, bands), metrics, "issue", "affected_rows")
    optional = [f"missing_{c}" for c in REQUIRED_TEXT]
    return rows.where(~F.col("issue").isin(optional) | (F.col("affected_rows") > 0))


def inactive_conflicts(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Active employees whose hire date is unusable or who manage themselves."""
    no_date = usable_hire_date(as_of).isNull()
    self_managed = F.coalesce(F.col("manager_id") == F.col("employee_id"), F.lit(False))
    return df.where((F.col("status") == "Active") & (no_date | self_managed)).select(
        "employee_id",
        "status",
        no_date.alias("unusable_hire_date"),
        self_managed.alias("self_managed"),
    )
