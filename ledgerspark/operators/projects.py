"""Project cleaning: derived cost columns, status clean-up, risk level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.dates import days_between, parse_date
from ledgerspark.functions.text import strip, title_case

# What each project status counts as.
STATUS_CATEGORY = {
    "In Progress": "Active",
    "Completed": "Closed",
    "Not Started": "Pending",
    "On Hold": "Pending",
}
DEFAULT_CATEGORY = "Pending"
HIGH_UTILISATION_PCT = 90


def budget_variance() -> Column:
    return F.col("actual_cost") - F.col("budget")


def is_over_budget() -> Column:
    return F.coalesce(F.col("actual_cost") > F.col("budget"), F.lit(False))


def duration_days() -> Column:
    return days_between(parse_date(F.col("start_date")), parse_date(F.col("end_date")))


def clean_status() -> Column:
    return title_case(strip(F.col("status")))


def status_category(status: Column) -> Column:
    category = F.lit(DEFAULT_CATEGORY)
    for known, meaning in STATUS_CATEGORY.items():
        category = F.when(status == known, meaning).otherwise(category)
    return category


def budget_utilisation() -> Column:
    """Percent of the budget that is spent; null without a positive budget."""
    spent = F.col("actual_cost").cast("double") / F.col("budget").cast("double") * 100
    return F.when(F.col("budget") > 0, spent)


def risk_level(over_budget: Column, utilisation: Column) -> Column:
    return (
        F.when((F.col("priority") == "Critical") | over_budget, "High")
        .when((F.col("priority") == "High") | (utilisation > HIGH_UTILISATION_PCT), "Medium")
        .otherwise("Low")
    )


def zero_filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("decimal(14,2)"))


def clean_projects(df: DataFrame) -> DataFrame:
    """All project rules, without a shuffle.

    Parsed and computed columns come first, so that each is worked out once.
    Every derived column reads the raw amounts: a missing budget stays unknown
    in them although the amounts themselves are zero-filled.
    """
    prepared = df.withColumns(
        {
            "_status": clean_status(),
            "_start": parse_date(F.col("start_date")),
            "_end": parse_date(F.col("end_date")),
            "_utilisation": budget_utilisation(),
        }
    )
    return prepared.select(
        "project_id",
        "project_name",
        "department",
        F.col("_status").alias("status"),
        "priority",
        "region",
        "project_manager_id",
        F.col("_start").alias("start_date"),
        F.col("_end").alias("end_date"),
        zero_filled("budget").alias("budget"),
        zero_filled("actual_cost").alias("actual_cost"),
        budget_variance().alias("budget_variance"),
        is_over_budget().alias("is_over_budget"),
        days_between(F.col("_start"), F.col("_end")).alias("duration_days"),
        status_category(F.col("_status")).alias("status_category"),
        F.col("_utilisation").alias("budget_utilisation_pct"),
        risk_level(is_over_budget(), F.col("_utilisation")).alias("risk_level"),
    )


def risk_distribution(clean: DataFrame) -> DataFrame:
    return clean.groupBy("risk_level").agg(F.count(F.lit(1)).alias("projects"))
