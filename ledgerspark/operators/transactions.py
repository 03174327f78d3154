"""Transaction enrichment and scale-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.dates import parse_date, year_month
from ledgerspark.operators.joins import left_lookup, one_row_per_key
from ledgerspark.staging import stage_table


def is_approved() -> Column:
    return F.col("approved_by").isNotNull()


def amount_aed() -> Column:
    """The amount with an unknown value counted as zero; the raw column stays."""
    return F.coalesce(F.col("amount").cast("double"), F.lit(0.0))


def with_project(transactions: DataFrame, projects: DataFrame) -> DataFrame:
    lookup = one_row_per_key(projects, "project_id", ["project_name", "department"])
    return left_lookup(transactions, lookup, "project_id", "project_id", "transaction_id")


def approver_names(transactions: DataFrame, employees: DataFrame) -> DataFrame:
    """(employee_id, approver_name) of the employees that approve any of the transactions, staged.

    All employee ids are checked, used or not. The planner sees the size of the files, so the names of approvers are
    broadcast as long as they are small, and the transactions are not shuffled a second time.
    """
    lookup = one_row_per_key(employees, "employee_id", ["full_name"]).withColumnRenamed("full_name", "approver_name")
    used = transactions.where(F.col("approved_by").isNotNull()).select(F.col("approved_by").alias("employee_id")).distinct()
    return stage_table(lookup.join(used, "employee_id", "left_semi"), "approver-names")


def with_approver(transactions: DataFrame, employees: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """The approver's name; source has the same approvers, where transactions are costly to compute."""
    lookup = approver_names(transactions if source is None else source, employees)
    return left_lookup(transactions, lookup, "approved_by", "employee_id", "transaction_id")


def enrich_transactions(transactions: DataFrame, projects: DataFrame, employees: DataFrame) -> DataFrame:
    """Project, approver and derived columns; one output row per transaction."""
    dated = transactions.withColumn("transaction_date", parse_date(F.col("transaction_date")))
    joined = with_approver(with_project(dated, projects), employees, source=transactions)
    day = F.col("transaction_date")
    return joined.select(
        *[c for c in transactions.columns if c != "transaction_date"],
        "transaction_date",
        "project_name",
        "department",
        "approver_name",
        is_approved().alias("is_approved"),
        amount_aed().alias("amount_aed"),
        year_month(day).alias("transaction_year_month"),
    )


def unmatched_projects(transactions: DataFrame, projects: DataFrame) -> DataFrame:
    """Transactions without a project, counted per project id before the anti join."""
    per_project = transactions.groupBy("project_id").agg(F.count(F.lit(1)).alias("_rows"))
    missing = per_project.join(projects.select("project_id"), "project_id", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("unmatched_transactions"))


def replicate_transactions(transactions: DataFrame, copies: int) -> DataFrame:
    """copies copies of every row with distinct ids, for measuring at scale."""
    return transactions.withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    ).select(
        F.concat("transaction_id", F.lit("-R"), F.col("_copy").cast("string")).alias("transaction_id"),
        *[c for c in transactions.columns if c != "transaction_id"],
    )
