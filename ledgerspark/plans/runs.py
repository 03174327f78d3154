"""Whole runs: files in, tables out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.operators.employees import clean_employees, stage_salary_bands
from ledgerspark.operators.projects import clean_projects
from ledgerspark.operators.transactions import enrich_transactions
from ledgerspark.plans.events import (
    daily_event_volume,
    escalation_log,
    peak_usage_analysis,
    project_activity_summary,
    user_activity_summary,
    valid_events,
)
from ledgerspark.plans.quality import enforce_gate, log_failed_checks, run_all
from ledgerspark.plans.report import run_report
from ledgerspark.sources.files import read_employees, read_events, read_projects, read_transactions
from ledgerspark.sources.sinks import write_csv, write_parquet
from ledgerspark.staging import stage_table


def run_event_rollups(spark: SparkSession, events_folder: str, out: str) -> dict[str, int]:
    """The five rollups of a folder of event files; returns the rows written per table.

    The cleaned events are staged once and the rollups read only the columns
    they need from them.
    """
    events = stage_table(valid_events(read_events(spark, events_folder)), "valid-events")
    return {
        "project_activity_summary": write_parquet(
            project_activity_summary(events), "project_activity_summary", out
        ),
        "user_activity_summary": write_parquet(user_activity_summary(events), "user_activity_summary", out),
        "escalation_log": write_parquet(escalation_log(events), "escalation_log", out, partition_by="severity"),
        "daily_event_volume": write_parquet(
            daily_event_volume(events), "daily_event_volume", out, partition_by="event_date"
        ),
        "peak_usage_analysis": write_parquet(peak_usage_analysis(events), "peak_usage_analysis", out, small=True),
    }


def run_batch_etl(
    spark: SparkSession,
    projects_csv: str,
    employees_csv: str,
    transactions_json: str,
    out: str,
    as_of: dt.date,
    json_lines: bool = True,
) -> DataFrame:
    """Check, gate, clean, enrich, write; returns the run report.

    The checks see the raw text, so a date that does not parse is reported. The
    files are parsed once into staged tables, of which each check reads the
    columns it needs; the cleaned tables are staged too, then written as CSV.
    Transactions are JSON lines, which split; an array (json_lines=False) is
    read by one task per file.
    """
    read = {
        "projects": read_projects(spark, projects_csv),
        "employees": read_employees(spark, employees_csv),
        "transactions": read_transactions(spark, transactions_json, lines=json_lines),
    }
    raw = {name: stage_table(df, f"raw-{name}") for name, df in read.items()}
    checks = stage_table(run_all(raw, as_of), "dq-checks")
    log_failed_checks(checks)
    enforce_gate(checks)

    projects = stage_table(clean_projects(raw["projects"]), "clean-projects")
    employees = stage_table(
        clean_employees(raw["employees"], as_of, bands=stage_salary_bands(raw["employees"])), "clean-employees"
    )
    transactions = stage_table(
        enrich_transactions(raw["transactions"], projects, employees), "clean-transactions"
    )
    clean = {"projects": projects, "employees": employees, "transactions": transactions}
    files = {name: f"{out.rstrip('/')}/{name}_clean.csv" for name in clean}
    for name, df in clean.items():
        write_csv(df, files[name])
    return run_report(raw, clean, checks, files)
