"""Loading the star schema: write all tables, check what was written, publish only what holds.

A load writes a version of its own and never touches an older one. Publishing adds one empty file, whose name carries a
running number and the version; readers take the greatest. So they see a whole version, the old or the new one,
whatever happens to a load.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.plans import warehouse as wh
from ledgerspark.staging import COMPACT, stage_buckets, stage_table

VERSIONS, PUBLISHED, CHECKS = "versions", "published", "constraint_checks"


class BrokenConstraints(ValueError):
    """A written version that breaks constraints; it was removed."""


def write_star(
    clean_projects: DataFrame,
    clean_employees: DataFrame,
    history: DataFrame,
    transactions: DataFrame,
    folder: str,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """Write the star schema as Parquet below folder and read it back.

    Bridge and fact are built from the written dimensions, so every key is given once. The transactions are staged once
    for all tables, and what of the dimensions is looked up for the approvers, so that the planner sees its size. The files of bridge
    and fact are sorted by key, as the encoding leaves out what a value shares with the one before.
    """
    spark = transactions.sparkSession
    written: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> None:
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").options(**COMPACT).parquet(path)
        written[name] = spark.read.schema(df.schema).parquet(path)

    rows = wh.stage_transactions(transactions)
    put("dim_date", wh.dim_date_for(rows) if calendar is None else wh.build_dim_date(spark, *calendar))
    put("dim_project", wh.build_dim_project(clean_projects))
    put("dim_employee", wh.build_dim_employee(clean_employees, history))
    put("dim_vendor", wh.build_dim_vendor(rows))
    of_project = stage_buckets(wh.with_project_keys(rows, written["dim_project"]), "project-keys", "_block", in_order=["_row"])
    approvers = stage_table(wh.approvers_in_use(rows), "approvers")
    versions = stage_table(
        written["dim_employee"].select("employee_key", "employee_id", "valid_from", "valid_to", "is_current").join(approvers, "employee_id", "left_semi"),
        "approver-versions",
    )
    managers = wh.manager_pairs(written["dim_project"], written["dim_employee"])
    current = stage_table(versions.where("is_current").select("employee_key", "employee_id"), "current-approvers")
    bridge = wh.keyed_approver_pairs(rows, of_project, current).unionByName(managers)  # planned in the session of the rows
    put("bridge_employee_project", bridge.sortWithinPartitions("employee_key", "project_key"))
    fact = wh.keyed_fact(rows, of_project, written["dim_vendor"], versions)
    put("fact_transactions", fact.sortWithinPartitions("transaction_key"))
    return written


def version_violations(star: dict[str, DataFrame]) -> DataFrame:
    """The constraints of the tables, and those of the history: one current version, no overlap."""
    employees = star["dim_employee"]
    several = wh.several_current(employees).agg(F.coalesce(F.sum(F.col("current_count") - 1), F.lit(0)).alias("violations"))
    overlaps = wh.overlapping_versions(employees).agg(F.count(F.lit(1)).alias("violations"))
    checks = wh.constraint_violations(star)
    for name, rows in (("one current version per employee", several), ("versions do not overlap", overlaps)):
        checks = checks.unionByName(rows.select(F.lit("dim_employee").alias("table_name"), F.lit(name).alias("constraint_name"), "violations"))
    return checks


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, name: str) -> None:
    path, store = _path(spark, name)
    store.delete(path, True)


def _publications(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(number, version) of all publications, the latest last."""
    path, store = _path(spark, f"{out}/{PUBLISHED}")
    if not store.exists(path):
        return []
    names = [status.getPath().getName() for status in store.listStatus(path)]
    return sorted((int(number), version) for number, _, version in (n.partition("-") for n in names))


def published_version(spark: SparkSession, out: str) -> str | None:
    found = _publications(spark, out.rstrip("/"))
    return found[-1][1] if found else None


def read_warehouse(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the published version."""
    version = published_version(spark, out)
    if version is None:
        raise FileNotFoundError(f"nothing is published in {out}")
    return {name: spark.read.parquet(f"{out.rstrip('/')}/{VERSIONS}/{version}/{name}") for name in wh.CONSTRAINTS}


def run_warehouse(
    clean_projects: DataFrame,
    clean_employees: DataFrame,
    history: DataFrame,
    transactions: DataFrame,
    out: str,
    calendar: tuple[dt.date, dt.date] | None = None,
    keep: int = 2,
) -> DataFrame:
    """Load a version of the star schema and publish it if no constraint is broken; returns the checks, one row each.

    A version that breaks one is removed and named in the error; so is one that could not be written to the end. The
    published tables stay as they are then. After publishing, the latest keep versions remain.
    """
    spark, folder, version = transactions.sparkSession, out.rstrip("/"), uuid.uuid4().hex
    mine = f"{folder}/{VERSIONS}/{version}"
    try:
        star = write_star(clean_projects, clean_employees, history, transactions, mine, calendar)
        version_violations(star).write.parquet(f"{mine}/{CHECKS}")
        checks = spark.read.parquet(f"{mine}/{CHECKS}")
        broken = checks.where("violations > 0").orderBy("table_name", "constraint_name").collect()
        if broken:
            listed = "; ".join(f"{r.table_name}: {r.constraint_name} ({r.violations} rows)" for r in broken)
            raise BrokenConstraints(f"not published, constraints are broken: {listed}")
    except BaseException:
        _remove(spark, mine)
        raise
    before = _publications(spark, folder)
    path, store = _path(spark, f"{folder}/{PUBLISHED}/{(before[-1][0] if before else 0) + 1:010d}-{version}")
    store.create(path, False).close()
    for number, old in before[: max(0, len(before) + 1 - keep)]:
        _remove(spark, f"{folder}/{PUBLISHED}/{number:010d}-{old}")
        _remove(spark, f"{folder}/{VERSIONS}/{old}")
    return checks
