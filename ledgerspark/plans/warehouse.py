"""Star schema with a history-keeping employee dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerspark.functions.dates import OPEN_END, date_key, parse_date
from ledgerspark.operators.joins import left_lookup, one_row_per_key
from ledgerspark.operators.ordering import add_dense_key, add_group_rank, add_sum_before
from ledgerspark.operators.reshape import metric_rows
from ledgerspark.staging import bucket_count, session_of_parts, stage_buckets, stage_table

CALENDAR_START = dt.date(2000, 1, 1)
CALENDAR_END = dt.date(2027, 12, 31)
FIRST_REASON = "Initial appointment"

_STATE = ["salary", "role", "level", "change_reason"]


# --- dimensions -------------------------------------------------------------


def date_attributes(days: DataFrame) -> DataFrame:
    """Calendar columns for a frame with one full_date column."""
    day = F.col("full_date")
    weekday = F.extract(F.lit("dayofweek_iso"), day)
    return days.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).cast("bigint").alias("week"),
        F.day(day).cast("bigint").alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def build_dim_date(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return date_attributes(days)


def dim_date_for(transactions: DataFrame) -> DataFrame:
    """The calendar from the first to the last transaction day in the data."""
    day = parse_date(F.col("transaction_date"))
    span = transactions.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    days = span.where(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day")).alias("full_date")
    )
    return date_attributes(days)


def project_attributes(clean_projects: DataFrame) -> DataFrame:
    return clean_projects.select(
        "project_id", "project_name", "department", "status", "status_category", "priority", "region",
        "project_manager_id", "start_date", "end_date",
        F.col("budget").cast("decimal(14,2)").alias("budget"),
        F.col("actual_cost").cast("decimal(14,2)").alias("actual_cost"),
        "risk_level",
    )


def build_dim_project(clean_projects: DataFrame) -> DataFrame:
    return add_dense_key(project_attributes(clean_projects), ["project_id"], "project_key")


def vendor_attributes(transactions: DataFrame) -> DataFrame:
    return transactions.select("vendor_id", "vendor_name").distinct()


def build_dim_vendor(transactions: DataFrame) -> DataFrame:
    return add_dense_key(vendor_attributes(transactions), ["vendor_id", "vendor_name"], "vendor_key")


# --- employee versions ------------------------------------------------------


_NO_DAY = -(1 << 31)  # a day number that no date has


def history_states(history: DataFrame, partitions: int | None = None) -> DataFrame:
    """The changes in the form of versions; equal ones are one row with their number.

    Employee and day are in _who and _when, which are never null, so that joins on them keep to their partitions.
    With a number of partitions the changes are dealt to them by both, and stay there.
    """
    rows = history.select(
        F.coalesce(F.concat(F.lit("="), "employee_id"), F.lit("")).alias("_who"),
        F.coalesce(F.unix_date("effective_date"), F.lit(_NO_DAY)).alias("_when"),
        F.col("new_salary").cast("decimal(18,4)").alias("salary"),
        F.col("new_role").alias("role"),
        F.col("new_level").alias("level"),
        "change_reason",
    )
    dealt = rows if partitions is None else rows.repartition(partitions, "_who", "_when")
    return dealt.groupBy("_who", "_when", *_STATE).agg(F.count(F.lit(1)).alias("_copies"))


def history_versions(history: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """One version per history row, valid until the employee's next change.

    The next change is looked up between the change dates of an employee, at
    most one row per calendar day however long the history is. Of several rows
    on one day the last one, by their values, carries on; the others get a
    version of zero length. states are those of history, staged in buckets by
    _who and _when: read three times here, and only days without values leave
    their buckets for the look-up.
    """
    per_employee = Window.partitionBy("_who").orderBy("_when")
    next_day = F.date_from_unix_date(F.lead("_when").over(per_employee)).alias("_next_day")
    if states is None:
        states = history_states(history)
        days = states.groupBy("_who", "_when").agg(F.max(F.struct(*_STATE)).alias("_last")).select("*", next_day)
    else:
        following = states.select("_who", "_when").distinct().select("_who", "_when", next_day)
        last = states.groupBy("_who", "_when").agg(F.max(F.struct(*_STATE)).alias("_last"))
        days = last.join(following, ["_who", "_when"])
    valid_from = F.when(F.col("_when") != _NO_DAY, F.date_from_unix_date("_when"))
    carries_on = F.struct(*_STATE).eqNullSafe(F.col("_last")) & (F.col("_copy") == F.col("_copies"))
    return (
        states.join(days, ["_who", "_when"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
        .select(
            F.when(F.col("_who") != "", F.substring("_who", 2, (1 << 31) - 1)).alias("employee_id"),
            *_STATE,
            valid_from.alias("valid_from"),
            F.when(carries_on, F.coalesce("_next_day", F.lit(OPEN_END).cast("date")))
            .otherwise(valid_from)
            .alias("valid_to"),
            (carries_on & F.col("_next_day").isNull()).alias("is_current"),
        )
    )


def no_history_versions(clean_employees: DataFrame, history: DataFrame) -> DataFrame:
    """A single open version for employees that the history never mentions."""
    known = history.select("employee_id").distinct()
    return clean_employees.join(known, "employee_id", "left_anti").select(
        "employee_id",
        "salary",
        "role",
        "level",
        F.lit(FIRST_REASON).alias("change_reason"),
        F.col("hire_date").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def employee_versions(clean_employees: DataFrame, history: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """All versions with the attributes that have no history of their own."""
    versions = history_versions(history, states).unionByName(no_history_versions(clean_employees, history))
    current = clean_employees.select(
        "employee_id", "full_name", "email", "department", "manager_id", "region", "status"
    )
    return versions.join(current, "employee_id").select(
        "employee_id", "full_name", "email", "department", "role", "level",
        F.col("salary").cast("decimal(12,2)").alias("salary"),
        "manager_id", "region", "status", "change_reason", "valid_from", "valid_to", "is_current",
    )


VERSION_ORDER = ["employee_id", "valid_from", "valid_to", "salary", "role", "level", "change_reason"]


def build_dim_employee(clean_employees: DataFrame, history: DataFrame) -> DataFrame:
    """The states are staged: what makes the history, its one shuffle and its grouping run once for all uses."""
    dealt = history_states(history, bucket_count(history.sparkSession))
    states = stage_buckets(dealt, "history-states", "_who", "_when", in_order=True)
    return add_dense_key(employee_versions(clean_employees, history, states), VERSION_ORDER, "employee_key")


# --- keys without the dimensions --------------------------------------------


def project_keys(clean_projects: DataFrame) -> DataFrame:
    """(project_id, project_key) as in the project dimension, from the ids alone."""
    return add_dense_key(clean_projects.select("project_id"), ["project_id"], "project_key")


def first_employee_keys(clean_employees: DataFrame, history: DataFrame) -> DataFrame:
    """(employee_id, _before): the number of versions of all employees that come earlier in the employee dimension.

    Every change is one version, an employee without changes has one, and each is there as often as the employee.
    """
    people = clean_employees.where(F.col("employee_id").isNotNull()).groupBy("employee_id").agg(F.count(F.lit(1)).alias("_people"))
    changes = history.groupBy("employee_id").agg(F.count(F.lit(1)).alias("_changes"))
    sizes = people.join(changes, "employee_id", "left").select(
        "employee_id", (F.col("_people") * F.coalesce("_changes", "_people")).alias("_versions")
    )
    return add_sum_before(sizes, ["employee_id"], "_versions", "_before").drop("_versions")


def version_keys(clean_employees: DataFrame, history: DataFrame, wanted: DataFrame) -> DataFrame:
    """The columns of the employee dimension that a lookup reads, for the employees in wanted (employee_id, distinct).

    The key of a version is the number of versions of earlier employees plus its rank among its own employee's, so the
    versions of other employees are counted and never built. The wanted employees are staged: they are read twice, and
    what cleans them is not part of a plan that the driver holds with all else.
    """
    wanted = stage_table(wanted, "wanted-employees")
    past = stage_table(history.join(wanted, "employee_id", "left_semi"), "wanted-history")
    people = stage_table(clean_employees.join(wanted, "employee_id", "left_semi"), "wanted-people")
    versions = employee_versions(people, past)
    columns = ["employee_id", "valid_from", "valid_to"]
    ranked = add_group_rank(versions.select(*VERSION_ORDER), ["employee_id"], VERSION_ORDER[1:], "_rank", keep=columns)
    before = first_employee_keys(clean_employees, history).join(wanted, "employee_id", "left_semi")
    keyed = ranked.join(before, "employee_id").select((F.col("_before") + F.col("_rank")).alias("employee_key"), *columns)
    return stage_table(keyed, "version-keys")


# --- bridge and fact --------------------------------------------------------


def manager_pairs(dim_project: DataFrame, dim_employee: DataFrame) -> DataFrame:
    current = dim_employee.where("is_current").select("employee_key", F.col("employee_id").alias("project_manager_id"))
    return dim_project.join(current, "project_manager_id").select(
        "employee_key", "project_key", F.lit("Manager").alias("project_role")
    )


def approver_pairs(transactions: DataFrame, dim_project: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Distinct pairs first, so the joins see one row per pair."""
    pairs = (
        transactions.where(F.col("approved_by").isNotNull())
        .select("project_id", F.col("approved_by").alias("employee_id"))
        .distinct()
    )
    current = dim_employee.where("is_current").select("employee_key", "employee_id")
    return (
        pairs.join(dim_project.select("project_key", "project_id"), "project_id")
        .join(current, "employee_id")
        .select("employee_key", "project_key", F.lit("Approver").alias("project_role"))
    )


def approvers_in_use(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("approved_by").isNotNull()).select(F.col("approved_by").alias("employee_id")).distinct()


def keyed_approver_pairs(rows: DataFrame, of_project: DataFrame, current: DataFrame) -> DataFrame:
    """As approver_pairs, from staged transactions, their with_project_keys and the current versions of their approvers.

    The pairs of keys are made distinct last, as two numbers: a key stands for one row of its dimension.
    """
    approved = rows.where(F.col("approved_by").isNotNull()).select(*ROW, "approved_by").join(of_project, ROW)
    pairs = approved.join(current, F.col("approved_by") == F.col("employee_id")).select("employee_key", "project_key")
    return pairs.distinct().withColumn("project_role", F.lit("Approver"))


def build_bridge(transactions: DataFrame, dim_project: DataFrame, dim_employee: DataFrame) -> DataFrame:
    return manager_pairs(dim_project, dim_employee).unionByName(
        approver_pairs(transactions, dim_project, dim_employee)
    )


def at_version(transactions: DataFrame, dim_employee: DataFrame, spread_by: str = "transaction_id") -> DataFrame:
    """employee_key of the approver's version on the transaction day, null if none.

    Equality on the approver with the validity range as residual condition;
    a version holds from valid_from up to, not including, valid_to.
    """
    versions = dim_employee.select("employee_key", F.col("employee_id").alias("_employee"), "valid_from", "valid_to")
    day = F.col("transaction_day")
    valid = (day >= F.col("valid_from")) & (day < F.col("valid_to"))
    return left_lookup(
        transactions, versions, "approved_by", "_employee", spread_by, also=valid
    ).drop("valid_from", "valid_to")


FACT_INPUT = [
    "transaction_id", "project_id", "vendor_id", "approved_by", "transaction_date", "amount", "currency", "category",
    "payment_status", "invoice_ref",
]


def fact_rows(
    transactions: DataFrame, dim_project: DataFrame, dim_vendor: DataFrame, dim_employee: DataFrame
) -> DataFrame:
    """Three left lookups per transaction; a key column of the input is carried along.

    A project or vendor id that repeats in its dimension fails the job, as it would multiply transactions.
    """
    own_key = [c for c in transactions.columns if c == "transaction_key"]
    dated = transactions.withColumn("transaction_day", parse_date(F.col("transaction_date")))
    projects = one_row_per_key(dim_project, "project_id", ["project_key"]).withColumnRenamed("project_id", "_project")
    vendors = one_row_per_key(dim_vendor, "vendor_id", ["vendor_key"]).withColumnRenamed("vendor_id", "_vendor")
    with_project = left_lookup(dated, projects, "project_id", "_project", "transaction_id")
    with_vendor = left_lookup(with_project, vendors, "vendor_id", "_vendor", "transaction_id")
    return at_version(with_vendor, dim_employee).select(
        *own_key,
        "transaction_id",
        "project_key",
        "employee_key",
        "vendor_key",
        date_key(F.col("transaction_day")).alias("date_key"),
        F.col("amount").cast("decimal(14,2)").alias("amount"),
        "currency",
        "category",
        "payment_status",
        "invoice_ref",
    )


# A staged transaction: its own number, and the block of 2 ** BLOCK_BITS numbers that it is in.
ROW = ["_block", "_row"]
BLOCK_BITS = 16


def in_blocks(df: DataFrame) -> DataFrame:
    """df with the _block of its _row."""
    return df.withColumn("_block", F.shiftright("_row", BLOCK_BITS))


def beside_rows(df: DataFrame) -> DataFrame:
    """df, which has a _row, dealt as the staged transactions lie: in a join of them with it on ROW, they are not shuffled."""
    return in_blocks(df).repartition(bucket_count(df.sparkSession), "_block")


def stage_transactions(transactions: DataFrame) -> DataFrame:
    """What the star reads of the transactions, each row under a number of its own in _row, in buckets by its _block.

    Numbers run on inside a task, so a task writes a file for each block of rows, and not for each bucket: the driver lists
    the files for every read, and their number goes with the rows alone.
    """
    numbered = transactions.select(F.monotonically_increasing_id().alias("_row"), *FACT_INPUT, "vendor_name")
    return stage_buckets(in_blocks(numbered), "transactions", "_block", reader=session_of_parts(transactions.sparkSession))


def with_project_keys(rows: DataFrame, dim_project: DataFrame) -> DataFrame:
    """ROW and project_key of the staged transactions with a known project, beside them; a repeated project id fails."""
    projects = one_row_per_key(dim_project, "project_id", ["project_key"])
    return beside_rows(rows.select("_row", "project_id").join(projects, "project_id").select("_row", "project_key"))


def keyed_fact(rows: DataFrame, of_project: DataFrame, dim_vendor: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """The fact of staged transactions; of_project is as with_project_keys has it.

    The order of the ids decides the key. Keys are given and looked up on (_row, what is looked up), rows without it
    left out, and come back as (_row, key): the staged rows with all their columns are not shuffled for it. Repeated
    vendor ids fail the job as in fact_rows; vendors are few, and broadcast by size.
    """
    day = parse_date(F.col("transaction_date"))
    numbered = add_dense_key(rows.select("_row", "transaction_id"), ["transaction_id"], "transaction_key", keep=["_row"])
    vendors = one_row_per_key(dim_vendor, "vendor_id", ["vendor_key"]).withColumnRenamed("vendor_id", "_vendor")
    approved = rows.where(F.col("approved_by").isNotNull()).select("_row", "approved_by", day.alias("transaction_day"))
    of_version = at_version(approved, dim_employee, spread_by="_row").where(F.col("employee_key").isNotNull())
    return (
        left_lookup(rows, vendors, "vendor_id", "_vendor", "transaction_id")
        .join(beside_rows(numbered), ROW)
        .join(of_project.select(*ROW, "project_key"), ROW, "left")
        .join(beside_rows(of_version.select("_row", "employee_key")), ROW, "left")
        .select(
            "transaction_key",
            "transaction_id",
            "project_key",
            "employee_key",
            "vendor_key",
            date_key(day).alias("date_key"),
            F.col("amount").cast("decimal(14,2)").alias("amount"),
            "currency",
            "category",
            "payment_status",
            "invoice_ref",
        )
    )


def build_fact(
    transactions: DataFrame, dim_project: DataFrame, dim_vendor: DataFrame, dim_employee: DataFrame
) -> DataFrame:
    rows = stage_transactions(transactions)
    return keyed_fact(rows, with_project_keys(rows, dim_project), dim_vendor, dim_employee)


# --- validation -------------------------------------------------------------


def several_current(dim_employee: DataFrame) -> DataFrame:
    """Employees with more than one current version; none in a sound dimension."""
    return (
        dim_employee.where("is_current")
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("current_count"))
        .where(F.col("current_count") > 1)
    )


def version_counts(dim_employee: DataFrame, top: int = 10) -> DataFrame:
    return (
        dim_employee.groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("version_count"))
        .orderBy(F.col("version_count").desc(), "employee_id")
        .limit(top)
    )


def overlapping_versions(dim_employee: DataFrame) -> DataFrame:
    """Pairs of versions of one employee whose validity overlaps.

    Start days are checked first, at most one row per employee and calendar
    day: a day takes part in an overlap only if an earlier version ends after
    it, a later one starts before its own versions end, or several versions
    that last start on it. A sound dimension leaves no day, hence no pair.
    """
    by_day = Window.partitionBy("employee_id").orderBy("valid_from")
    earlier_end = F.max("_end").over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    days = (
        dim_employee.groupBy("employee_id", "valid_from")
        .agg(
            F.max("valid_to").alias("_end"),
            F.count_if(F.col("valid_to") > F.col("valid_from")).alias("_lasting"),
        )
        .withColumn("_earlier_end", earlier_end)
        .withColumn("_later_start", F.lead("valid_from").over(by_day))
        .where(
            (F.col("valid_from") < F.col("_earlier_end"))
            | (F.col("_later_start") < F.col("_end"))
            | (F.col("_lasting") > 1)
        )
        .select("employee_id", "valid_from")
    )
    suspects = dim_employee.select("employee_id", "employee_key", "valid_from", "valid_to").join(
        days, ["employee_id", "valid_from"], "left_semi"
    )
    a, b = suspects.alias("a"), suspects.alias("b")
    overlap = (
        (F.col("a.employee_id") == F.col("b.employee_id"))
        & (F.col("a.employee_key") < F.col("b.employee_key"))
        & (F.col("a.valid_from") < F.col("b.valid_to"))
        & (F.col("b.valid_from") < F.col("a.valid_to"))
    )
    return a.join(b, overlap).select(
        F.col("a.employee_id").alias("employee_id"),
        F.col("a.employee_key").alias("version_a"),
        F.col("a.valid_from").alias("a_valid_from"),
        F.col("a.valid_to").alias("a_valid_to"),
        F.col("b.employee_key").alias("version_b"),
        F.col("b.valid_from").alias("b_valid_from"),
        F.col("b.valid_to").alias("b_valid_to"),
    )


# --- constraints ------------------------------------------------------------

# Keys, mandatory columns and references of the star schema.
CONSTRAINTS = {
    "dim_date": {
        "unique": [["date_key"], ["full_date"]],
        "not_null": [
            "date_key", "full_date", "year", "quarter", "month", "month_name", "week", "day", "day_of_week",
            "is_weekend",
        ],
    },
    "dim_project": {"unique": [["project_key"], ["project_id"]], "not_null": ["project_key", "project_id"]},
    "dim_employee": {
        "unique": [["employee_key"]],
        "not_null": ["employee_key", "employee_id", "valid_from", "valid_to", "is_current"],
    },
    "dim_vendor": {"unique": [["vendor_key"], ["vendor_id"]], "not_null": ["vendor_key", "vendor_id"]},
    "bridge_employee_project": {
        "unique": [["employee_key", "project_key", "project_role"]],
        "not_null": ["employee_key", "project_key", "project_role"],
        "references": {
            "employee_key": ("dim_employee", "employee_key"),
            "project_key": ("dim_project", "project_key"),
        },
    },
    "fact_transactions": {
        "unique": [["transaction_key"], ["transaction_id"]],
        "not_null": ["transaction_key", "transaction_id"],
        "references": {
            "project_key": ("dim_project", "project_key"),
            "employee_key": ("dim_employee", "employee_key"),
            "vendor_key": ("dim_vendor", "vendor_key"),
            "date_key": ("dim_date", "date_key"),
        },
    },
}


def _is_whole(df: DataFrame) -> bool:
    """One column of whole numbers."""
    return len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.IntegralType)


def _bitmaps(df: DataFrame, column: str) -> DataFrame:
    """Per range of 32,768 numbers in _range, the rows of a column without nulls and a bitmap of its values."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("_bits")
    return df.groupBy(F.bitmap_bucket_number(column).alias("_range")).agg(F.count(F.lit(1)).alias("_rows"), bits)


def _unique_violations(table: DataFrame, columns: list[str]) -> DataFrame:
    """Rows beyond the first of each key; keys with a null are left to NOT NULL.

    Text is counted by 48 bits of its hash first, and the hashes that repeat are staged: they are none or few in a sound
    table, and only rows with one of them are counted by the text itself. Of a whole number, bitmaps of the values are made.
    """
    keyed = table.select(*columns).dropna()
    if _is_whole(keyed):
        return _bitmaps(keyed, *columns).agg(F.coalesce(F.sum(F.col("_rows") - F.bitmap_count("_bits")), F.lit(0)).alias("violations"))
    if any(isinstance(field.dataType, T.StringType) for field in keyed.schema):
        hashed = F.shiftrightunsigned(F.xxhash64(*columns), 16).alias("_hash")
        counted = keyed.groupBy(hashed).agg(F.count(F.lit(1)).alias("_copies"))
        repeated = stage_table(counted.where(F.col("_copies") > 1).select("_hash"), "repeated-hashes")
        keyed = keyed.withColumn("_hash", hashed).join(repeated, "_hash", "left_semi")
    copies = keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("violations"))


def _orphan_rows(table: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose value the target does not have.

    Whole numbers are compared by bitmaps first, and the ranges with a value that the target lacks are staged: they are none
    in a sound table, and only rows and targets in one of them are looked up.
    """
    users, targets = table.select(column).dropna(), target.select(F.col(target_column).alias(column)).dropna()
    if _is_whole(users) and _is_whole(targets):
        both = _bitmaps(users, column).select("_range", "_bits", F.lit(False).alias("_known")).unionByName(
            _bitmaps(targets, column).select("_range", "_bits", F.lit(True).alias("_known"))
        )
        known = F.max(F.when(F.col("_known"), F.col("_bits"))).alias("_target")
        merged = both.groupBy("_range").agg(F.bitmap_or_agg("_bits").alias("_all"), known)
        lacking = F.col("_target").isNull() | (F.bitmap_count("_all") > F.bitmap_count("_target"))
        ranges = stage_table(merged.where(lacking).select("_range"), "orphan-ranges")
        number = F.bitmap_bucket_number(column)
        users, targets = (df.withColumn("_range", number).join(ranges, "_range", "left_semi") for df in (users, targets))
    used = users.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = used.join(targets.select(column), column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("violations"))


def constraint_violations(star: dict[str, DataFrame], constraints: dict = CONSTRAINTS) -> DataFrame:
    """One row per constraint of the star schema with the number of rows breaking it."""
    checks = []
    for table, rules in constraints.items():
        found = []
        for columns in rules.get("unique", []):
            found.append((f"unique({', '.join(columns)})", _unique_violations(star[table], columns)))
        for column, (target, target_column) in rules.get("references", {}).items():
            orphans = _orphan_rows(star[table], column, star[target], target_column)
            found.append((f"{column} references {target}", orphans))
        nulls = metric_rows(
            star[table],
            {f"not null({c})": F.count_if(F.col(c).isNull()) for c in rules.get("not_null", [])},
            "constraint_name",
            "violations",
        )
        checks.append(nulls.select(F.lit(table).alias("table_name"), "constraint_name", "violations"))
        for name, rows in found:
            checks.append(
                rows.select(F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"), "violations")
            )
    result = checks[0]
    for rows in checks[1:]:
        result = result.unionByName(rows)
    return result


# --- whole star -------------------------------------------------------------


class Star:
    """The tables of the star schema with their surrogate keys, each built on first use.

    Without a calendar range the date dimension spans the transactions, which
    takes a pass over them.
    """

    def __init__(
        self,
        clean_projects: DataFrame,
        clean_employees: Callable[[], DataFrame],
        history: DataFrame,
        transactions: DataFrame,
        calendar: tuple[dt.date, dt.date] | None = None,
    ) -> None:
        self._calendar = calendar
        self._projects = clean_projects
        self._employees = clean_employees
        self._history = history
        self._transactions = transactions

    @cached_property
    def dim_date(self) -> DataFrame:
        if self._calendar is None:
            return dim_date_for(self._transactions)
        return build_dim_date(self._transactions.sparkSession, *self._calendar)

    @cached_property
    def dim_project(self) -> DataFrame:
        return build_dim_project(self._projects)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return build_dim_employee(self._employees(), self._history)

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return build_dim_vendor(self._transactions)

    @cached_property
    def bridge_employee_project(self) -> DataFrame:
        return build_bridge(self._transactions, self.dim_project, self.dim_employee)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        """Looked up in keys of the ids and of the approvers' versions; the other columns of the dimensions are not built."""
        rows = stage_transactions(self._transactions)
        of_project = with_project_keys(rows, project_keys(self._projects))
        versions = version_keys(self._employees(), self._history, approvers_in_use(rows))
        vendors = stage_table(build_dim_vendor(rows), "vendor-keys")  # so that the planner sees their size
        return keyed_fact(rows, of_project, vendors, versions)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in CONSTRAINTS}


class NaturalKeyStar(Star):
    """The same tables joined on the source ids, for questions that need no stored keys.

    The ids determine the surrogate keys one to one, so the answers are equal;
    a transaction with an unknown id keeps that id and matches no dimension row.
    """

    @cached_property
    def dim_project(self) -> DataFrame:
        return project_attributes(self._projects).withColumn("project_key", F.col("project_id"))

    @cached_property
    def dim_employee(self) -> DataFrame:
        version = F.concat_ws("@", "employee_id", F.col("valid_from").cast("string"))
        return employee_versions(self._employees(), self._history).withColumn("employee_key", version)

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return vendor_attributes(self._transactions).withColumn("vendor_key", F.col("vendor_id"))

    @cached_property
    def fact_transactions(self) -> DataFrame:
        dated = self._transactions.withColumn("_day", parse_date(F.col("transaction_date")))
        return dated.select(
            "transaction_id",
            F.col("project_id").alias("project_key"),
            F.col("vendor_id").alias("vendor_key"),
            date_key(F.col("_day")).alias("date_key"),
            F.col("amount").cast("decimal(14,2)").alias("amount"),
            "currency", "category", "payment_status", "invoice_ref",
        )
