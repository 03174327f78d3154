"""Every operator as a named query over one folder of test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspark.functions.dates import parse_date, year_month
from ledgerspark.operators import employees as emp, projects as prj, transactions as trx
from ledgerspark.operators.joins import duplicate_keys, key_profile
from ledgerspark.operators.ordering import add_dense_key, add_group_rank
from ledgerspark.operators.reshape import null_counts
from ledgerspark.plans import events as ev, governance as gov, load, quality as dq, questions as qs, warehouse as wh
from ledgerspark.plans.report import run_report
from ledgerspark.sources import files, sinks
from ledgerspark.sources.testdata import TestData
from ledgerspark.staging import stage_table, staged_path
from ledgerspark.streaming import events as st

AS_OF = dt.date(2026, 9, 16)
# the test tables have no termination date: five years after hiring, for inactive employees
EMPLOYED_MONTHS = 60

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """The same values in types that every engine prints alike."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Inputs:
    """Raw and derived entities of one folder, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.data = TestData(spark, folder)

    @property
    def projects(self) -> DataFrame:
        return self.data.projects

    @property
    def employees(self) -> DataFrame:
        return self.data.employees

    @property
    def history(self) -> DataFrame:
        return self.data.salary_history

    @property
    def transactions(self) -> DataFrame:
        return self.data.transactions

    @property
    def events(self) -> DataFrame:
        return self.data.events

    @cached_property
    def clean_projects(self) -> DataFrame:
        return prj.clean_projects(self.projects)

    @cached_property
    def clean_employees(self) -> DataFrame:
        return emp.clean_employees(self.employees, AS_OF)

    @cached_property
    def star(self) -> wh.Star:
        return wh.NaturalKeyStar(
            self.clean_projects, lambda: self.clean_employees, self.history, self.transactions
        )

    @cached_property
    def keyed_star(self) -> wh.Star:
        return wh.Star(self.clean_projects, lambda: self.clean_employees, self.history, self.transactions)

    @cached_property
    def valid_events(self) -> DataFrame:
        return ev.valid_events(self.events)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        """The three checked datasets, staged: the mapping joins run once, the checks read columns."""
        return {
            "projects": stage_table(self.projects, "raw-projects"),
            "employees": stage_table(self.employees, "raw-employees"),
            "transactions": stage_table(self.transactions, "raw-transactions"),
        }

    def path(self, label: str) -> str:
        return staged_path(self.spark, label)

    @property
    def event_lines(self) -> DataFrame:
        """The events as JSON text lines."""
        written = self.events.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        return written.select(F.to_json(F.struct("*")).alias("value"))

    def message_stream(self) -> DataFrame:
        folder = self.path("messages")
        self.event_lines.write.text(folder)
        return files.read_event_stream(self.spark, "text", path=folder)


#: The key of the checked query only; real ones come from the session's settings.
MASK_KEY = b"key of the checked query"
REGISTRY: dict[str, Query] = {}
ALIASES: dict[str, str] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a builder under its own name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Inputs(spark, folder)))

    REGISTRY[build.__name__] = run
    return build


def also(name: str, target: str) -> None:
    """The operator `name` is the query `target`."""
    REGISTRY[name] = REGISTRY[target]
    ALIASES[name] = target


# --- scans, sources, sinks --------------------------------------------------


@query
def src_projects(x: Inputs) -> DataFrame:
    path = x.path("projects-csv")
    sinks.write_csv(x.projects, path)
    loaded = files.read_projects(x.spark, path)
    return loaded.select(
        "project_id",
        "status",
        parse_date(F.col("start_date")).alias("start_date"),
        parse_date(F.col("end_date")).alias("end_date"),
        "budget",
        "actual_cost",
        prj.budget_variance().alias("budget_variance"),
        prj.is_over_budget().alias("is_over_budget"),
        prj.duration_days().alias("duration_days"),
    )


@query
def src_employees(x: Inputs) -> DataFrame:
    path = x.path("employees-csv")
    sinks.write_csv(x.employees, path)
    return files.read_employees(x.spark, path)


@query
def src_transactions(x: Inputs) -> DataFrame:
    path = x.path("transactions-json")
    sinks.write_jsonl(x.transactions, path)
    loaded = files.read_transactions(x.spark, path, lines=True)
    return loaded.withColumn("transaction_date", parse_date(F.col("transaction_date")))


@query
def src_history(x: Inputs) -> DataFrame:
    path = x.path("history-csv")
    sinks.write_csv(x.history, path)
    return files.read_salary_history(x.spark, path)


def flat_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "event_type",
        "project_id",
        "user_id",
        "timestamp",
        F.col("payload")["severity"].alias("severity"),
        F.col("payload")["resolved_by"].alias("resolved_by"),
    )


@query
def src_events(x: Inputs) -> DataFrame:
    path = x.path("events-jsonl")
    x.event_lines.write.text(path)
    return flat_events(files.read_events(x.spark, path, "part-*"))


@query
def gen_dim_date(x: Inputs) -> DataFrame:
    return wh.dim_date_for(x.transactions)


also("q_dim_date", "gen_dim_date")


@query
def src_event_stream(x: Inputs) -> DataFrame:
    out = x.path("decoded")
    st.drain(
        st.decode_events(x.message_stream()),
        x.path("source-progress"),
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"),
    )
    return flat_events(x.spark.read.option("recursiveFileLookup", True).parquet(out))


@query
def snk_event_stream(x: Inputs) -> DataFrame:
    out = x.path("published")
    st.write_messages(st.stamp_events(x.message_stream()), out, x.path("publish-progress"))
    published = x.spark.read.schema("key string, value string").json(out)
    return published.select(
        "key",
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.produced_at").isNotNull().alias("stamped"),
    )


def rich_lines(x: Inputs) -> DataFrame:
    """Event lines with members that no schema names: nested, numeric and null ones; every fiftieth is cut short."""
    number = F.substring("event_id", 4, 20).cast("bigint")
    known = F.to_json(F.struct("event_id", "event_type", "project_id", "user_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))
    extra = F.to_json(F.struct((number / 4).alias("amount"), F.array(number, F.lit(None)).alias("steps")))
    line = F.concat(F.expr("left(known, length(known) - 1)"), F.lit(',"nothing":null,"extra":'), "extra", F.lit("}"))
    cut = F.when(number % 50 == 7, F.substring(line, 1, 40)).otherwise(line)
    return x.events.withColumns({"known": known, "extra": extra}).select(cut.alias("value"))


def published(x: Inputs) -> str:
    """The folder with what a run over the lines has published and set aside."""
    folder, out = x.path("rich-messages"), x.path("rich-published")
    rich_lines(x).write.text(folder)
    st.publish_events(files.read_event_stream(x.spark, "text", path=folder), out, x.path("rich-progress"))
    return out


@query
def st_stamp(x: Inputs) -> DataFrame:
    """The whole value of every published message, but for the moment."""
    event = F.expr("parse_json(value)").alias("event")
    rows = st.read_messages(x.spark, f"{published(x)}/published").select("key", event)
    return rows.select(
        "key",
        *[F.expr(f"variant_get(event, '$.{c}', 'string')").alias(c) for c in ("event_id", "event_type", "project_id", "user_id", "timestamp")],
        F.expr("variant_get(event, '$.extra.amount', 'double')").alias("amount"),
        F.expr("variant_get(event, '$.extra.steps[0]', 'bigint')").alias("first_step"),
        F.expr("is_variant_null(variant_get(event, '$.extra.steps[1]', 'variant'))").alias("null_step"),
        F.expr("is_variant_null(variant_get(event, '$.nothing', 'variant'))").alias("null_member"),
        F.expr("variant_get(event, '$.produced_at', 'string') is not null").alias("stamped"),
    )


@query
def st_malformed(x: Inputs) -> DataFrame:
    letters = st.read_messages(x.spark, f"{published(x)}/dead_letters", st.DEAD_SCHEMA)
    return letters.select(F.regexp_extract("value", "EVT[0-9]+", 0).alias("event_id"), "reason")


@query
def snk_csv(x: Inputs) -> DataFrame:
    path = x.path("clean-csv")
    sinks.write_csv(x.clean_projects, path)
    return x.spark.read.schema(x.clean_projects.schema).option("header", True).csv(path)


@query
def snk_parquet(x: Inputs) -> DataFrame:
    folder = x.path("parquet")
    rows = sinks.write_parquet(
        ev.daily_event_volume(x.valid_events), "daily_event_volume", folder, partition_by="event_date"
    )
    table = x.spark.read.parquet(f"{folder}/daily_event_volume")
    return table.select("event_date", "event_type", "event_count", "cumulative_count", F.lit(rows).alias("rows_written"))


@query
def snk_staging(x: Inputs) -> DataFrame:
    return stage_table(x.clean_projects, "hand-off").select("project_id", "status_category", "risk_level")


# --- projects ---------------------------------------------------------------


@query
def p_budget_variance(x: Inputs) -> DataFrame:
    return x.projects.select("project_id", prj.budget_variance().alias("budget_variance"))


@query
def p_is_over_budget(x: Inputs) -> DataFrame:
    return x.projects.select("project_id", prj.is_over_budget().alias("is_over_budget"))


@query
def p_duration_days(x: Inputs) -> DataFrame:
    return x.projects.select("project_id", prj.duration_days().alias("duration_days"))


@query
def p_status_clean(x: Inputs) -> DataFrame:
    return x.projects.select("project_id", prj.clean_status().alias("status"))


@query
def p_status_category(x: Inputs) -> DataFrame:
    return x.projects.select("project_id", prj.status_category(prj.clean_status()).alias("status_category"))


@query
def p_budget_utilisation(x: Inputs) -> DataFrame:
    return x.projects.select("project_id", F.round(prj.budget_utilisation(), 6).alias("budget_utilisation_pct"))


@query
def p_zero_fill(x: Inputs) -> DataFrame:
    return x.projects.select(
        "project_id", prj.zero_filled("budget").alias("budget"), prj.zero_filled("actual_cost").alias("actual_cost")
    )


@query
def p_risk_level(x: Inputs) -> DataFrame:
    level = prj.risk_level(prj.is_over_budget(), prj.budget_utilisation())
    return x.projects.select("project_id", level.alias("risk_level"))


@query
def q_projects_clean(x: Inputs) -> DataFrame:
    return x.clean_projects.withColumn("budget_utilisation_pct", F.round("budget_utilisation_pct", 6))


@query
def r_risk_distribution(x: Inputs) -> DataFrame:
    return prj.risk_distribution(x.clean_projects)


# --- employees --------------------------------------------------------------


@query
def e_missing_email(x: Inputs) -> DataFrame:
    return x.employees.select("employee_id", emp.filled_email().alias("email"))


@query
def e_fill_unknown(x: Inputs) -> DataFrame:
    return x.employees.select("employee_id", *[emp.known_or_unknown(c).alias(c) for c in emp.REQUIRED_TEXT])


@query
def e_invalid_hire_date(x: Inputs) -> DataFrame:
    return x.employees.where(emp.hire_date_invalid()).select("employee_id", "hire_date")


@query
def e_implausible_hire_date(x: Inputs) -> DataFrame:
    return x.employees.where(emp.hire_date_implausible(AS_OF)).select("employee_id", "hire_date")


@query
def e_impute_hire_date(x: Inputs) -> DataFrame:
    median = emp.median_hire_date(x.employees, AS_OF)
    return x.employees.crossJoin(F.broadcast(median)).select(
        "employee_id", F.coalesce(emp.usable_hire_date(AS_OF), F.col("median_hire_date")).alias("hire_date")
    )


@query
def e_clamp_experience(x: Inputs) -> DataFrame:
    return x.employees.select("employee_id", emp.clamped_experience().alias("years_experience"))


@query
def e_salary_band(x: Inputs) -> DataFrame:
    return emp.with_salary_band(x.employees, emp.stage_salary_bands(x.employees)).select(
        "employee_id", emp.salary_outside_band().alias("outside_band"), emp.capped_salary().alias("salary")
    )


@query
def e_self_manager(x: Inputs) -> DataFrame:
    return x.employees.select("employee_id", emp.manager_without_self().alias("manager_id"))


@query
def e_quality_summary(x: Inputs) -> DataFrame:
    return emp.employee_fix_counts(x.employees, AS_OF, emp.stage_salary_bands(x.employees))


@query
def q_employees_clean(x: Inputs) -> DataFrame:
    return emp.clean_employees(x.employees, AS_OF, bands=emp.stage_salary_bands(x.employees))


@query
def e_inactive_conflict(x: Inputs) -> DataFrame:
    return emp.inactive_conflicts(x.employees, AS_OF)


# --- transactions and events, row level -------------------------------------


@query
def t_is_approved(x: Inputs) -> DataFrame:
    return x.transactions.select("transaction_id", trx.is_approved().alias("is_approved"))


@query
def t_amount_aed(x: Inputs) -> DataFrame:
    return x.transactions.select("transaction_id", "amount", trx.amount_aed().alias("amount_aed"))


@query
def t_year_month(x: Inputs) -> DataFrame:
    month = year_month(parse_date(F.col("transaction_date")))
    return x.transactions.select("transaction_id", month.alias("transaction_year_month"))


@query
def v_drop_null_keys(x: Inputs) -> DataFrame:
    return ev.with_required_ids(x.events).select("event_id", "user_id", "event_type")


def event_copies(x: Inputs) -> DataFrame:
    """Each event and a copy one hour later, which the deduplication has to drop."""
    late = x.events.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 hour"))
    return late.unionByName(x.events)


@query
def v_dedup_first(x: Inputs) -> DataFrame:
    return flat_events(ev.first_occurrences(event_copies(x)))


also("w_dedup", "v_dedup_first")


@query
def v_counts(x: Inputs) -> DataFrame:
    return ev.validation_counts(event_copies(x))


@query
def v_date_parts(x: Inputs) -> DataFrame:
    return ev.with_date_parts(x.events).select("event_id", "event_date", "event_hour", "event_month")


@query
def v_project_filter(x: Inputs) -> DataFrame:
    return x.events.where(F.col("project_id").isNotNull()).select("event_id", "project_id")


@query
def filter_predicates(x: Inputs) -> DataFrame:
    """IN, NOT IN, a disjunction and a comparison with a scalar subquery."""
    average = x.clean_projects.agg(F.avg(F.col("budget").cast("double")).alias("_average"))
    return (
        x.clean_projects.crossJoin(F.broadcast(average))
        .where(
            F.col("status").isin("In Progress", "On Hold")
            & ~F.col("priority").isin("Low")
            & ((F.col("budget") > F.col("_average")) | F.col("is_over_budget"))
        )
        .select("project_id", "status", "priority", "budget")
    )


# --- joins ------------------------------------------------------------------


@query
def j_enrich_project(x: Inputs) -> DataFrame:
    return trx.with_project(x.transactions, x.clean_projects).select("transaction_id", "project_name", "department")


@query
def j_enrich_approver(x: Inputs) -> DataFrame:
    return trx.with_approver(x.transactions, x.clean_employees).select("transaction_id", "approver_name")


@query
def j_unique_key_guard(x: Inputs) -> DataFrame:
    return (
        key_profile(x.projects, "project_id", "projects")
        .unionByName(key_profile(x.employees, "employee_id", "employees"))
        .unionByName(key_profile(x.history, "employee_id", "employees_salary_history"))
    )


@query
def j_refused_keys(x: Inputs) -> DataFrame:
    """The keys at which a lookup in the history would fail, as it would fan out."""
    return duplicate_keys(x.history, "employee_id")


@query
def t_unmatched_projects(x: Inputs) -> DataFrame:
    """Of transactions and events together: all transactions have a project, some events name none."""
    rows = x.transactions.select("project_id").unionByName(x.events.select("project_id"))
    return trx.unmatched_projects(rows, x.clean_projects)


@query
def q_transactions_enriched(x: Inputs) -> DataFrame:
    return trx.enrich_transactions(x.transactions, x.clean_projects, x.clean_employees)


@query
def j_inner_equi(x: Inputs) -> DataFrame:
    return wh.employee_versions(x.clean_employees, x.history).select(
        "employee_id", "valid_from", "full_name", "email", "department"
    )


@query
def j_anti_not_exists(x: Inputs) -> DataFrame:
    return wh.no_history_versions(x.clean_employees, x.history).select("employee_id")


@query
def j_point_in_time(x: Inputs) -> DataFrame:
    dated = x.transactions.withColumn("transaction_day", parse_date(F.col("transaction_date")))
    return wh.at_version(dated, x.star.dim_employee).select(
        "transaction_id", "approved_by", F.col("employee_key").alias("employee_version")
    )


@query
def j_star(x: Inputs) -> DataFrame:
    return wh.fact_rows(
        x.transactions, x.star.dim_project, x.star.dim_vendor, x.star.dim_employee
    ).select("transaction_id", "project_key", "vendor_key", "employee_key", "date_key")


@query
def j_overlap(x: Inputs) -> DataFrame:
    """Versions prolonged by 30 days, so that neighbours overlap."""
    longer = x.star.dim_employee.withColumn(
        "valid_to", F.when(F.col("is_current"), F.col("valid_to")).otherwise(F.date_add("valid_to", 30))
    )
    return wh.overlapping_versions(longer)


@query
def j_adjacent(x: Inputs) -> DataFrame:
    return qs.adjacent_versions(x.star.dim_employee).select(
        "employee_id", F.col("valid_from").alias("change_date"), "previous_salary", "new_salary"
    )


@query
def j_fifo_pair(x: Inputs) -> DataFrame:
    return ev.escalation_log(x.valid_events).where("resolved").select(
        "event_id", "project_id", "resolved_by", "resolved_at"
    )


@query
def j_cross_scalar(x: Inputs) -> DataFrame:
    pending = x.transactions.where(F.col("payment_status") == "Pending")
    return (
        pending.crossJoin(F.broadcast(qs.pending_average(x.transactions)))
        .where(F.col("amount") > F.col("avg_pending_amount"))
        .select("transaction_id", "amount")
    )


@query
def j_comma(x: Inputs) -> DataFrame:
    rows = qs.pending_above_average_sql(x.clean_projects, x.clean_employees, x.transactions)
    return rows.groupBy("department", "status").agg(
        F.count(F.lit(1)).alias("transactions"), qs.money_sum("amount").alias("amount")
    )


@query
def j_bridge_manager(x: Inputs) -> DataFrame:
    people = x.star.dim_employee.withColumn("employee_key", F.col("employee_id"))
    return wh.manager_pairs(x.star.dim_project, people)


@query
def j_bridge_approver(x: Inputs) -> DataFrame:
    people = x.star.dim_employee.withColumn("employee_key", F.col("employee_id"))
    return wh.approver_pairs(x.transactions, x.star.dim_project, people)


@query
def j_lookup_map(x: Inputs) -> DataFrame:
    return x.clean_projects.groupBy("status", "status_category").agg(F.count(F.lit(1)).alias("projects"))


@query
def j_fk_orphans(x: Inputs) -> DataFrame:
    found = dq.measure_orphans(
        x.employees, "manager_id", "employees", "employee_id", x.employees, ["EMP0000"]
    )
    rows = dq.judge(found, "employees")
    return rows.select("target", "metric")


# --- aggregations -----------------------------------------------------------


@query
def q_project_activity(x: Inputs) -> DataFrame:
    return ev.project_activity_summary(x.valid_events)


@query
def q_user_activity(x: Inputs) -> DataFrame:
    return ev.user_activity_summary(x.valid_events)


@query
def q_daily_volume(x: Inputs) -> DataFrame:
    return ev.daily_event_volume(x.valid_events)


@query
def q_peak_usage(x: Inputs) -> DataFrame:
    return ev.peak_usage_analysis(x.valid_events)


also("a_project_activity", "q_project_activity")
also("a_user_activity", "q_user_activity")
also("a_daily_volume", "q_daily_volume")
also("w_cumulative_count", "q_daily_volume")
also("a_peak_usage", "q_peak_usage")
also("s_top20_hours", "q_peak_usage")


@query
def a_vendor_spend(x: Inputs) -> DataFrame:
    spend = qs.vendor_spend(x.star.fact_transactions, x.star.dim_vendor)
    return spend.withColumn("percentage_of_total_spend", F.round("percentage_of_total_spend", 6))


also("w_share_of_total", "a_vendor_spend")


@query
def a_monthly_spend(x: Inputs) -> DataFrame:
    return qs.monthly_spend(x.star.fact_transactions, x.star.dim_date)


@query
def a_scalar_avg(x: Inputs) -> DataFrame:
    return qs.pending_average(x.transactions).select(F.round("avg_pending_amount", 4).alias("avg_pending_amount"))


@query
def a_level_quantiles(x: Inputs) -> DataFrame:
    return emp.salary_bands(x.employees)


@query
def a_global_median(x: Inputs) -> DataFrame:
    return emp.median_hire_date(x.employees, AS_OF)


@query
def a_null_counts(x: Inputs) -> DataFrame:
    return null_counts(x.employees)


@query
def a_top_share(x: Inputs) -> DataFrame:
    shares = dq.top_shares(x.projects, ["status", "department", "priority", "region"])
    return shares.withColumn("top_share", F.round("top_share", 6))


@query
def a_zscore(x: Inputs) -> DataFrame:
    """Amounts further than 1.5 deviations from the mean."""
    spread = dq.with_spread(x.transactions, ["amount"])
    distance = F.abs(F.col("amount").cast("double") - F.col("_mean_amount")) / F.col("_dev_amount")
    return spread.where(distance > 1.5).select("transaction_id", "amount")


@query
def a_event_type_counts(x: Inputs) -> DataFrame:
    return st.type_counts(x.events)


@query
def a_conditional_sum(x: Inputs) -> DataFrame:
    return x.events.groupBy("project_id").agg(
        F.sum(F.when(F.col("event_type") == ev.RAISED, 1).otherwise(0)).alias("escalation_count")
    )


@query
def a_distinct_conditional(x: Inputs) -> DataFrame:
    return x.events.groupBy("user_id").agg(
        F.count_distinct(F.when(F.col("project_id").isNotNull(), F.col("project_id"))).alias("projects_touched")
    )


# --- windows, top-k, set operations -----------------------------------------


@query
def w_surrogate_key(x: Inputs) -> DataFrame:
    return add_dense_key(x.transactions.select("transaction_id"), ["transaction_id"], "transaction_key")


@query
def w_fifo_seq(x: Inputs) -> DataFrame:
    steps = x.valid_events.where(F.col("event_type").isin(ev.RAISED, ev.RESOLVED)).select(
        "event_id", "event_type", "project_id", "timestamp"
    )
    return add_group_rank(steps, ["project_id", "event_type"], ["timestamp", "event_id"], "seq").drop("timestamp")


@query
def w_lead_valid_to(x: Inputs) -> DataFrame:
    return wh.history_versions(x.history).select("employee_id", "valid_from", "valid_to", "is_current")


@query
def w_lag_mom(x: Inputs) -> DataFrame:
    return qs.monthly_trend(x.star.fact_transactions, x.star.dim_date).select(
        "category", "year_month", "month_over_month_pct_change"
    )


@query
def w_running_total(x: Inputs) -> DataFrame:
    return qs.monthly_trend(x.star.fact_transactions, x.star.dim_date).select(
        "category", "year_month", "running_total"
    )


@query
def u_union_all(x: Inputs) -> DataFrame:
    return wh.history_versions(x.history).unionByName(wh.no_history_versions(x.clean_employees, x.history)).select(
        "employee_id", "role", "level", "salary", "change_reason", "valid_from", "valid_to"
    )


@query
def u_distinct(x: Inputs) -> DataFrame:
    return wh.vendor_attributes(x.transactions)


@query
def u_replicate(x: Inputs) -> DataFrame:
    copies = trx.replicate_transactions(x.transactions, 3)
    return copies.groupBy("payment_status", F.substring_index("transaction_id", "-", -1).alias("copy")).agg(
        F.count(F.lit(1)).alias("transactions"), qs.money_sum("amount").alias("amount")
    )


# --- streaming --------------------------------------------------------------


@query
def st_type_counts(x: Inputs) -> DataFrame:
    table = x.path("type-counts")
    st.drain(st.type_counts(x.data.event_stream()), x.path("counts-progress"), st.overwrite_into(table), "complete")
    return x.spark.read.parquet(table)


@query
def st_forward_critical(x: Inputs) -> DataFrame:
    """What the forwarding query of a run, the second one beside counting, has sent to its own sink."""
    out = x.path("critical")
    st.run_event_stream(x.spark, x.data.event_stream(), out, x.path("critical-progress"), "platform-events")
    forwarded = x.spark.read.schema(st.MESSAGE_SCHEMA).json(f"{out}/forwarded")
    return forwarded.select(
        F.col("key").alias("project_id"),
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.payload.severity").alias("severity"),
    )


@query
def st_summary(x: Inputs) -> DataFrame:
    out = x.path("stream-run")
    st.run_event_stream(x.spark, x.data.event_stream(), out, x.path("run-progress"), "platform-events")
    return st.stream_metrics(x.spark, out)


@query
def snk_stream_summary(x: Inputs) -> DataFrame:
    """The written summary of a second run over an old folder: even event numbers came first, then odd ones."""
    folder, out, progress = x.path("growing-messages"), x.path("growing-run"), x.path("growing-progress")
    odd = F.substring("event_id", 4, 20).cast("bigint") % 2 == 1
    for late in (False, True):
        new = x.events.where(odd if late else ~odd).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        new.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(folder)
        events = st.decode_events(files.read_event_stream(x.spark, "text", path=folder))
        st.run_event_stream(x.spark, events, out, progress, "platform-events")
    return st.stream_metrics(x.spark, out)


@query
def st_bounded_run(x: Inputs) -> DataFrame:
    """Everything that is there is read, then the stream ends by itself."""
    out = x.path("bounded")
    st.drain(
        x.data.event_stream().select("event_id"),
        x.path("bounded-progress"),
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"),
    )
    rows = x.spark.read.option("recursiveFileLookup", True).parquet(out)
    return rows.agg(F.count(F.lit(1)).alias("events_read"), F.count_distinct("event_id").alias("event_ids"))


@query
def st_dedup_first(x: Inputs) -> DataFrame:
    out = x.path("deduplicated")
    st.drain(
        st.first_arrivals(x.data.event_stream()),
        x.path("dedup-progress"),
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"),
    )
    return x.spark.read.option("recursiveFileLookup", True).parquet(out).select("event_id", "user_id", "event_type")


@query
def st_daily_volume(x: Inputs) -> DataFrame:
    table = x.path("daily-volume")
    st.drain(st.daily_volume(x.data.event_stream()), x.path("daily-progress"), st.overwrite_into(table), "complete")
    return x.spark.read.parquet(table)


# --- data quality -----------------------------------------------------------


def one_check(x: Inputs, check: str, *rules: str, settings: dict | None = None) -> DataFrame:
    """One check over the datasets that configure it, with its own rules only."""
    frames = {"projects": x.projects, "employees": x.employees, "transactions": x.transactions}
    result = None
    for name, df in frames.items():
        if rules and rules[0] not in dq.DQ_CONFIG[name]:
            continue
        config = {"completeness_threshold": dq.DQ_CONFIG[name]["completeness_threshold"], "pk_columns": []}
        config |= {rule: dq.DQ_CONFIG[name][rule] for rule in rules if rule in dq.DQ_CONFIG[name]}
        rows = dq.run_data_quality_checks(df, name, config | (settings or {}), AS_OF, frames)
        rows = rows.where((F.col("check_name") == check) & F.col("target").isNotNull())
        result = rows if result is None else result.unionByName(rows)
    return result.select("dataset", "target", "status", "metric", "detail")


@query
def dq_completeness(x: Inputs) -> DataFrame:
    return one_check(x, "completeness").drop("detail")


@query
def dq_uniqueness(x: Inputs) -> DataFrame:
    return one_check(x, "uniqueness", "pk_columns")


@query
def dq_validity_numeric(x: Inputs) -> DataFrame:
    return one_check(x, "validity_numeric", "numeric_ranges")


@query
def dq_validity_date(x: Inputs) -> DataFrame:
    return one_check(x, "validity_date", "date_columns")


@query
def dq_consistency(x: Inputs) -> DataFrame:
    return one_check(x, "consistency", "consistency_rules")


@query
def dq_consistency_before(x: Inputs) -> DataFrame:
    return one_check(x, "consistency", "consistency_rules").where(F.col("target").contains("<"))


@query
def dq_consistency_non_negative(x: Inputs) -> DataFrame:
    return one_check(x, "consistency", "consistency_rules").where(~F.col("target").rlike("[<~]"))


@query
def dq_consistency_salary_level(x: Inputs) -> DataFrame:
    return one_check(x, "consistency", "consistency_rules").where(F.col("target").contains("~"))


@query
def dq_referential(x: Inputs) -> DataFrame:
    return one_check(x, "referential_integrity", "foreign_keys", "foreign_key_sentinels")


@query
def dq_distribution(x: Inputs) -> DataFrame:
    return one_check(x, "distribution", "distribution_check_columns")


@query
def dq_freshness(x: Inputs) -> DataFrame:
    return one_check(x, "freshness", "freshness_check")


@query
def dq_outliers(x: Inputs) -> DataFrame:
    return one_check(x, "outliers", "outlier_check_columns")


@query
def dq_outliers_iqr(x: Inputs) -> DataFrame:
    return one_check(x, "outliers", "outlier_check_columns", settings={"outlier_mode": "iqr"})


@query
def dq_outliers_log(x: Inputs) -> DataFrame:
    return one_check(x, "outliers", "outlier_check_columns", settings={"outlier_mode": "log"})


@query
def dq_distribution_relative(x: Inputs) -> DataFrame:
    return one_check(x, "distribution", "distribution_check_columns", settings={"relative_share_limit": True})


also("a_completeness", "dq_completeness")
also("a_distinct_count", "dq_uniqueness")


@query
def dq_run(x: Inputs) -> DataFrame:
    results = dq.check_results(dq.run_all(x.raw, AS_OF))
    return results.select("dataset", "check_name", "status", "failed_columns")


@query
def dq_summary(x: Inputs) -> DataFrame:
    return dq.dataset_summary(dq.run_all(x.raw, AS_OF))


@query
def dq_gate(x: Inputs) -> DataFrame:
    checks = stage_table(dq.run_all(x.raw, AS_OF), "gate-checks")
    dq.enforce_gate(checks)
    return dq.gate_status(checks)


@query
def r_run_report(x: Inputs) -> DataFrame:
    """The cleaned tables come from the staged raw ones, as in a run over files."""
    projects = prj.clean_projects(x.raw["projects"])
    employees = emp.clean_employees(x.raw["employees"], AS_OF)
    clean = {
        "projects": projects,
        "employees": employees,
        "transactions": trx.enrich_transactions(x.raw["transactions"], projects, employees),
    }
    return run_report(x.raw, clean, dq.run_all(x.raw, AS_OF))


# --- warehouse --------------------------------------------------------------


@query
def q_dim_project(x: Inputs) -> DataFrame:
    return x.keyed_star.dim_project


@query
def q_dim_vendor(x: Inputs) -> DataFrame:
    return x.keyed_star.dim_vendor


@query
def q_scd2_history(x: Inputs) -> DataFrame:
    return wh.history_versions(x.history)


@query
def q_scd2_no_history(x: Inputs) -> DataFrame:
    return wh.no_history_versions(x.clean_employees, x.history)


@query
def q_dim_employee(x: Inputs) -> DataFrame:
    return x.keyed_star.dim_employee


@query
def q_bridge(x: Inputs) -> DataFrame:
    return x.keyed_star.bridge_employee_project


@query
def q_fact(x: Inputs) -> DataFrame:
    return x.keyed_star.fact_transactions


@query
def q_val_one_current(x: Inputs) -> DataFrame:
    return wh.several_current(x.star.dim_employee)


@query
def q_val_version_counts(x: Inputs) -> DataFrame:
    return wh.version_counts(x.star.dim_employee)


also("a_version_count", "q_val_version_counts")
also("s_top10_versions", "q_val_version_counts")


@query
def q_val_overlap(x: Inputs) -> DataFrame:
    return wh.overlapping_versions(x.star.dim_employee)


@query
def w9_constraints(x: Inputs) -> DataFrame:
    """All tables are written by the load, then checked as they were read back."""
    return wh.constraint_violations(load.write_star(x.clean_projects, x.clean_employees, x.history, x.transactions, x.path("warehouse")))


@query
def w9_published(x: Inputs) -> DataFrame:
    """Rows of every table that a checked load has published."""
    out = x.path("published-warehouse")
    load.run_warehouse(x.clean_projects, x.clean_employees, x.history, x.transactions, out)
    tables = load.read_warehouse(x.spark, out).items()
    counts = [df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(name).alias("table_name"), "table_rows") for name, df in tables]
    return reduce(DataFrame.unionByName, counts)


# --- business questions and marts -------------------------------------------


@query
def q1_dept_budget(x: Inputs) -> DataFrame:
    return qs.dept_budget(x.star.dim_project)


@query
def q2_manager_workload(x: Inputs) -> DataFrame:
    return qs.manager_workload(x.star.dim_project, x.star.dim_employee)


@query
def q3_vendor_concentration(x: Inputs) -> DataFrame:
    return qs.vendor_concentration(x.star.fact_transactions, x.star.dim_vendor)


@query
def q4_open_issues(x: Inputs) -> DataFrame:
    return qs.open_issues(x.star.fact_transactions, x.star.dim_project)


@query
def q5_monthly_trend(x: Inputs) -> DataFrame:
    return qs.monthly_trend(x.star.fact_transactions, x.star.dim_date)


@query
def q6_comp_increase(x: Inputs) -> DataFrame:
    return qs.compensation_increases(x.star.dim_employee)


@query
def q_slow_original(x: Inputs) -> DataFrame:
    return qs.pending_above_average_sql(x.clean_projects, x.clean_employees, x.transactions)


@query
def q_slow_rewritten(x: Inputs) -> DataFrame:
    return qs.pending_above_average(x.clean_projects, x.clean_employees, x.transactions)


@query
def q_issue_rate(x: Inputs) -> DataFrame:
    disputed = x.transactions.where(F.col("payment_status") == "Disputed").select("project_id")
    issues = ev.escalated_projects(x.events).unionByName(disputed)
    return qs.issue_rate(x.clean_projects, issues)


@query
def q_manager_load_gt1(x: Inputs) -> DataFrame:
    return qs.manager_workload(x.star.dim_project, x.star.dim_employee, ("In Progress",), 1)


@query
def q_vendor_gt30(x: Inputs) -> DataFrame:
    return qs.vendor_concentration(x.star.fact_transactions, x.star.dim_vendor, 30.0)


@query
def q_trend_12m(x: Inputs) -> DataFrame:
    return qs.monthly_trend(x.star.fact_transactions, x.star.dim_date, last_months=12)


@query
def q_escalation_log(x: Inputs) -> DataFrame:
    log = ev.escalation_log(x.valid_events)
    return log.withColumn("resolution_time_hours", F.round("resolution_time_hours", 6))


@query
def q_escalation_log_causal(x: Inputs) -> DataFrame:
    log = ev.escalation_log(x.valid_events, causal=True)
    return log.withColumn("resolution_time_hours", F.round("resolution_time_hours", 6))


@query
def m_kpi_cards(x: Inputs) -> DataFrame:
    return qs.kpi_cards(x.star.dim_project, x.star.fact_transactions)


@query
def m_dept_bar(x: Inputs) -> DataFrame:
    return qs.department_totals(x.star.dim_project).orderBy("department")


@query
def m_top_variance(x: Inputs) -> DataFrame:
    return qs.top_variance(x.clean_projects)


@query
def m_vendor_donut(x: Inputs) -> DataFrame:
    return qs.vendor_donut(x.star.fact_transactions, x.star.dim_vendor)


@query
def m_slicers(x: Inputs) -> DataFrame:
    projects, facts = qs.sliced(
        x.star.dim_project, x.star.fact_transactions, x.star.dim_date,
        regions=["ASIA", "EUROPE"], statuses=["In Progress"], years=[1997, 1998],
    )
    return qs.kpi_cards(projects, facts)


also("a_dept_budget", "q1_dept_budget")
also("a_manager_load", "q2_manager_workload")
also("a_open_value", "q4_open_issues")
also("m_trend_line", "a_monthly_spend")
also("s_order_by", "m_dept_bar")
also("s_top20_increase", "q6_comp_increase")
also("s_top10_variance", "m_top_variance")
also("s_top5_other", "m_vendor_donut")


# --- governance -------------------------------------------------------------


@query
def g_classification(x: Inputs) -> DataFrame:
    return gov.classification(
        {
            "projects": x.clean_projects,
            "employees": x.employees,
            "transactions": x.transactions,
            "employees_salary_history": x.history,
        }
    )


@query
def g_mask_view(x: Inputs) -> DataFrame:
    return gov.mask_view(x.clean_employees, "employees", "BI Analyst", key=MASK_KEY)


@query
def g_salary_aggregate(x: Inputs) -> DataFrame:
    return gov.salary_by_department(x.clean_employees)


def terminations(x: Inputs) -> DataFrame:
    ended = F.when(F.col("status") == "Inactive", F.add_months("hire_date", EMPLOYED_MONTHS))
    return x.clean_employees.withColumn("termination_date", ended)


@query
def g_retention(x: Inputs) -> DataFrame:
    people = terminations(x)
    history = x.history.join(people.select("employee_id", "termination_date"), "employee_id", "left")
    closed = F.when(F.col("status_category") == "Closed", F.col("end_date"))
    ended = F.col("termination_date")
    return gov.retention_counts(
        {
            "projects": gov.with_retention(x.clean_projects, "projects", closed, AS_OF),
            "employees": gov.with_retention(people, "employees", ended, AS_OF),
            "transactions": gov.with_retention(
                x.transactions, "transactions", parse_date(F.col("transaction_date")), AS_OF
            ),
            "employees_salary_history": gov.with_retention(history, "employees_salary_history", ended, AS_OF),
        }
    )


@query
def g_anonymise(x: Inputs) -> DataFrame:
    hidden = gov.anonymise(terminations(x), F.col("termination_date"), AS_OF)
    return hidden.select("employee_id", "full_name", "email", "department", "level", "salary", "anonymised")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
