"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from ledgerspark.operators.transactions import enrich_transactions, replicate_transactions
from ledgerspark.plans import events as ev, questions as qs
from ledgerspark.registry.queries import REGISTRY, Inputs
from ledgerspark.session import build_session
from ledgerspark.staging import stage_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
SLOW_QUERY_ROWS = 2_000_000

HEADLINE = [
    "q_projects_clean", "q_employees_clean", "q_transactions_enriched", "q_dim_employee", "q_bridge", "q_fact",
    "q1_dept_budget", "q2_manager_workload", "q3_vendor_concentration", "q4_open_issues", "q5_monthly_trend",
    "q6_comp_increase", "q_project_activity", "q_user_activity", "q_escalation_log", "q_daily_volume",
    "q_peak_usage", "dq_run", "st_summary", "g_retention",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(run: Callable[[], None]) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "20g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    consume(spark.range(1000).groupBy("id").count())

    inputs = Inputs(spark, SF_DIR)
    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = best(lambda: consume(REGISTRY[name](spark, SF_DIR)))

    # event run: clean once, five rollups from the cleaned table
    def event_run() -> None:
        events = stage_table(Inputs(spark, SF_DIR).valid_events, "bench-events")
        for rollup in (
            ev.project_activity_summary, ev.user_activity_summary, ev.escalation_log, ev.daily_event_volume,
            ev.peak_usage_analysis,
        ):
            consume(rollup(events))

    times["event_run"] = best(event_run)

    # transactions ETL and slow question on loaded tables, as the published numbers are
    projects = stage_table(inputs.clean_projects, "bench-projects")
    employees = stage_table(inputs.clean_employees, "bench-employees")
    # the test table is one file; a feed comes in several, here one per core
    transactions = stage_table(inputs.transactions.repartition(int(CPUS)), "bench-transactions")
    times["transactions_etl_loaded"] = best(
        lambda: consume(enrich_transactions(transactions, projects, employees))
    )
    copies = max(1, -(-SLOW_QUERY_ROWS // transactions.count()))
    many = stage_table(replicate_transactions(transactions, copies), "bench-many")
    times["slow_original_2m_rows"] = best(
        lambda: consume(qs.pending_above_average_sql(projects, employees, many))
    )
    times["slow_rewritten_2m_rows"] = best(lambda: consume(qs.pending_above_average(projects, employees, many)))

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, best of runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
