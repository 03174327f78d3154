"""What the physical plans must not contain."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators.transactions import enrich_transactions
from ledgerspark.plans import questions as qs
from ledgerspark.registry.queries import Inputs
from ledgerspark.plans.warehouse import NaturalKeyStar
from ledgerspark.staging import stage_table
from tests.helpers import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF)


@pytest.fixture(scope="module")
def loaded(inputs):
    return (
        stage_table(inputs.clean_projects, "p"), stage_table(inputs.clean_employees, "e"),
        stage_table(inputs.transactions, "t"),
    )


@pytest.fixture(scope="module")
def star(inputs, loaded):
    return NaturalKeyStar(loaded[0], lambda: loaded[1], inputs.history, loaded[2])


def read_columns(df):
    """Columns of the transactions that the scan reads."""
    scans = [line for line in plan(df).split("== Physical Plan ==")[1].splitlines() if "FileScan" in line]
    return {c.split("#")[0] for line in scans for c in line.split("[", 1)[1].split("]")[0].split(",")}


def test_scans_read_only_what_the_question_needs(star):
    assert read_columns(qs.open_issues(star.fact_transactions, star.dim_project)) == {
        "project_id", "payment_status", "amount", "project_name", "department", "status",
    }
    assert read_columns(qs.vendor_spend(star.fact_transactions, star.dim_vendor)) == {"vendor_id", "vendor_name", "amount"}


def test_filters_reach_the_scan(star, loaded):
    text = plan(qs.open_issues(star.fact_transactions, star.dim_project))
    assert "PushedFilters: [In(payment_status, [Disputed,Pending]), IsNotNull(project_id)]" in text
    rewritten = plan(qs.pending_above_average(*loaded))
    assert rewritten.count("EqualTo(payment_status,Pending)") >= 2


def test_no_cartesian_product_and_no_python(star, loaded):
    frames = [
        enrich_transactions(loaded[2], loaded[0], loaded[1]),
        qs.pending_above_average_sql(*loaded),
        qs.manager_workload(star.dim_project, star.dim_employee),
        qs.monthly_trend(star.fact_transactions, star.dim_date),
        qs.compensation_increases(star.dim_employee),
    ]
    for df in frames:
        physical = plan(df).split("== Physical Plan ==")[1]
        assert "CartesianProduct" not in physical and "EvalPython" not in physical and "InPandas" not in physical


def test_partial_aggregation_comes_before_every_shuffle_of_the_trend(star):
    physical = plan(qs.monthly_trend(star.fact_transactions, star.dim_date)).split("== Physical Plan ==")[1]
    assert physical.count("partial_sum") == 2


def test_a_large_lookup_leaves_plain_shuffles_on_both_sides(spark, loaded):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        physical = plan(enrich_transactions(loaded[2], loaded[0], loaded[1])).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert physical.count("SortMergeJoin") == 2 and "Broadcast" not in physical
    # the shape that adaptive execution can split: join over sort over exchange, twice per join
    assert physical.count("hashpartitioning(_spread_key") == 2 and physical.count("hashpartitioning(_lookup_key") == 2


def test_a_hot_key_is_split_by_adaptive_execution(spark):
    from ledgerspark.operators.joins import left_lookup

    facts = spark.range(300_000).select(
        F.col("id").alias("t"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("x" * 50).alias("pad"),
    )
    lookup = spark.range(1000).select(F.col("id").cast("string").alias("k2"), F.lit("v").alias("v")).unionByName(
        spark.createDataFrame([("hot", "h")], "k2 string, v string")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = left_lookup(facts, lookup, "k", "k2", "t")
        assert joined.where("v = 'h'").count() == 100_000
        joined.collect()
        final = plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final


def test_the_run_report_has_the_checks_once(spark):
    from ledgerspark.plans.report import run_report

    checks = spark.createDataFrame([("d", "c1", "PASS"), ("d", "c2", "FAIL"), ("d", "c3", "FAIL")], "dataset string, check_name string, status string")
    checks = checks.where("check_name <> 'marker'")
    report = run_report({"d": spark.range(3)}, {"d": spark.range(2)}, checks)
    assert report._jdf.queryExecution().optimizedPlan().toString().count("marker") == 1
    assert sorted(tuple(r) for r in report.collect()) == [
        ("d", "checks_failed", "2"), ("d", "checks_passed", "1"), ("d", "clean_rows", "2"), ("d", "raw_rows", "3"),
    ]
