from decimal import Decimal

import pytest

from ledgerspark.operators.joins import duplicate_keys, key_profile
from ledgerspark.operators.transactions import enrich_transactions, replicate_transactions, unmatched_projects
from tests.helpers import by, employees, plan, projects, transactions


@pytest.fixture(scope="module")
def feed(spark):
    return transactions(
        spark,
        {"transaction_id": "t1", "project_id": "p1", "approved_by": "e1", "amount": Decimal("1.50")},
        {"transaction_id": "t2", "project_id": "nowhere", "approved_by": None, "amount": None},
        {"transaction_id": "t3", "project_id": None, "approved_by": "ghost", "transaction_date": "soon"},
    )


def test_every_transaction_stays_once(spark, feed):
    got = by(
        enrich_transactions(
            feed, projects(spark, {"project_id": "p1"}, {"project_id": None}), employees(spark, {"employee_id": "e1"})
        ),
        "transaction_id", "department", "approver_name", "is_approved", "amount", "amount_aed",
        "transaction_year_month",
    )
    assert got == {
        "t1": ("IT", "A B", True, Decimal("1.50"), 1.5, "2020-01"),
        "t2": (None, None, False, None, 0.0, "2020-01"),
        "t3": (None, None, True, None, 0.0, None),
    }


def test_a_repeated_key_fails_the_join(spark, feed):
    twice = projects(spark, {"project_id": "p1"}, {"project_id": "p1"})
    enriched = enrich_transactions(feed, twice, employees(spark, {"employee_id": "e1"}))
    with pytest.raises(Exception, match="duplicate project_id, the join would fan out: p1"):
        enriched.collect()
    assert by(duplicate_keys(twice, "project_id"), "project_id", "copies") == {"p1": 2}
    assert key_profile(twice, "project_id", "projects").first()[2:] == (2, 1, 1)


def test_unmatched_projects(spark, feed):
    assert unmatched_projects(feed, projects(spark, {"project_id": "p1"})).first()[0] == 2


def test_null_keys_are_spread_over_partitions(spark):
    from pyspark.sql import functions as F

    from ledgerspark.operators.joins import left_lookup

    facts = spark.range(4000).select(
        F.col("id").alias("t"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k")
    )
    lookup = spark.range(2000).select(F.col("id").cast("string").alias("k2"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_lookup(facts, lookup, "k", "k2", "t")
        sizes = joined.where("k is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1000
    assert joined.count() == 4000 and joined.where("v is not null").count() == 1000


def test_replication(spark, feed):
    ids = [r.transaction_id for r in replicate_transactions(feed, 3).collect()]
    assert len(set(ids)) == 9 and "t1-R0" in ids and "t3-R2" in ids


def test_approvers_are_few_and_checked(spark, feed):
    from ledgerspark.operators.transactions import approver_names

    staff = employees(spark, {"employee_id": "e1"}, {"employee_id": "e2"}, {"employee_id": None})
    assert by(approver_names(feed, staff), "employee_id", "approver_name") == {"e1": "A B"}
    twice = employees(spark, {"employee_id": "e1"}, {"employee_id": "e2"}, {"employee_id": "e2"})
    with pytest.raises(Exception, match="duplicate employee_id, the join would fan out: e2"):
        enrich_transactions(feed, projects(spark, {"project_id": "p1"}), twice).collect()


def test_transactions_are_shuffled_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerspark.staging import stage_table

    many = spark.range(200_000)
    facts = stage_table(
        transactions(spark, {}).drop("transaction_id", "project_id", "approved_by").crossJoin(many)
        .selectExpr("*", "cast(id as string) as transaction_id", "concat('p', id) as project_id", "concat('e', id % 50) as approved_by").drop("id"),
        "test-facts",
    )
    people = stage_table(employees(spark, {}).drop("employee_id", "full_name").crossJoin(many).selectExpr(
        "*", "concat('e', id) as employee_id", "concat('name ', sha2(string(id), 256)) as full_name").drop("id"), "test-people")
    works = stage_table(projects(spark, {}).drop("project_id").crossJoin(many).selectExpr("*", "concat('p', id) as project_id").drop("id"), "test-works")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        enriched = enrich_transactions(facts, works, people)
        text = plan(enriched).split("== Physical Plan ==")[1]
        assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 1
        assert "_spread_key" not in text and "_fact_key" not in text
        assert enriched.where(F.col("approver_name").isNotNull() & F.col("project_name").isNotNull()).count() == 200_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
