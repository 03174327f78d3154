"""The test tables mapped onto the entities (see FIXTURES.md).

The expressions are shared with the check SQL, which repeats them as CTEs.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Schemas of the tables read here; given, so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

PROJECT_COLUMNS = {
    "project_id": "concat('PRJ', cast(o_orderkey as string))",
    "project_name": "concat('Project ', cast(o_orderkey as string))",
    "department": "c_mktsegment",
    "status": "case when o_orderstatus='F' then 'Completed' when o_orderstatus='O' then case when o_orderkey%7=0 "
    "then ' in progress ' else 'In Progress' end when o_orderkey%2=0 then 'On Hold' else 'not started' end",
    "priority": "case o_orderpriority when '1-URGENT' then 'Critical' when '2-HIGH' then 'High' "
    "when '3-MEDIUM' then 'Medium' else 'Low' end",
    "region": "r_name",
    "project_manager_id": "concat('EMP', cast(o_custkey as string))",
    "start_date": "case when o_orderstatus='P' and o_orderkey%2=1 then null "
    "else cast(cast(o_orderdate as date) as string) end",
    "end_date": "case when o_orderstatus='F' then cast(last_ship as string) end",
    "budget": "case when o_orderkey%50=0 then null when o_orderkey%50=1 then cast(0 as decimal(14,2)) "
    "else cast(o_totalprice as decimal(14,2)) end",
    "actual_cost": "cast(cost as decimal(14,2))",
}

EMPLOYEE_COLUMNS = {
    "employee_id": "concat('EMP', cast(c_custkey as string))",
    "full_name": "case when c_custkey%140=9 then '  ' else c_name end",
    "email": "case when c_custkey%100=0 then null when c_custkey%100=1 then ' ' "
    "else concat('u', cast(c_custkey as string), '@example.com') end",
    "hire_date": "case c_custkey%125 when 0 then '-999' when 1 then '99999-01-01' when 2 then '1970-01-01' "
    "when 3 then '2999-01-01' when 4 then null "
    "else cast(date '1995-01-01' + cast((c_custkey*37)%9000 as int) as string) end",
    "department": "c_mktsegment",
    "role": "case c_custkey%3 when 0 then 'Engineer' when 1 then 'Analyst' else 'Manager' end",
    "level": "case c_custkey%5 when 0 then 'Junior' when 1 then 'Mid' when 2 then 'Senior' when 3 then 'Lead' "
    "else 'Director' end",
    "salary": "cast((case c_custkey%5 when 0 then 10500 when 1 then 15500 when 2 then 24000 when 3 then 38000 "
    "else 50000 end + cast(c_acctbal as decimal(12,2))) * case when c_custkey%111=7 then 5 else 1 end "
    "as decimal(12,2))",
    "manager_id": "case when c_custkey<10 then 'EMP0000' when c_custkey%140=11 "
    "then concat('EMP', cast(c_custkey as string)) when c_custkey%140=12 then null "
    "when c_custkey%140=13 then 'EMP_GONE' "
    "else concat('EMP', cast(cast(floor(c_custkey/10) as bigint) as string)) end",
    "region": "r_name",
    "status": "case when c_custkey%25=0 then 'Inactive' else 'Active' end",
    "years_experience": "cast(case when c_custkey%130=5 then -1 when c_custkey%130=6 then 70 "
    "else c_custkey%40 end as int)",
}

# Suppliers in the shape of customers, with keys of their own.
SUPPLIER_AS_PERSON = {
    "c_custkey": "1000000000 + s_suppkey",
    "c_name": "s_name",
    "c_nationkey": "s_nationkey",
    "c_acctbal": "s_acctbal",
    "c_mktsegment": "'PROCUREMENT'",
}

HISTORY_COLUMNS = {
    "employee_id": "concat('EMP', cast(o_custkey as string))",
    "previous_salary": "cast(10000 + floor(prev_price/10) as decimal(12,2))",
    "new_salary": "cast(10000 + floor(o_totalprice/10) as decimal(12,2))",
    "previous_role": "case when prev_pri is null then null else concat('Role ', substr(prev_pri,1,1)) end",
    "new_role": "concat('Role ', substr(o_orderpriority,1,1))",
    "previous_level": "case substr(prev_pri,1,1) when '1' then 'Director' when '2' then 'Lead' when '3' then 'Senior' "
    "when '4' then 'Mid' when '5' then 'Junior' end",
    "new_level": "case substr(o_orderpriority,1,1) when '1' then 'Director' when '2' then 'Lead' "
    "when '3' then 'Senior' when '4' then 'Mid' else 'Junior' end",
    "effective_date": "cast(o_orderdate as date)",
    "change_type": "case when rn=1 then 'Hire' when rn%2=0 then 'Raise' else 'Promotion' end",
    "change_reason": "case when rn=1 then 'Initial appointment' else concat('Review ', cast(rn as string)) end",
}

_VENDOR = "cast(case when l_suppkey%25<3 then 0 when l_suppkey%25<5 then 3 else l_suppkey%25 end as string)"

TRANSACTION_COLUMNS = {
    "transaction_id": "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
    "cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_shipdate as date) as string))",
    "project_id": "concat('PRJ', cast(l_orderkey as string))",
    "vendor_id": f"concat('VEN', {_VENDOR})",
    "vendor_name": f"concat('Vendor ', {_VENDOR})",
    "category": "p_type",
    "amount": "case when l_quantity=50 then null else cast(l_extendedprice as decimal(14,2)) end",
    "currency": "'AED'",
    "transaction_date": "cast(cast(l_shipdate as date) as string)",
    "payment_status": "case l_returnflag when 'N' then 'Paid' when 'A' then 'Pending' else 'Disputed' end",
    "approved_by": "case when l_linenumber=7 then null else concat('EMP', cast(l_suppkey as string)) end",
    "invoice_ref": "concat('INV', cast(l_orderkey as string))",
    "notes": "cast(null as string)",
}

_K = "cast(regexp_extract(props, '[0-9]+', 0) as bigint)"

EVENT_COLUMNS = {
    "event_id": "concat('EVT', cast(event_id as string))",
    "event_type": "case event_type when 'error' then 'escalation_raised' when 'purchase' then 'escalation_resolved' "
    "when 'click' then 'task_completed' when 'view' then 'document_uploaded' "
    f"else case when {_K}%2=0 then 'login' else 'logout' end end",
    "project_id": f"case when event_type='signup' then null else concat('PRJ', cast({_K} as string)) end",
    "user_id": "case when event_id%100=99 then null else concat('EMP', cast(user_id as string)) end",
    "timestamp": "cast(ts as timestamp)",
    "severity": f"case when event_type='error' then case {_K}%4 when 0 then 'Critical' when 1 then 'High' "
    "when 2 then 'Medium' else 'Low' end end",
    "resolved_by": "case when event_type='purchase' then concat('EMP', cast(user_id as string)) end",
}


def _mapped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def platform_events(events: DataFrame) -> DataFrame:
    """Works on a batch and on a streaming frame of the events table."""
    flat = _mapped(events, EVENT_COLUMNS)
    payload = F.map_filter(
        F.create_map(F.lit("severity"), F.col("severity"), F.lit("resolved_by"), F.col("resolved_by")),
        lambda _, value: value.isNotNull(),
    )
    return flat.select("event_id", "event_type", "project_id", "user_id", "timestamp", payload.alias("payload"))


class TestData:
    """The entities of one scale-factor folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _customers(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )

    @cached_property
    def _people(self) -> DataFrame:
        """Customers, who all have orders, and suppliers, who have none and so no history."""
        suppliers = self.table("supplier").select(*[F.expr(text).alias(name) for name, text in SUPPLIER_AS_PERSON.items()])
        nation, region = self.table("nation"), self.table("region")
        return (
            self.table("customer")
            .unionByName(suppliers)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )

    @cached_property
    def projects(self) -> DataFrame:
        """Costs are summed in whole cents, whose sums are half as wide in the shuffle as those of decimals."""
        costs = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                (F.sum((F.col("l_extendedprice").cast("decimal(14,2)") * 100).cast("bigint")) * F.lit(Decimal("0.01"))).alias("cost"),
                F.max(F.col("l_shipdate").cast("date")).alias("last_ship"),
            )
        )
        orders = self.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        joined = (
            orders.join(self._customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(costs, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        )
        return _mapped(joined, PROJECT_COLUMNS)

    @cached_property
    def employees(self) -> DataFrame:
        return _mapped(self._people, EMPLOYEE_COLUMNS)

    @cached_property
    def salary_history(self) -> DataFrame:
        """Every order is a change of its customer; some customers order twice on one day."""
        by_day = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
        ranked = self.table("orders").select(
            "*",
            F.row_number().over(by_day).alias("rn"),
            F.lag("o_totalprice").over(by_day).alias("prev_price"),
            F.lag("o_orderpriority").over(by_day).alias("prev_pri"),
        )
        return _mapped(ranked, HISTORY_COLUMNS)

    @cached_property
    def transactions(self) -> DataFrame:
        """Of the quantity only 50 matters, and of the time only the day: less goes through the joins."""
        lines = self.table("lineitem").withColumns(
            {"l_shipdate": F.col("l_shipdate").cast("date"), "l_quantity": F.when(F.col("l_quantity") == 50, F.lit(50.0))}
        )
        suppliers = self.table("supplier").select("s_suppkey")
        parts = self.table("part").select("p_partkey", "p_type")
        joined = (
            lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        )
        return _mapped(joined, TRANSACTION_COLUMNS)

    @cached_property
    def events(self) -> DataFrame:
        return platform_events(self.table("events"))

    def event_stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet")
        return platform_events(reader.parquet(self.folder))
