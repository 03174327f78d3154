"""Event messages as a stream: stamping, counting, forwarding, run summary."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerspark import schemas
from ledgerspark.functions.text import is_blank
from ledgerspark.plans.events import RAISED
from ledgerspark.sources.files import parse_event_time

UNKNOWN_TYPE = "unknown"
COUNTS_SCHEMA = "event_type string, event_count bigint, run_id string"
MESSAGE_SCHEMA = "key string, value string"
DEAD_SCHEMA = "value string, reason string"
SUMMARY_SCHEMA = (
    "run_id string, run_at string, topic string, total_messages_consumed bigint, event_counts map<string, bigint>, "
    "critical_escalations_forwarded bigint, elapsed_seconds double, throughput_messages_per_second double, "
    "messages_of_all_runs bigint"
)
CRITICAL = "Critical"


def _members() -> Column:
    """The members of the JSON object in value, null where it is none."""
    return F.expr("try_variant_get(try_parse_json(value), '$', 'map<string, variant>')")


def stamp_events(messages: DataFrame, produced_at: Column | None = None) -> DataFrame:
    """JSON objects to (key, value): produced_at is set, everything else stays, keyed by event type.

    Members keep their names, types and nesting, known or not; numbers keep their value, up to 38 digits or as a double.
    Blank lines and malformed ones (see malformed_messages) are left out.
    """
    moment = F.current_timestamp() if produced_at is None else produced_at
    stamp = F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    objects = messages.select(_members().alias("members"), stamp.alias("produced_at")).where("members is not null")
    stamped = F.expr(
        "to_json(to_variant_object(map_concat(map_filter(members, (k, v) -> k <> 'produced_at'), "
        "map('produced_at', cast(produced_at as variant)))))"
    )
    return objects.select(F.expr("try_variant_get(members['event_type'], '$', 'string')").alias("key"), stamped.alias("value"))


def malformed_messages(messages: DataFrame) -> DataFrame:
    """(value, reason) of the lines that are no JSON object: unparsable ones, a repeated member name included, or other values."""
    filled = messages.where(~is_blank(F.col("value")))
    reason = F.when(F.expr("try_parse_json(value)").isNull(), "not JSON").when(_members().isNull(), "not an object")
    return filled.select("value", reason.alias("reason")).where("reason is not null")


def decode_events(messages: DataFrame) -> DataFrame:
    """Messages with a value column back to event columns."""
    decoded = messages.select(F.from_json("value", schemas.EVENTS).alias("event")).select("event.*")
    return parse_event_time(decoded)


def event_type() -> Column:
    return F.coalesce("event_type", F.lit(UNKNOWN_TYPE))


def type_counts(events: DataFrame) -> DataFrame:
    """Running count per event type; a batch frame gives the totals."""
    return events.groupBy(event_type().alias("event_type")).agg(F.count(F.lit(1)).alias("event_count"))


def critical_escalations(events: DataFrame) -> DataFrame:
    """Critical escalations as messages keyed by project; no payload means not critical."""
    severity = F.col("payload")["severity"]
    return events.where((F.col("event_type") == RAISED) & (severity == CRITICAL)).select(
        F.col("project_id").alias("key"), F.to_json(F.struct(*events.columns)).alias("value")
    )


def first_arrivals(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Streaming form of the batch deduplication: keeps the first row to arrive per event id."""
    kept = events.where(F.col("event_id").isNotNull() & F.col("user_id").isNotNull())
    return kept.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["event_id"])


def daily_volume(events: DataFrame) -> DataFrame:
    """Streaming form of the daily volume, as one-day windows; needs complete or update mode."""
    return (
        events.groupBy(F.window("timestamp", "1 day"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.to_date("window.start").alias("event_date"), "event_type", "event_count")
    )


def write_messages(
    messages: DataFrame, path: str, checkpoint: str, sink: str = "json", **options: str
) -> None:
    """Publish (key, value) rows until the source has no new data.

    sink is a file format with path as its folder, or "kafka" with the topic
    and servers in the options.
    """
    writer = messages.writeStream.format(sink).options(**options).option("checkpointLocation", checkpoint)
    if sink != "kafka":
        writer = writer.option("path", path)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def drain(
    df: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None], mode: str = "append"
) -> None:
    """Run a streaming frame from the earliest data to the end of what is there."""
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def overwrite_into(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for complete mode: the table is the latest full result."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


@contextmanager
def _all_progress(spark: SparkSession):
    """Queries started inside keep the progress of all their batches, not of the last hundred."""
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, str(1 << 20))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _supervise(queries: list[StreamingQuery]) -> None:
    """Wait for all queries; if one fails, the others are stopped and its error is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def publish_events(messages: DataFrame, out: str, checkpoint: str, produced_at: Column | None = None) -> dict[str, int]:
    """Stamp all messages into out/published, and malformed ones into out/dead_letters; the rows written to each.

    Every micro-batch writes both folders of its own number, so a repeated batch replaces what it had written.
    """
    folder, spark = out.rstrip("/"), messages.sparkSession
    parts = {"published": (MESSAGE_SCHEMA, lambda m: stamp_events(m, produced_at)), "dead_letters": (DEAD_SCHEMA, malformed_messages)}
    for name, (schema, _) in parts.items():
        spark.createDataFrame([], schema).write.mode("overwrite").json(f"{folder}/{name}/batch_id=none")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for name, (_, select) in parts.items():
            select(batch).write.mode("overwrite").json(f"{folder}/{name}/batch_id={batch_id}")

    drain(messages, checkpoint, on_batch)
    return {name: read_messages(spark, f"{folder}/{name}", schema).count() for name, (schema, _) in parts.items()}


def read_messages(spark: SparkSession, path: str, schema: str = MESSAGE_SCHEMA) -> DataFrame:
    """The JSON lines of all batches under path."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def run_event_stream(
    spark: SparkSession, events: DataFrame, out: str, checkpoint: str, topic: str, sink: str = "json", **options: str
) -> DataFrame:
    """Count every message, forward critical escalations to a sink of their own, write a summary.

    Counting and forwarding are two queries with a progress of their own below checkpoint, run and watched together: a
    restart goes on where each one stood, so every critical message reaches the sink once (a file sink; Kafka may see
    one again). sink and its options are those of write_messages; files go to out/forwarded. The counts of a
    micro-batch lie in a folder named by the progress they belong to and their number, with the run that wrote them. The
    summary tells this run from all runs of that progress, and is written even if a query fails midway.
    """
    folder, run_id = out.rstrip("/"), uuid.uuid4().hex
    counting, forwarding = f"{checkpoint.rstrip('/')}/counting", f"{checkpoint.rstrip('/')}/forwarding"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        counts = type_counts(batch).withColumn("run_id", F.lit(run_id))
        counts.write.mode("overwrite").parquet(f"{folder}/counts/progress={_progress_id(spark, counting)}/batch_id={batch_id}")

    critical = critical_escalations(events).observe("forwarded", F.count(F.lit(1)).alias("rows"))
    writer = critical.writeStream.format(sink).options(**options).option("checkpointLocation", forwarding)
    if sink != "kafka":
        writer = writer.option("path", f"{folder}/forwarded")
    queries: list[StreamingQuery] = []
    try:
        with _all_progress(spark):
            queries.append(
                events.writeStream.option("checkpointLocation", counting).foreachBatch(on_batch).trigger(availableNow=True).start()
            )
            queries.append(writer.trigger(availableNow=True).start())
            _supervise(queries)
    finally:
        summary = stream_summary(spark, folder, topic, run_id, counting, queries)
        summary.write.mode("overwrite").json(f"{folder}/summary")
    return read_summary(spark, folder)


def _progress_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a query's progress folder carries through all restarts; None before the first batch."""
    try:
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _forwarded_rows(query: StreamingQuery) -> int:
    return sum(p["observedMetrics"]["forwarded"]["rows"] for p in query.recentProgress if p["observedMetrics"])


def stream_summary(
    spark: SparkSession, out: str, topic: str, run_id: str, counting: str, queries: list[StreamingQuery]
) -> DataFrame:
    """One row: this run's messages, count per type, forwarded messages, seconds in batches and rate; messages of all runs.

    queries are the counting and the forwarding query as far as they were started; the seconds are those that the
    counting query's progress reports for batches with rows.
    """
    progress = _progress_id(spark, counting)
    try:
        counts = spark.read.schema(COUNTS_SCHEMA).option("recursiveFileLookup", True).parquet(f"{out}/counts/progress={progress}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        counts = spark.createDataFrame([], COUNTS_SCHEMA)
    batches = [p for q in queries[:1] for p in q.recentProgress if p["numInputRows"]]
    seconds = sum(p["durationMs"]["triggerExecution"] for p in batches) / 1000
    mine = F.col("run_id") == run_id
    per_type = counts.groupBy("event_type").agg(
        F.sum("event_count").alias("_all"), F.sum(F.when(mine, F.col("event_count"))).alias("_rows")
    )
    own = F.filter(F.collect_list(F.struct("event_type", "_rows")), lambda t: t["_rows"].isNotNull())
    totals = per_type.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_messages_consumed"),
        F.map_from_entries(F.array_sort(own)).alias("event_counts"),
        F.coalesce(F.sum("_all"), F.lit(0)).alias("messages_of_all_runs"),
    )
    return totals.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dt.datetime.now(dt.timezone.utc).isoformat()).alias("run_at"),
        F.lit(topic).alias("topic"),
        "total_messages_consumed",
        "event_counts",
        F.lit(sum(map(_forwarded_rows, queries[1:]))).cast("bigint").alias("critical_escalations_forwarded"),
        F.lit(seconds).alias("elapsed_seconds"),
        F.round(F.try_divide("total_messages_consumed", F.lit(seconds)), 2).alias("throughput_messages_per_second"),
        "messages_of_all_runs",
    )


def read_summary(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).json(f"{out.rstrip('/')}/summary")


def stream_metrics(spark: SparkSession, out: str) -> DataFrame:
    """The counts of the written summary as (metric, value)."""
    counted = F.transform(F.map_entries("event_counts"), lambda e: F.struct(F.concat(F.lit("event_counts."), e["key"]).alias("metric"), e["value"].alias("value")))
    totals = [
        F.struct(F.lit(name).alias("metric"), F.col(name).alias("value"))
        for name in ("total_messages_consumed", "critical_escalations_forwarded", "messages_of_all_runs")
    ]
    return read_summary(spark, out).select(F.inline(F.concat(F.array(*totals), counted)))
