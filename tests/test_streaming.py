import json

import pytest

from ledgerspark.plans import events as ev
from ledgerspark.sources.files import read_event_stream
from ledgerspark.sources.testdata import TestData
from ledgerspark.streaming import events as st
from tests.helpers import by

SF = "/root/testdata/sf0.001"


@pytest.fixture
def messages(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    first = [
        {"event_id": "1", "event_type": "login", "user_id": "u", "timestamp": "2024-01-01T00:00:00"},
        {"event_id": "2", "event_type": "escalation_raised", "project_id": "p", "payload": {"severity": "Critical"}},
        {"event_id": "3", "event_type": "escalation_raised", "project_id": "p", "payload": None},
        {"event_id": "4", "project_id": "p"},
    ]
    (folder / "a.jsonl").write_text("\n".join(json.dumps(r) for r in first) + "\n\n   \n")
    (folder / "b.jsonl").write_text(json.dumps({"event_id": "5", "event_type": "login", "payload": {"severity": "Critical"}}))

    def stream():
        return read_event_stream(spark, "text", path=str(folder), maxFilesPerTrigger="1")

    return stream


def test_stamping_drops_blank_lines_and_keys_by_type(spark, messages, tmp_path):
    out = str(tmp_path / "out")
    st.write_messages(st.stamp_events(messages()), out, str(tmp_path / "progress"))
    rows = spark.read.schema("key string, value string").json(out).collect()
    assert sorted(str(r.key) for r in rows) == ["None", "escalation_raised", "escalation_raised", "login", "login"]
    for r in rows:
        assert json.loads(r.value)["produced_at"].endswith("+00:00")


ODD_OBJECTS = [
    {"event_type": "login", "count": 12345678901234567890123, "ratio": 0.1, "big": 2e300, "whole": 5.0, "minus": -7},
    {"event_type": "login", "payload": {"severity": "High", "hours": 3, "tags": ["a", None, {"deep": [1.5]}]}, "nothing": None},
    {"produced_at": "yesterday", "quote": "a\"b\\c\n\u00e9", "": "no name", "event_type": None},
    {},
    {"event_type": 5},
]
MALFORMED = [("{\"a\": 1", "not JSON"), ("[1, 2]", "not an object"), ("\"text\"", "not an object"), ("null", "not an object"), ("{\"a\":1,\"a\":2}", "not JSON")]


def test_stamping_keeps_every_value_and_sets_malformed_lines_aside(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join([*map(json.dumps, ODD_OBJECTS), "", "  ", *(line for line, _ in MALFORMED)]))
    written = st.publish_events(read_event_stream(spark, "text", path=str(folder)), out, str(tmp_path / "progress"))
    assert written == {"published": len(ODD_OBJECTS), "dead_letters": len(MALFORMED)}
    values = [json.loads(r.value) for r in st.read_messages(spark, f"{out}/published").collect()]
    assert all(v.pop("produced_at").endswith("+00:00") for v in values)
    want = [{k: v for k, v in o.items() if k != "produced_at"} for o in ODD_OBJECTS]
    assert len(values) == len(want) and all(v in want for v in values) and all(v in values for v in want)
    dead = st.read_messages(spark, f"{out}/dead_letters", st.DEAD_SCHEMA).collect()
    assert sorted((r.value, r.reason) for r in dead) == sorted(MALFORMED)
    keys = sorted(str(r.key) for r in st.read_messages(spark, f"{out}/published").collect())
    assert keys == ["5", "None", "None", "login", "login"]


def stream_events(messages):
    return st.decode_events(messages().where("trim(value) <> ''"))


def forwarded_ids(spark, out):
    return sorted(json.loads(r.value)["event_id"] for r in spark.read.schema(st.MESSAGE_SCHEMA).json(f"{out}/forwarded").collect())


def test_run_counts_forwards_and_summarises(spark, messages, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    summary = st.run_event_stream(spark, stream_events(messages), out, progress, "topic").first()
    assert summary.total_messages_consumed == summary.messages_of_all_runs == 5 and summary.critical_escalations_forwarded == 1
    assert summary.event_counts == {"login": 2, "escalation_raised": 2, "unknown": 1}
    assert summary.topic == "topic" and summary.elapsed_seconds > 0 and summary.throughput_messages_per_second > 0
    sent = spark.read.schema(st.MESSAGE_SCHEMA).json(f"{out}/forwarded").collect()
    assert [r.key for r in sent] == ["p"] and json.loads(sent[0].value)["event_id"] == "2"


def test_later_runs_report_their_own_messages(spark, messages, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    first = st.run_event_stream(spark, stream_events(messages), out, progress, "topic").first()
    idle = st.run_event_stream(spark, stream_events(messages), out, progress, "topic").first()
    assert (idle.total_messages_consumed, idle.critical_escalations_forwarded, idle.messages_of_all_runs) == (0, 0, 5)
    assert idle.event_counts == {} and idle.throughput_messages_per_second is None and idle.run_id != first.run_id
    late = [{"event_id": str(i), "event_type": "escalation_raised", "payload": {"severity": "Critical"}} for i in (6, 7)]
    (tmp_path / "in" / "c.jsonl").write_text("\n".join(map(json.dumps, late)))
    third = st.run_event_stream(spark, stream_events(messages), out, progress, "topic").first()
    assert (third.total_messages_consumed, third.critical_escalations_forwarded, third.messages_of_all_runs) == (2, 2, 7)
    assert third.event_counts == {"escalation_raised": 2} and forwarded_ids(spark, out) == ["2", "6", "7"]
    # fresh progress reads all again, and old folders do not count in it
    fresh = st.run_event_stream(spark, stream_events(messages), out, str(tmp_path / "fresh"), "topic")
    assert fresh.first().total_messages_consumed == fresh.first().messages_of_all_runs == 7


@pytest.mark.parametrize("bad_id, counted", [("1", (0, 1)), ("5", (0, 4))])
def test_summary_is_written_when_the_stream_fails_and_a_restart_forwards_once(spark, messages, tmp_path, bad_id, counted):
    from pyspark.sql import functions as F

    events, out, progress = stream_events(messages), str(tmp_path / "out"), str(tmp_path / "progress")
    broken = events.withColumn(
        "event_type", F.when(F.col("event_id") == bad_id, F.raise_error(F.lit("bad message"))).otherwise(F.col("event_type"))
    )
    with pytest.raises(Exception, match="bad message"):
        st.run_event_stream(spark, broken, out, progress, "topic")
    before = st.read_summary(spark, out).first()
    assert before.total_messages_consumed in counted and not any(q.isActive for q in spark.streams.active)
    after = st.run_event_stream(spark, stream_events(messages), out, progress, "topic").first()
    assert after.total_messages_consumed == 5 - before.total_messages_consumed and after.messages_of_all_runs == 5
    assert forwarded_ids(spark, out) == ["2"]


def test_stream_totals_equal_batch(spark, tmp_path):
    data = TestData(spark, SF)
    table = str(tmp_path / "counts")
    st.drain(st.type_counts(data.event_stream()), str(tmp_path / "p1"), st.overwrite_into(table), "complete")
    assert by(spark.read.parquet(table), "event_type", "event_count") == by(
        st.type_counts(data.events), "event_type", "event_count"
    )
    daily = str(tmp_path / "daily")
    st.drain(st.daily_volume(data.event_stream()), str(tmp_path / "p2"), st.overwrite_into(daily), "complete")
    batch = ev.daily_event_volume(ev.with_date_parts(data.events)).drop("cumulative_count")
    assert sorted(spark.read.parquet(daily).collect()) == sorted(batch.collect())
