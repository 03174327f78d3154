import datetime as dt
import json
from decimal import Decimal

import pytest

from ledgerspark.plans.runs import run_batch_etl, run_event_rollups
from ledgerspark.sources import files, sinks
from ledgerspark.staging import shared_folder, stage_table
from tests.helpers import by


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "projects.csv").write_text(
        "project_id,project_name,department,status,priority,region,project_manager_id,start_date,end_date,budget,actual_cost\n"
        'p1,"Big, ""good"" one",IT,completed,High,R,EMP1,2020-01-01,2020-02-01,100.5,90\n'
        "p2,NA,IT,nan,High,R,EMP1,,,,\n"
    )
    (tmp_path / "employees.csv").write_text(
        "employee_id,full_name,email,hire_date,department,role,level,salary,manager_id,region,status,years_experience\n"
        "EMP1,A,,2015-01-01,IT,Dev,Mid,20000,EMP0000,R,Active,3\n"
    )
    feed = [
        {"transaction_id": "t1", "project_id": "p1", "amount": 5.25, "transaction_date": "2020-01-05", "approved_by": "EMP1"},
        {"transaction_id": "t2", "project_id": "p7", "amount": None, "transaction_date": "x"},
    ]
    (tmp_path / "transactions.json").write_text(json.dumps(feed, indent=1))
    (tmp_path / "transactions.jsonl").write_text("\n".join(json.dumps(r) for r in feed))
    events = tmp_path / "events"
    events.mkdir()
    for month in (1, 2):
        lines = [
            json.dumps({
                "event_id": f"{month}-{i}", "event_type": "escalation_raised", "project_id": "p1", "user_id": "u",
                "timestamp": f"2025-0{month}-0{i}T08:00:00", "payload": {"severity": "High", "n": 3, "o": {"a": 1}, "z": None},
            })
            for i in (1, 2)
        ]
        (events / f"events_2025_0{month}.jsonl").write_text("\n".join(lines) + "\n")
    return tmp_path


def test_csv_readers_know_missing_values(spark, folder):
    got = by(files.read_projects(spark, str(folder / "projects.csv")), "project_id", "project_name", "status", "budget")
    assert got == {"p1": ('Big, "good" one', "completed", Decimal("100.50")), "p2": (None, None, None)}


def test_json_array_and_lines_read_alike(spark, folder):
    array = files.read_transactions(spark, str(folder / "transactions.json"))
    lines = files.read_transactions(spark, str(folder / "transactions.jsonl"), lines=True)
    assert sorted(array.collect()) == sorted(lines.collect()) and array.count() == 2


def test_event_files(spark, folder):
    df = files.read_events(spark, str(folder / "events"))
    assert df.count() == 4
    payload = df.first().payload
    assert payload["n"] == "3" and json.loads(payload["o"]) == {"a": 1} and payload["z"] is None and "absent" not in payload
    with pytest.raises(FileNotFoundError, match="no files match"):
        files.read_events(spark, str(folder / "events"), "other_*.jsonl").count()


def test_csv_keeps_blanks_and_counts_rows(spark, tmp_path):
    df = spark.createDataFrame([("  ", "a,b"), (None, 'say "x"')], "a string, b string")
    assert sinks.write_csv(df, str(tmp_path / "c")) == 2
    back = spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_parquet_by_partition(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 as part")
    assert sinks.write_parquet(df, "t", str(tmp_path), partition_by="part") == 100
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == ["part=0", "part=1", "part=2"]
    assert sinks.write_parquet(df, "s", str(tmp_path), small=True) == 100
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 1


def test_empty_tables_are_written_and_counted(spark, tmp_path):
    for name, df in {"none": spark.createDataFrame([], "a int"), "filtered": spark.range(5).where("id > 9")}.items():
        assert sinks.write_parquet(df, name, str(tmp_path)) == 0
        assert spark.read.parquet(str(tmp_path / name)).count() == 0


def test_staging_uses_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage_table(spark.range(5), "five")
    assert staged.count() == 5 and staged.inputFiles()[0].startswith("file://" + shared_folder(spark))


def test_event_run(spark, folder, tmp_path):
    rows = run_event_rollups(spark, str(folder / "events"), str(tmp_path / "out"))
    assert rows == {
        "project_activity_summary": 1, "user_activity_summary": 1, "escalation_log": 4, "daily_event_volume": 4,
        "peak_usage_analysis": 4,
    }
    assert spark.read.parquet(str(tmp_path / "out" / "escalation_log")).where("severity = 'High'").count() == 4


def test_batch_run(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    report = run_batch_etl(
        spark, str(folder / "projects.csv"), str(folder / "employees.csv"), str(folder / "transactions.json"), out,
        dt.date(2026, 9, 16), json_lines=False,
    )
    got = {(r.dataset, r.metric): r.value for r in report.collect()}
    assert got["transactions", "raw_rows"] == got["transactions", "clean_rows"] == "2"
    assert got["projects", "file"] == f"{out}/projects_clean.csv"
    written = spark.read.option("header", True).csv(f"{out}/transactions_clean.csv")
    assert by(written, "transaction_id", "approver_name", "amount_aed") == {"t1": ("A", "5.25"), "t2": (None, "0.0")}


def test_jsonl_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "JSON_FILE_ROWS", 300)
    rows = spark.range(1000).selectExpr("concat('t', id) as transaction_id", "'a line\nbreak' as notes").coalesce(1)
    assert sinks.write_jsonl(rows, str(tmp_path / "out")) == 1000
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) == 4 and all(p.name.endswith(".json.gz") for p in parts)
    loaded = files.read_transactions(spark, str(tmp_path / "out"), lines=True).select("transaction_id", "notes")
    assert sorted(loaded.collect()) == sorted(rows.collect())
