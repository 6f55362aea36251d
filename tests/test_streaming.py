import json
import os

from pyspark.sql import functions as F

from tidemart.session import shared_dir
from tidemart.streaming import ingest, state, windows
from tidemart.streaming.drain import drain, drain_updates


def _events(spark, rows):
    return spark.createDataFrame(
        rows, "event_id long, ts string, user_id long, event_type string, value double"
    ).withColumn("ts", F.col("ts").cast("timestamp"))


def test_sessions_split_at_the_gap(spark):
    day = "2024-01-01 "
    rows = [(1, day + "00:00:00", 1, "a", 1.0), (2, day + "00:29:59", 1, "a", 1.0),
            (3, day + "00:59:59", 1, "a", 1.0), (4, day + "01:29:58", 1, "a", 2.0)]
    got = windows.event_sessions(_events(spark, rows)).orderBy("session_start").collect()
    assert [r["n_events"] for r in got] == [2, 2]


def test_incremental_load_takes_new_files_only(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{source}/a")
    out = shared_dir(spark, "inc")

    def run():
        return ingest.incremental_load(
            spark, f"{source}/*", "id long", f"{out}/data", f"{out}/cp", pattern="*.parquet"
        )

    assert (run().rows, run().rows) == (5, 0)
    spark.range(3).coalesce(1).write.parquet(f"{source}/b")
    third = run()
    assert (third.rows, third.total) == (3, 8)


def test_bad_rows_are_rescued(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("{oops",)], "props string")
    rows = ingest.parse_rescued(df, "props", "k int").collect()
    assert rows[0]["parsed"]["k"] == 1 and rows[0]["rescued"] is None
    assert rows[1]["rescued"] == "{oops"


def test_json_files_stream(spark, tmp_path):
    with open(os.path.join(tmp_path, "x.json"), "w") as f:
        f.write(json.dumps({"id": 7}) + "\n")
    stream = ingest.autoload(spark, str(tmp_path), "id long", "json", "*.json")
    assert [r["id"] for r in drain(stream, "json").collect()] == [7]


def _stream(spark, rows):
    root = shared_dir(spark, "events")
    _events(spark, rows).coalesce(1).write.parquet(root)
    return ingest.autoload(spark, root, _events(spark, rows).schema, pattern="*.parquet")


def test_state_agrees_with_the_batch_totals(spark):
    rows = [(i, f"2024-01-0{1 + i % 3} 00:00:{i % 60:02d}", i % 2, "a", 1.25) for i in range(40)]
    updates = drain_updates(state.stateful_totals(_stream(spark, rows), parts=3), "state")
    got = {r["user_id"]: (r["n_events"], r["total"]) for r in state.fold_parts(updates).collect()}
    assert got == {0: (20, 25.0), 1: (20, 25.0)}


def test_duplicates_are_dropped_within_the_watermark(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, " A ", 1.0), (1, "2024-01-01 00:00:00", 1, "A", 1.0),
            (2, "2024-01-01 00:00:01", 1, "b", -1.0)]
    clean = ingest.silver_clean_stream(
        _stream(spark, rows), {"event_type": F.lower(F.trim("event_type"))},
        {"positive": F.col("value") >= 0}, ["event_id"], "ts", "1 hour",
    )
    assert [r["event_type"] for r in drain(clean, "clean").collect()] == ["a"]
