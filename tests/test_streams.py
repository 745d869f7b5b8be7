"""Streams with timers and joins of streams."""

import datetime
import time

from pyspark.sql import functions as F

from atomframe.streaming import status as S

SCHEMA = "task string, ts timestamp, status string"


def batch(spark, path, rows):
    spark.createDataFrame(rows, "task string, ts string, status string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def started(df, folder, name):
    return df.writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", f"{folder}/checkpoint-{name}")


def test_a_clock_timer_speaks_without_a_later_event(spark, tmp_path):
    path = str(tmp_path / "in")
    batch(spark, path, [("a", "2024-01-01 00:00:00", "running"), ("b", "2024-01-01 00:00:00", "running"), ("c", "2024-01-01 00:00:00", "finished")])
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema).withColumn("over", F.col("status") == "finished")
    query = started(S.silences(stream, ["task"], "ts", datetime.timedelta(seconds=3), done="over"), tmp_path, "clock").trigger(processingTime="1 second").start()
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("clock").count() < 2:
            time.sleep(1)
        time.sleep(3)
        got = spark.table("clock").collect()
        # no event has come after the first ones; what has finished never speaks; each speaks once
        assert sorted((r.task, r.events) for r in got) == [("a", 1), ("b", 1)]
        state = query.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] == 0
    finally:
        query.stop()


def test_state_is_bounded_by_what_is_active(spark, tmp_path):
    """Hundreds of tasks come and end in each of several files; only the last ones are left in the state."""
    path = str(tmp_path / "in")
    for k in range(4):
        batch(spark, path, [(f"t{k}-{i}", f"2024-01-0{k + 1} 00:00:00", "running") for i in range(200)] + [(f"t{k}-{i}", f"2024-01-0{k + 1} 01:00:00", "finished") for i in range(150)])
        time.sleep(1.1)  # file times are in seconds
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1).withColumn("over", F.col("status") == "finished")
    query = started(S.silences(stream, ["task"], "ts", datetime.timedelta(hours=2), "1 hour", "over"), tmp_path, "events").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.table("events").collect()
    assert {r.task for r in got} == {f"t{k}-{i}" for k in range(3) for i in range(150, 200)} and len(got) == 150
    assert {(r.silent_at - r.active_from).total_seconds() for r in got} == {7200.0}
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert rows[-1] <= 50 * 4  # a row, and what its timer takes, for each task that is still active


def test_late_rows_do_not_reopen_what_has_ended(spark, tmp_path):
    """Spark compares rows with the watermark that the batch before had, hence the batch in between."""
    path = str(tmp_path / "in")
    for rows in ([("a", "2024-01-01 00:00:00", "x")], [("b", "2024-01-02 00:00:00", "x")], [("b", "2024-01-02 00:05:00", "x")], [("a", "2024-01-01 00:10:00", "x"), ("b", "2024-01-02 00:30:00", "x")], [("z", "2024-01-09 00:00:00", "x")]):
        batch(spark, path, rows)
        time.sleep(1.1)
    stream = S.file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    query = started(S.silences(stream, ["task"], "ts", datetime.timedelta(hours=1), "1 hour"), tmp_path, "late").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.task, r.events) for r in spark.table("late").collect()) == [("a", 1), ("b", 3)]


def test_only_the_watermark_tells_of_a_silence(spark, tmp_path):
    """A silence that the key's own later row ends waits for the watermark too, as a row between them may still come; one that
    ends with the watermark is told."""
    path = str(tmp_path / "in")
    first = [("a", "2024-01-01 00:00:00", "x"), ("a", "2024-01-01 00:59:00", "x"), ("b", "2024-01-01 00:00:00", "x"), ("b", "2024-01-01 00:50:00", "x"), ("c", "2023-12-31 23:30:00", "x"), ("z", "2024-01-01 01:00:00", "x")]
    batch(spark, path, first)
    drained = lambda name, **o: S.drained(S.silences(S.file_stream(spark, path, spark.read.parquet(path).schema, **o), ["task"], "ts", datetime.timedelta(minutes=30), "1 hour"), "append", str(tmp_path / name))
    assert [(r.task, r.events, str(r.silent_at)) for r in drained("one").collect()] == [("c", 1, "2024-01-01 00:00:00")]
    time.sleep(1.1)  # file times are in seconds
    batch(spark, path, [("a", "2024-01-01 00:29:00", "x"), ("b", "2024-01-01 00:25:00", "x"), ("b", "2024-01-01 02:00:00", "x")])
    time.sleep(1.1)
    batch(spark, path, [("z", "2024-01-09 00:00:00", "x")])
    got = sorted((r.task, str(r.active_from), r.events) for r in drained("three", files_per_trigger=1).collect())
    assert got == [("a", "2024-01-01 00:00:00", 2), ("a", "2024-01-01 00:59:00", 1), ("b", "2024-01-01 00:00:00", 3), ("b", "2024-01-01 02:00:00", 1), ("c", "2023-12-31 23:30:00", 1), ("z", "2024-01-01 01:00:00", 1)]


def test_tags_against_the_scheduler(spark, tmp_path):
    """Both precedences; a snapshot that comes late but within the watermark still counts, one beyond it does not."""
    records, jobs = str(tmp_path / "records"), str(tmp_path / "jobs")
    batch(spark, records, [("a", "2024-01-01 00:00:00", "finished"), ("b", "2024-01-01 00:00:00", ""), ("c", "2024-01-01 00:00:00", "failed"), ("d", "2024-01-01 00:00:00", "")])
    batch(spark, jobs, [("a", "2024-01-01 00:30:00", "running"), ("b", "2024-01-01 00:40:00", "submitted"), ("c", "2024-01-01 05:00:00", "running"), ("d", "2023-12-31 23:00:00", "running")])
    for hour in (0, 1):
        time.sleep(1.1)
        for path in (records, jobs):
            batch(spark, path, [("end", f"2024-01-03 0{hour}:00:00", "x")])
    time.sleep(1.1)
    batch(spark, jobs, [("a", "2024-01-01 00:45:00", "failed")])  # beyond the watermark
    for precedence, a in (("tags", "finished"), ("scheduler", "running")):
        of = lambda p: S.file_stream(spark, p, spark.read.parquet(p).schema, files_per_trigger=1)
        query = started(S.seen_status(of(records), of(jobs), "task", "1 hour", "1 hour", precedence), tmp_path, precedence).trigger(availableNow=True).start()
        query.awaitTermination()
        got = {r.task: r.status for r in spark.table(precedence).where("task <> 'end'").collect()}
        assert got == {"a": a, "b": "submitted", "c": "failed", "d": ""} and spark.table(precedence).where("task <> 'end'").count() == 4


def test_frames_by_stride(spark):
    df = spark.createDataFrame([(f"frame_{k}",) for k in range(7)] + [("frame",)], "frame string")
    assert sorted(r.frame for r in S.strided(df, "frame", 3, 1).collect()) == ["frame_1", "frame_4"]
