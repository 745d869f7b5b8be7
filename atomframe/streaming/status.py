"""Structured Streaming over files of records, job snapshots and events."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from atomframe.functions.expressions import trailing_number
from atomframe.functions.states import preferred_status
from atomframe.operators.select import stride_selected

#: The state store that timers need.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files below ``path``; zone-less times become timestamps, as watermarks need."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    df = reader.parquet(path)
    zoneless = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def latest_status(df: DataFrame, keys: list[str], ts: str, status: str, rank: str) -> DataFrame:
    """The newest status of each task; of equal times that of higher rank. The state is one row for each task: it grows
    with the tasks, not with their reports."""
    return df.groupBy(*keys).agg(F.max_by(status, F.struct(ts, rank)).alias("status"), F.max(ts).alias("at"))


def new_keys(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Each key once, within the watermark."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def add_new(campaign: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that adds to a table the keys that it lacks. A repeated batch adds nothing."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(campaign)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        rows = batch.dropDuplicates(keys)
        if fs.exists(path):
            rows = rows.join(spark.read.parquet(campaign).select(*keys), keys, "left_anti")
        rows.write.mode("append").parquet(campaign)

    return write


def inactivity(df: DataFrame, ts: str, gap: str, delay: str, *by: str) -> DataFrame:
    """Sessions of activity: each ends with a silence of at least ``gap``, once the watermark has passed it."""
    return df.withWatermark(ts, delay).groupBy(*by, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("events")).select(*by, F.col("w.start").alias("active_from"), F.col("w.end").alias("silent_at"), "events")


#: Activities of a key in order: first and last row and number of rows of each. Times are microseconds since 1970 in state and
#: rows: clocks of sessions and workers have no part in them.
SILENCE = "first array<bigint>, last array<bigint>, events array<bigint>"


class Silence(StatefulProcessor):
    """A key's activities: a value in the state and one timer, ``gap`` after the last row of the first of them. A row with
    ``done`` ends an activity without a word; then, and when the timer has spoken of all, nothing of the key is left."""

    def __init__(self, keys: list[str], gap: datetime.timedelta, done: str | None):
        self.made, self.gap, self.done = [*keys, "active_from", "silent_at", "events"], round(gap.total_seconds() * 1e6), done

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("active", SILENCE)

    def _held(self) -> list[tuple]:
        return list(zip(*self.state.get(), strict=True)) if self.state.exists() else []

    def _told(self, key: tuple, active: tuple) -> Row:
        return Row(*self.made)(*key, active[0], active[1] + self.gap, active[2])

    def _keep(self, held: list[tuple], due: int) -> None:
        """``due``: milliseconds of the timer."""
        if held:
            self.state.update(tuple([a[k] for a in held] for k in range(3)))
            self.handle.registerTimer(due)
        elif self.state.exists():
            self.state.clear()

    def _added(self, held: list[tuple], at: int, done: bool) -> list[tuple]:
        """The activities after one more row, which may be older than some of them."""
        if done:
            return [a for a in held if not a[0] <= at < a[1] + self.gap]
        near = [a for a in held if a[0] - self.gap < at < a[1] + self.gap]
        one = (min([at, *(a[0] for a in near)]), max([at, *(a[1] for a in near)]), 1 + sum(a[2] for a in near))
        return sorted([*(a for a in held if a not in near), one])

    def _rows(self, rows) -> list[tuple[int, bool]]:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        return sorted((r["__at"], bool(self.done and r[self.done])) for r in rows)


class EventSilence(Silence):
    """Only the watermark tells that an activity has ended; until then a later row of the key does not, since one between them
    may come."""

    def _due(self, held: list[tuple]) -> int:
        return (held[0][1] + self.gap - 1) // 1000 if held else 0  # a timer speaks once the watermark is beyond it

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._held()
        for at, done in self._rows(rows):
            # most rows come in order and touch the last activity alone
            if held and at >= held[-1][0]:
                held[-1:] = self._added(held[-1:], at, done)
            else:
                held = self._added(held, at, done)
        self._keep(held, self._due(held))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, now = self._held(), timerValues.getCurrentWatermarkInMs() * 1000
        left = [a for a in held if a[1] + self.gap > now]
        self._keep(left, self._due(left))
        for active in held[: len(held) - len(left)]:
            yield self._told(key, active)


class ClockSilence(Silence):
    """A key has one activity; a row ``gap`` later, or no row for as long by the clock, ends it."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._held()
        for at, done in self._rows(rows):
            if held and at >= held[0][1] + self.gap:
                yield self._told(key, held[0])
                held = []
            if done:
                held = []
            elif held:
                held = [(min(held[0][0], at), max(held[0][1], at), held[0][2] + 1)]
            else:
                held = [(at, at, 1)]
        self._keep(held, timerValues.getCurrentProcessingTimeInMs() + self.gap // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        self._keep([], 0)
        for active in held:
            yield self._told(key, active)


def silences(df: DataFrame, keys: list[str], ts: str, gap: datetime.timedelta, delay: str | None = None, done: str | None = None) -> DataFrame:
    """(keys, active_from, silent_at, events) of each key that has been silent for ``gap``. With a ``delay`` the time is that of
    the events: a key is silent once the watermark has passed its last event by ``gap``, whichever key has moved the
    watermark. Without, it is that of the clock: a key is silent when no row of it has come for ``gap``, even if no row
    comes at all any more. ``done``: a column that is true where a key has ended (finished tasks), which leaves the state at
    once. The state, one row and one timer for each active key, is on disk (RocksDB); with a ``delay`` the row has every activity
    that the watermark has not passed."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = df.select(*keys, F.col(ts).cast("timestamp").alias(ts), F.unix_micros(F.col(ts).cast("timestamp")).alias("__at"), *([done] if done else []))
    rows = rows.withWatermark(ts, delay) if delay else rows
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    processor = (EventSilence if delay else ClockSilence)(keys, gap, done)
    out = rows.groupBy(*keys).transformWithState(processor, f"{kinds}, active_from long, silent_at long, events long", "append", "EventTime" if delay else "ProcessingTime")
    return out.withColumns({c: F.timestamp_micros(c) for c in ("active_from", "silent_at")})


def seen_status(records: DataFrame, jobs: DataFrame, key: str, within: str, delay: str, precedence: str = "tags") -> DataFrame:
    """Records (key, ts, status: what their tags say) next to the job snapshots (key, ts, status: what the scheduler says) of
    the same task that were taken up to ``within`` after them: key, ts, snapshot (null: none was), tags, scheduler, and the
    status by ``precedence`` ('tags' or 'scheduler' first; an empty one has no opinion). Both streams have a watermark of
    ``delay``, so the state holds what can still find a partner, and a record without one speaks when its time is over."""
    a = records.select(F.col(key).alias("__a"), F.col("ts").cast("timestamp").alias("ts"), F.col("status").alias("tags")).withWatermark("ts", delay)
    b = jobs.select(F.col(key).alias("__b"), F.col("ts").cast("timestamp").alias("snapshot"), F.col("status").alias("scheduler")).withWatermark("snapshot", delay)
    near = (F.col("__a") == F.col("__b")) & (F.col("snapshot") >= F.col("ts")) & (F.col("snapshot") <= F.col("ts") + F.expr(f"interval {within}"))
    both = a.join(b, near, "left_outer")
    return both.select(F.col("__a").alias(key), "ts", "snapshot", "tags", "scheduler", F.coalesce(preferred_status("tags", "scheduler", precedence), F.lit("")).alias("status"))


def strided(df: DataFrame, frame: str, stride: int, start: int = 0) -> DataFrame:
    """Rows whose frame's trailing number is start, start + stride ...; names without a number are left out."""
    number = trailing_number(frame)
    return df.where(number.isNotNull() & stride_selected(number, stride, start))


def periodic_counts(df: DataFrame, ts: str, status: str, done: list[str], width: str, delay: str, slide: str | None = None) -> DataFrame:
    """Total, finished and unfinished records of each window."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    good = F.col(status).isin(*done)
    return df.withWatermark(ts, delay).groupBy(w.alias("w")).agg(F.count("*").alias("total"), F.count_if(good).alias("finished"), F.count_if(~good).alias("unfinished")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "total", "finished", "unfinished")


def duplicate_jobs(df: DataFrame, snapshot: str, target: str, key: str, delay: str | None = None) -> DataFrame:
    """Keys with more than one job in a snapshot. With a ``delay`` (the snapshot is then a time) snapshots that the
    watermark has passed leave the state."""
    df = df.withWatermark(snapshot, delay) if delay else df
    return df.groupBy(snapshot, target, key).agg(F.count("*").alias("jobs")).where("jobs > 1")


def drained(df: DataFrame, mode: str, folder: str) -> DataFrame:
    """Runs a stream over all that is there now, into Parquet below ``folder``, and reads the result: what ``append`` has
    added, or the last ``complete`` answer. A batch that is repeated after a failure overwrites its own folder."""
    place = (lambda n: f"{folder}/out/batch={n}") if mode == "append" else lambda n: f"{folder}/out/batch=0"
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(place(n)))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out").select(*df.columns)
