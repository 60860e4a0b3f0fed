"""The alert job as one query: each line is read and decoded once for all results.

Every micro-batch is a numbered step. Its lines are stored as decoded rows; windows
that the watermark has passed are computed from those rows, and windows that late
rows touch are computed again. A step overwrites its own folders and nothing else, so
a batch that is replayed after a failure writes nothing twice. Where a window was
computed in several steps, the latest holds; `current_*` read it so.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from meterwell.operators.events import CORRUPT, corrupt_events, good_events
from meterwell.operators.risk import alert_records, graded_windows, stats_records
from meterwell.schemas import RISK_ALERT, WINDOW_STATS
from meterwell.settings import DEFAULTS, Settings
from meterwell.sources.tables import folder_names, is_written

_SECOND = 1_000_000
_DAY = 86_400 * _SECOND
_EPOCH = date(1970, 1, 1)
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_TOTALS = ("events", "corrupt_lines", "late_events")
_PROGRESS = t.StructType(
    [t.StructField(n, t.LongType()) for n in ("newest", "closed_until", *_TOTALS)]
)


@dataclass(frozen=True)
class Progress:
    """What a step left behind. Times are microseconds since 1970."""

    newest: int | None = None
    closed_until: int | None = None
    events: int = 0
    corrupt_lines: int = 0
    late_events: int = 0


def _day(micros: int) -> str:
    return str(_EPOCH + timedelta(days=micros // _DAY))


class OnePass:
    """`foreachBatch` target for decoded events, with its tables below `state`.

    * `state/received`: decoded rows by day and step, late ones marked; rows without a
      time are the corrupt lines.
    * `state/windows`: graded windows by step.
    * `state/progress`: newest event, the time up to which windows are closed, totals.
    * `alerts`, `stats`, `corrupt`: the results as JSON lines by step.

    A window closes when the newest event of all steps so far is more than the allowed
    lateness past its end, as under Spark's watermark. An event of a closed window is
    late: it is kept, and its windows are computed anew in the same step. Only the
    days of the windows in question are read. Batches without lines change nothing.
    """

    def __init__(
        self,
        state: str,
        alerts: str,
        stats: str,
        corrupt: str,
        settings: Settings = DEFAULTS,
        window_seconds: int | None = None,
    ):
        self.state = state
        self.received = f"{state}/received"
        self.windows = f"{state}/windows"
        self.progress = f"{state}/progress"
        self.alerts, self.stats, self.corrupt = alerts, stats, corrupt
        self.settings = settings
        self.window_seconds = window_seconds or settings.window_seconds
        self.size = self.window_seconds * _SECOND

    def __call__(self, decoded: DataFrame, batch: int) -> None:
        """One micro-batch. Odd steps are free for `close`, which may follow it."""
        spark, step = decoded.sparkSession, 2 * batch
        before = self._progress(spark, (step - 1, step - 2))
        totals = self._receive(decoded, step, before)
        newest = max((n for n in (before.newest, totals["newest"]) if n is not None), default=None)
        until = before.closed_until
        if newest is not None:
            lateness = self.settings.lateness_seconds * _SECOND
            passed = self._start(newest - lateness)
            until = passed if until is None else max(until, passed)
        if totals["corrupt_lines"]:
            rows = self._rows(spark, [_NO_DAY], decoded.schema).filter(F.col("step") == step)
            corrupt_events(rows).write.mode("overwrite").json(f"{self.corrupt}/step={step}")
        late_from = totals["late_from"]
        self._compute(spark, decoded.schema, step, before.closed_until, until, late_from)
        counts = {name: totals[name] for name in _TOTALS}
        self._finish(spark, step, Progress(newest, until, **counts))

    def close(self, spark: SparkSession, schema: t.StructType) -> None:
        """Close every window that has events, at the end of a run.

        `schema` is that of the decoded events. Only finished steps count; what came
        after them is replayed by the next run, and is late there if its window is closed.
        """
        steps = [int(name.partition("=")[2]) for name in folder_names(spark, self.progress)]
        done = [s for s in steps if self._is_done(spark, s)]
        last = max(done, default=None)
        before = Progress() if last is None else self._progress(spark, (last,))
        if before.newest is None or last % 2:
            return
        until = self._start(before.newest) + self.size
        self._compute(spark, schema, last + 1, before.closed_until, until, None)
        self._finish(spark, last + 1, Progress(before.newest, until))

    def _start(self, micros: int) -> int:
        return micros // self.size * self.size

    def _is_done(self, spark: SparkSession, step: int) -> bool:
        return is_written(spark, f"{self.progress}/step={step}", "_SUCCESS")

    def _progress(self, spark: SparkSession, steps: Iterable[int]) -> Progress:
        for step in steps:
            if self._is_done(spark, step):
                row = spark.read.schema(_PROGRESS).json(f"{self.progress}/step={step}").first()
                return Progress(**row.asDict())
        return Progress()

    def _finish(self, spark: SparkSession, step: int, progress: Progress) -> None:
        row = [tuple(getattr(progress, name) for name in _PROGRESS.names)]
        one = spark.createDataFrame(row, _PROGRESS).coalesce(1)
        one.write.mode("overwrite").json(f"{self.progress}/step={step}")

    def _receive(self, decoded: DataFrame, step: int, before: Progress) -> dict:
        """Store the rows of a batch, and count them on the way."""
        micros = F.unix_micros("event_time")
        closed = before.closed_until
        is_late = F.lit(False) if closed is None else F.coalesce(micros < closed, F.lit(False))
        good = F.col(CORRUPT).isNull()
        day = F.date_add(F.lit(_EPOCH), _whole(micros, _DAY))
        rows = decoded.withColumns(
            {
                "is_late": good & is_late,
                "day": F.when(good, day).cast("string"),
                "step": F.lit(step),
            }
        )
        seen = Observation()
        counted = rows.observe(
            seen,
            F.max(F.when(good, micros)).alias("newest"),
            F.count_if(good).alias("events"),
            F.count_if(~good).alias("corrupt_lines"),
            F.count_if("is_late").alias("late_events"),
            F.min(F.when(F.col("is_late"), micros)).alias("late_from"),
        )
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "step")
            .parquet(self.received)
        )
        return seen.get

    def _rows(self, spark: SparkSession, days: Iterable[str], schema: t.StructType) -> DataFrame:
        """Stored rows of some days, found by folder."""
        own = t.StructType([*schema.fields]).add("is_late", "boolean").add("day", "string")
        there = folder_names(spark, self.received)
        folders = [f"{self.received}/day={d}" for d in days if f"day={d}" in there]
        if not folders:
            return spark.createDataFrame([], own.add("step", "integer"))
        reader = spark.read.schema(own.add("step", "integer")).option("basePath", self.received)
        return reader.parquet(*folders)

    def _compute(
        self,
        spark: SparkSession,
        schema: t.StructType,
        step: int,
        since: int | None,
        until: int | None,
        late_from: int | None,
    ) -> None:
        """Write the windows that start in [since, until), and those that late rows touch."""
        parts = []
        if until is not None and until != since:
            parts.append(self._between(spark, schema, step, since, until))
        if late_from is not None:
            parts.append(self._touched(spark, schema, step, late_from, since))
        if not parts:
            return
        events = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        graded = graded_windows(
            good_events(events).drop("is_late", "day", "step"), self.settings, self.window_seconds
        )
        # A region is null at times, and JSON leaves nulls out: the schema is kept by Parquet.
        graded.write.mode("overwrite").parquet(f"{self.windows}/step={step}")
        stored = spark.read.schema(graded.schema).parquet(f"{self.windows}/step={step}")
        alert_records(stored).write.mode("overwrite").json(f"{self.alerts}/step={step}")
        stats_records(stored).write.mode("overwrite").json(f"{self.stats}/step={step}")

    def _days(self, spark: SparkSession, first: str | None, last: str) -> list[str]:
        names = (name.partition("=")[2] for name in folder_names(spark, self.received))
        return sorted(d for d in names if d != _NO_DAY and (first or d) <= d <= last)

    def _between(
        self, spark: SparkSession, schema: t.StructType, step: int, since: int | None, until: int
    ) -> DataFrame:
        days = self._days(spark, None if since is None else _day(since), _day(until - 1))
        inside = F.col("event_time") < _instant(until)
        if since is not None:
            inside = inside & (F.col("event_time") >= _instant(since))
        return self._rows(spark, days, schema).filter(inside & (F.col("step") <= step))

    def _touched(
        self, spark: SparkSession, schema: t.StructType, step: int, late_from: int, since: int
    ) -> DataFrame:
        """All events, of this step and before, of the windows that its late rows belong to."""
        micros = F.unix_micros("event_time")
        start = (micros - F.pmod(micros, F.lit(self.size))).alias("start")
        rows = self._rows(spark, self._days(spark, _day(late_from), _day(since - 1)), schema)
        late = rows.filter((F.col("step") == step) & F.col("is_late")).select(start).distinct()
        reach = F.sequence(
            _whole(F.col("start"), _DAY), _whole(F.col("start") + (self.size - 1), _DAY)
        )
        days = late.select(F.explode(reach).alias("d")).distinct().collect()
        events = self._rows(spark, [_day(r.d * _DAY) for r in days], schema)
        closed = events.filter((F.col("step") <= step) & (F.col("event_time") < _instant(since)))
        return closed.withColumn("start", start).join(late, "start", "left_semi").drop("start")


def _whole(micros: Column, unit: int) -> Column:
    """How many whole units, rounded down."""
    return ((micros - F.pmod(micros, F.lit(unit))) / unit).cast("int")


def _instant(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


def start_one_pass(
    decoded: DataFrame, sink: OnePass, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    writer = decoded.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class IdleEnd(StreamingQueryListener):
    """Tells when a session's stream has met no line for `seconds`.

    Spark reports an idle query at most every `spark.sql.streaming.noDataProgressEventInterval`.
    """

    def __init__(self, seconds: float):
        self.seconds, self.reached = seconds, threading.Event()
        self._since = time.monotonic()

    def onQueryStarted(self, event) -> None:
        self._since = time.monotonic()

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self._since = time.monotonic()

    def onQueryIdle(self, event) -> None:
        if time.monotonic() - self._since >= self.seconds:
            self.reached.set()

    def onQueryTerminated(self, event) -> None:
        self.reached.set()


def run_until_idle(
    decoded: DataFrame, sink: OnePass, checkpoint: str, max_idle_seconds: float
) -> None:
    """Run until no line came for a while, then close the last windows and end.

    A failed query raises its error, and its windows stay open for the next run.
    """
    spark = decoded.sparkSession
    interval = "spark.sql.streaming.noDataProgressEventInterval"
    spark.conf.set(interval, str(max(1, int(min(10, max_idle_seconds) * 1000))))
    idle = IdleEnd(max_idle_seconds)
    spark.streams.addListener(idle)
    try:
        query = start_one_pass(decoded, sink, checkpoint)
        while query.isActive and not idle.reached.wait(0.2):
            pass
        if query.isActive:
            query.stop()
        query.awaitTermination()
    finally:
        spark.streams.removeListener(idle)
    sink.close(spark, decoded.schema)


def _by_step(spark: SparkSession, folder: str, schema: t.StructType) -> DataFrame:
    return spark.read.schema(t.StructType([*schema.fields]).add("step", "integer")).json(folder)


def _latest(spark: SparkSession, stats: str) -> DataFrame:
    every = _by_step(spark, stats, WINDOW_STATS)
    return every.groupBy("window").agg(F.max("step").alias("step"))


def current_stats(spark: SparkSession, stats: str) -> DataFrame:
    """Statistics of each window as last computed."""
    return _by_step(spark, stats, WINDOW_STATS).join(_latest(spark, stats), ["window", "step"]).drop("step")


def current_alerts(spark: SparkSession, alerts: str, stats: str) -> DataFrame:
    """Alerts of each window as last computed; a window's alerts may all be gone by then."""
    latest = _latest(spark, stats).withColumnRenamed("window", "window_start")
    rows = _by_step(spark, alerts, RISK_ALERT).join(latest, ["window_start", "step"])
    return rows.select(*RISK_ALERT.names)


def current_windows(spark: SparkSession, state: str) -> DataFrame:
    """Graded windows as last computed."""
    every = spark.read.parquet(f"{state}/windows")
    latest = every.groupBy("window").agg(F.max("step").alias("step"))
    return every.join(latest, ["window", "step"]).drop("step")


def corrupt_lines(spark: SparkSession, corrupt: str) -> DataFrame:
    return spark.read.text(corrupt).select(F.get_json_object("value", f"$.{CORRUPT}").alias("line"))


def run_totals(spark: SparkSession, state: str) -> DataFrame:
    """One row: events, corrupt lines and late events over all finished steps."""
    schema = t.StructType([*_PROGRESS.fields]).add("step", "integer")
    every = spark.read.schema(schema).json(f"{state}/progress")
    return every.agg(*(F.sum(name).alias(name) for name in _TOTALS))
