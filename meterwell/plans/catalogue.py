"""Every operator as a named query over the star-schema tables.

Each query takes a session and a table folder and returns a DataFrame. Queries
that show a sink write to a new folder under the shared root and read it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.operators import (
    customer,
    dashboard,
    events,
    region,
    reports,
    reshape,
    risk,
    trend,
)
from meterwell.operators.events import ISO_MICROS
from meterwell.plans import pipeline
from meterwell.schemas import RICH_EVENT, RISK_ALERT, TABLES
from meterwell.session import stream_session
from meterwell.sources.bucketed import write_buckets
from meterwell.sources.extracts import read_extract, write_extract
from meterwell.sources.messages import (
    alert_messages,
    append_event_files,
    read_event_files,
    stream_event_files,
    write_event_files,
)
from meterwell.sources.scratch import scratch_dir
from meterwell.sources.star import STAR, star_events, table, wide_usage
from meterwell.sources.tables import (
    read_latest_month,
    read_table,
    read_table_if_written,
    register_tables,
    write_table,
)
from meterwell.sources.wide_csv import read_wide_csv, write_wide_csv
from meterwell.streaming.one_pass import (
    OnePass,
    corrupt_lines,
    current_alerts,
    current_stats,
    current_windows,
    run_totals,
    run_until_idle,
    start_one_pass,
)
from meterwell.streaming.risk_stream import (
    alert_stream,
    heartbeat,
    read_alerts,
    start_corrupt_sink,
    start_json_sink,
    stats_stream,
)

DAY = 86_400
MONTH = "2014-09"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.wide_to_long(wide_usage(spark, sf_dir), STAR)


def _kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region.region_month_kpi(_long(spark, sf_dir))


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region.region_ranking(_kpi(spark, sf_dir), ordered=False)


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.month_over_month(wide_usage(spark, sf_dir), STAR)


def _month_start():
    return F.to_timestamp(F.concat(F.col("report_month"), F.lit("-01")))


def _iso_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_time", F.date_format("event_time", ISO_MICROS))


# Inputs


@_query
def wide_table(spark, sf_dir):
    return wide_usage(spark, sf_dir)


@_query
def wide_scan_csv(spark, sf_dir):
    """Two sets of files, one with its columns the other way round."""
    path = scratch_dir(spark, "wide-csv")
    wide = wide_usage(spark, sf_dir)
    odd = F.col("mobile_number") % 2 == 1
    write_wide_csv(wide.filter(odd), f"{path}/a")
    write_wide_csv(wide.filter(~odd).select(*reversed(wide.columns)), f"{path}/b")
    return read_wide_csv(spark, f"{path}/*", STAR)


# Reshape


@_query
def wide_to_long(spark, sf_dir):
    return _long(spark, sf_dir)


@_query
def wide_to_long_union(spark, sf_dir):
    """The wide rows are stored once, and each month's branch only scans them."""
    path = scratch_dir(spark, "wide")
    wide = wide_usage(spark, sf_dir)
    wide.write.parquet(path)
    return reshape.wide_to_long_by_union(spark.read.schema(wide.schema).parquet(path), STAR)


@_query
def wide_to_long_two_months(spark, sf_dir):
    return reshape.wide_to_long(wide_usage(spark, sf_dir), STAR, months=("2014-07", "2014-08"))


# Summaries


@_query
def customer_month_kpi(spark, sf_dir):
    return customer.customer_month_kpi(_long(spark, sf_dir))


@_query
def region_month_kpi(spark, sf_dir):
    return _kpi(spark, sf_dir)


@_query
def region_month_kpi_join(spark, sf_dir):
    return region.region_month_kpi_by_join(_long(spark, sf_dir))


@_query
def region_scores(spark, sf_dir):
    return region.region_scores(_kpi(spark, sf_dir)).select(
        "circle_id", "report_month", "arpu_score", "activity_score", "data_score", "composite_score"
    )


@_query
def region_ranking(spark, sf_dir):
    return region.region_ranking(_kpi(spark, sf_dir))


@_query
def region_top5_month(spark, sf_dir):
    return region.region_top(_ranking(spark, sf_dir), MONTH)


# Month over month


@_query
def month_over_month(spark, sf_dir):
    return _compared(spark, sf_dir)


@_query
def month_over_month_lag(spark, sf_dir):
    return trend.month_over_month_long(_long(spark, sf_dir))


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    name = f"usage_{uuid.uuid4().hex}"
    return write_buckets(_long(spark, sf_dir), scratch_dir(spark, "buckets"), name).read(spark)


@_query
def month_over_month_bucketed(spark, sf_dir):
    """The long table stored in buckets of customers, then paired without a shuffle."""
    return trend.month_over_month_bucketed(*_bucketed(spark, sf_dir))


@_query
def silent_customers_bucketed(spark, sf_dir):
    compared = trend.month_over_month_bucketed(*_bucketed(spark, sf_dir))
    return trend.silent_customers(compared, ordered=False)


@_query
def usage_decline_alerts(spark, sf_dir):
    return trend.usage_decline_alerts(_compared(spark, sf_dir))


@_query
def usage_decline_one_month(spark, sf_dir):
    compared = trend.month_over_month(wide_usage(spark, sf_dir), STAR, months=[MONTH])
    return trend.usage_decline_alerts(compared)


@_query
def usage_decline_top500(spark, sf_dir):
    return trend.top_alerts(trend.usage_decline_alerts(_compared(spark, sf_dir), ordered=False))


@_query
def silent_customers(spark, sf_dir):
    return trend.silent_customers(_compared(spark, sf_dir))


@_query
def silent_customers_join(spark, sf_dir):
    return trend.silent_customers_by_join(_long(spark, sf_dir), _compared(spark, sf_dir))


@_query
def silent_top500(spark, sf_dir):
    return trend.top_silent(trend.silent_customers(_compared(spark, sf_dir), ordered=False))


# Saved reports


@_query
def report_top_regions(spark, sf_dir):
    return reports.top_regions(_ranking(spark, sf_dir), MONTH)


@_query
def report_critical_month(spark, sf_dir):
    return reports.critical_declines(
        trend.usage_decline_alerts(_compared(spark, sf_dir), ordered=False), MONTH
    )


@_query
def report_region_trend(spark, sf_dir):
    return reports.region_trend(_kpi(spark, sf_dir), "1")


@_query
def report_silent_high(spark, sf_dir):
    return reports.high_risk_silent(
        trend.silent_customers(_compared(spark, sf_dir), ordered=False), MONTH
    )


# Warehouse


@_query
def layer_counts(spark, sf_dir):
    root = scratch_dir(spark, "warehouse")
    pipeline.run_pipeline(wide_usage(spark, sf_dir), root, STAR)
    return pipeline.layer_counts(spark, root)


@_query
def layer_counts_observed(spark, sf_dir):
    """The same counts, taken while the layers are written."""
    written: dict[str, int] = {}
    root = scratch_dir(spark, "warehouse")
    pipeline.run_pipeline(wide_usage(spark, sf_dir), root, STAR, written=written)
    return pipeline.written_counts(spark, written)


_USAGE_9 = ("total_og_mou_9", "total_ic_mou_9", "vol_2g_mb_9", "vol_3g_mb_9")


def _rerun(spark, sf_dir, corrected) -> DataFrame:
    """The silent table after a full run and a run of one month on corrected input."""
    root = scratch_dir(spark, "warehouse")
    wide = wide_usage(spark, sf_dir)
    pipeline.run_pipeline(wide, root, STAR)
    pipeline.run_pipeline(corrected(wide), root, STAR, months=[MONTH])
    return read_table(spark, root, pipeline.SILENT)


@_query
def month_rerun_corrected(spark, sf_dir):
    """Some regions turn silent in the month."""

    def corrected(wide):
        quiet = F.col("circle_id").isin("0", "1", "2")
        return wide.withColumns({c: F.when(quiet, 0.0).otherwise(F.col(c)) for c in _USAGE_9})

    return _rerun(spark, sf_dir, corrected)


@_query
def month_rerun_emptied(spark, sf_dir):
    """Nobody is silent in the month any more: its old rows go."""
    return _rerun(spark, sf_dir, lambda w: w.withColumns({c: F.lit(1.0) for c in _USAGE_9}))


@_query
def mart_if_written(spark, sf_dir):
    root = scratch_dir(spark, "mart")
    if read_table_if_written(spark, root, pipeline.RANKING) is not None:
        raise AssertionError("a table before its first run")
    write_table(_ranking(spark, sf_dir), root, pipeline.RANKING)
    return read_table_if_written(spark, root, pipeline.RANKING)


@_query
def mart_catalog_table(spark, sf_dir):
    """Declared before the first run, dropped and declared again after it."""
    root, database = scratch_dir(spark, "mart"), f"marts_{uuid.uuid4().hex}"
    register_tables(spark, root, database, [pipeline.RANKING])
    write_table(_ranking(spark, sf_dir), root, pipeline.RANKING)
    register_tables(spark, root, database, [pipeline.RANKING])
    return spark.table(f"{database}.{pipeline.RANKING}")


@_query
def mart_parquet_pruned(spark, sf_dir):
    root = scratch_dir(spark, "mart")
    alerts = trend.usage_decline_alerts(_compared(spark, sf_dir), ordered=False)
    write_table(alerts, root, pipeline.ALERTS)
    return read_table(spark, root, pipeline.ALERTS, months=[MONTH])


@_query
def mart_latest_rank(spark, sf_dir):
    """The ranking chart from the stored mart, of which one month is read."""
    root = scratch_dir(spark, "mart")
    write_table(_ranking(spark, sf_dir), root, pipeline.RANKING)
    return dashboard.ranked_bars(read_latest_month(spark, root, pipeline.RANKING))


@_query
def extract_csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "extract")
    write_extract(_ranking(spark, sf_dir), path)
    return read_extract(spark, path, TABLES[pipeline.RANKING])


# Events


@_query
def usage_events(spark, sf_dir):
    return _iso_time(events.usage_events(wide_usage(spark, sf_dir), STAR, event_time=_month_start()))


@_query
def usage_events_two_months(spark, sf_dir):
    months = ("2014-07", "2014-08")
    return _iso_time(
        events.usage_events(
            wide_usage(spark, sf_dir), STAR, months=months, event_time=_month_start(), ordered=True
        )
    )


@_query
def usage_events_rich(spark, sf_dir):
    return _iso_time(events.rich_usage_events(wide_usage(spark, sf_dir), STAR, event_time=_month_start()))


@_query
def usage_events_absent_columns(spark, sf_dir):
    """An input without incoming minutes and without one data volume: both count as 0."""
    wide = wide_usage(spark, sf_dir)
    gone = [c for c in wide.columns if c.startswith(("total_ic_mou_", "vol_2g_mb_"))]
    return _iso_time(events.usage_events(wide.drop(*gone), STAR, event_time=_month_start()))


@_query
def usage_events_narrowed(spark, sf_dir):
    rich = events.rich_usage_events(wide_usage(spark, sf_dir), STAR, event_time=_month_start())
    return _iso_time(events.narrow_events(rich))


@_query
def event_messages(spark, sf_dir):
    rich = events.rich_usage_events(wide_usage(spark, sf_dir), STAR, event_time=_month_start())
    messages = events.event_messages(rich)
    return _iso_time(events.good_events(events.decode_events(messages, RICH_EVENT, keep=["key"])))


@_query
def event_json_roundtrip(spark, sf_dir):
    path = write_event_files(star_events(spark, sf_dir), scratch_dir(spark, "events"))
    decoded = events.good_events(read_event_files(spark, path))
    return _iso_time(decoded.drop("_anomaly"))


# Churn-risk windows


@_query
def window_risk(spark, sf_dir):
    return risk.window_risk(star_events(spark, sf_dir), window_seconds=DAY)


@_query
def window_risk_5min(spark, sf_dir):
    return risk.window_risk(star_events(spark, sf_dir))


@_query
def risk_alerts(spark, sf_dir):
    return risk.risk_alerts(star_events(spark, sf_dir), window_seconds=DAY)


@_query
def window_stats(spark, sf_dir):
    return risk.window_stats(star_events(spark, sf_dir), window_seconds=DAY)


@_query
def alert_summary(spark, sf_dir):
    return risk.alert_summary(risk.window_stats(star_events(spark, sf_dir)))


@_query
def window_arpu_decline(spark, sf_dir):
    return risk.window_arpu_decline(star_events(spark, sf_dir), window_seconds=DAY)


@_query
def window_top_alerts(spark, sf_dir):
    return risk.top_window_alerts(risk.risk_alerts(star_events(spark, sf_dir), window_seconds=DAY))


def _event_folder(spark: SparkSession, sf_dir: str, window_seconds: int) -> str:
    """All events as JSON files, and one later event that closes the last window."""
    usage = star_events(spark, sf_dir)
    path = write_event_files(usage, scratch_dir(spark, "stream-in"))
    return append_event_files(heartbeat(usage, window_seconds=window_seconds), path)


@_query
def risk_alert_stream(spark, sf_dir):
    source = _event_folder(spark, sf_dir, DAY)
    out, state = scratch_dir(spark, "alerts"), scratch_dir(spark, "state")
    alerts = alert_stream(stream_event_files(stream_session(spark), source), window_seconds=DAY)
    start_json_sink(alerts, out, state, available_now=True).awaitTermination()
    return read_alerts(spark, out)


@_query
def risk_alert_stream_5min(spark, sf_dir):
    """The stream with its default window."""
    usage = star_events(spark, sf_dir)
    source = write_event_files(usage, scratch_dir(spark, "stream-in"))
    append_event_files(heartbeat(usage), source)
    out, state = scratch_dir(spark, "alerts"), scratch_dir(spark, "state")
    alerts = alert_stream(stream_event_files(stream_session(spark), source))
    start_json_sink(alerts, out, state, available_now=True).awaitTermination()
    return read_alerts(spark, out)


@_query
def stream_corrupt_lines(spark, sf_dir):
    """What the stream keeps aside when every event is followed by a broken line."""
    source = _event_folder(spark, sf_dir, DAY)
    ids = table(spark, sf_dir, "events").select(F.concat(F.lit("{broken "), F.col("event_id")))
    ids.toDF("value").write.mode("append").text(source)
    out, state = scratch_dir(spark, "corrupt"), scratch_dir(spark, "state")
    decoded = stream_event_files(stream_session(spark), source)
    start_corrupt_sink(decoded, out, state, available_now=True).awaitTermination()
    return spark.read.text(out).select(
        F.get_json_object("value", f"$.{events.CORRUPT}").alias("line")
    )


@_query
def alert_topic_messages(spark, sf_dir):
    """Alert messages, taken apart again as a consumer would."""
    alerts = risk.risk_alerts(star_events(spark, sf_dir), window_seconds=DAY)
    messages = alert_messages(alerts)
    decoded = messages.select("key", F.from_json("value", RISK_ALERT).alias("alert"))
    return decoded.select("key", "alert.*")


@_query
def risk_alert_late(spark, sf_dir):
    """A second run meets every event again; they are late and change nothing."""
    source = _event_folder(spark, sf_dir, DAY)
    out, state = scratch_dir(spark, "alerts"), scratch_dir(spark, "state")
    for late in (False, True):
        if late:
            append_event_files(star_events(spark, sf_dir), source)
        alerts = alert_stream(stream_event_files(stream_session(spark), source), window_seconds=DAY)
        start_json_sink(alerts, out, state, available_now=True).awaitTermination()
    return read_alerts(spark, out)


@_query
def window_stats_stream(spark, sf_dir):
    source = _event_folder(spark, sf_dir, DAY)
    out, state = scratch_dir(spark, "stats"), scratch_dir(spark, "state")
    stats = stats_stream(stream_event_files(stream_session(spark), source), window_seconds=DAY)
    start_json_sink(stats, out, state, available_now=True).awaitTermination()
    return spark.read.schema(stats.schema).json(out)


def _one_pass(spark: SparkSession, window_seconds: int = DAY) -> tuple[OnePass, str]:
    """A sink with folders of its own, and a checkpoint."""
    names = ("one-pass", "alerts", "stats", "corrupt")
    sink = OnePass(*(scratch_dir(spark, n) for n in names), window_seconds=window_seconds)
    return sink, scratch_dir(spark, "state")


def _replayed(spark: SparkSession, sf_dir: str) -> OnePass:
    """All events and a broken line for each, through one query in several batches."""
    source = write_event_files(star_events(spark, sf_dir).repartition(3), scratch_dir(spark, "in"))
    ids = table(spark, sf_dir, "events").select(F.concat(F.lit("{broken "), F.col("event_id")))
    ids.toDF("value").coalesce(1).write.mode("append").text(source)
    sink, state = _one_pass(spark)
    decoded = stream_event_files(stream_session(spark), source, max_files_per_batch=2)
    start_one_pass(decoded, sink, state, available_now=True).awaitTermination()
    sink.close(decoded.sparkSession, decoded.schema)
    return sink


@_query
def one_pass_alerts(spark, sf_dir):
    """Alerts, statistics and broken lines from one read; here the alerts."""
    sink = _replayed(spark, sf_dir)
    return current_alerts(spark, sink.alerts, sink.stats)


@_query
def one_pass_stats(spark, sf_dir):
    return current_stats(spark, _replayed(spark, sf_dir).stats)


@_query
def one_pass_summary(spark, sf_dir):
    """Totals of a stream run: windows, events and alerts by level."""
    return risk.alert_summary(current_stats(spark, _replayed(spark, sf_dir).stats))


@_query
def one_pass_corrupt_lines(spark, sf_dir):
    return corrupt_lines(spark, _replayed(spark, sf_dir).corrupt)


@_query
def one_pass_totals(spark, sf_dir):
    """Lines of a run, counted while they are stored."""
    totals = run_totals(spark, _replayed(spark, sf_dir).state)
    return totals.select("events", "corrupt_lines")


@_query
def late_rows_repaired(spark, sf_dir):
    """A third of the events comes after all windows have closed."""
    usage = star_events(spark, sf_dir)
    source = scratch_dir(spark, "in")
    sink, state = _one_pass(spark)
    for late in (False, True):
        first = F.xxhash64("mobile_number", "event_time") % 3 != 0
        append_event_files(usage.filter(~first if late else first), source)
        decoded = stream_event_files(stream_session(spark), source)
        start_one_pass(decoded, sink, state, available_now=True).awaitTermination()
        sink.close(decoded.sparkSession, decoded.schema)
    return risk.risk_records(current_windows(spark, sink.state))


@_query
def idle_end_stats(spark, sf_dir):
    """A running stream ends by itself after a while without lines; its last window appears."""
    source = write_event_files(star_events(spark, sf_dir), scratch_dir(spark, "in"))
    sink, state = _one_pass(spark)
    decoded = stream_event_files(stream_session(spark), source)
    run_until_idle(decoded, sink, state, max_idle_seconds=1)
    return current_stats(spark, sink.stats)


@_query
def one_pass_arpu_decline(spark, sf_dir):
    """Each region window against the one before, from the windows a stream has stored."""
    return risk.arpu_decline_records(current_windows(spark, _replayed(spark, sf_dir).state))


# Chart data


@_query
def dashboard_region_month(spark, sf_dir):
    return dashboard.dashboard_region_month(dashboard.chart_usage(wide_usage(spark, sf_dir), STAR))


@_query
def dashboard_month_trend(spark, sf_dir):
    return dashboard.dashboard_month_trend(dashboard.chart_usage(wide_usage(spark, sf_dir), STAR))


@_query
def dashboard_latest_bubble(spark, sf_dir):
    usage = dashboard.chart_usage(wide_usage(spark, sf_dir), STAR)
    return dashboard.dashboard_latest_bubble(dashboard.dashboard_region_month(usage))


@_query
def dashboard_latest_rank(spark, sf_dir):
    return dashboard.dashboard_latest_rank(_ranking(spark, sf_dir))


@_query
def dashboard_usage_sample(spark, sf_dir):
    return dashboard.dashboard_usage_sample(dashboard.chart_usage(wide_usage(spark, sf_dir), STAR))
