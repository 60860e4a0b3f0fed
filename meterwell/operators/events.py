"""Usage events: built from the wide table, coded to and from messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from meterwell.functions.values import column_or, number
from meterwell.operators.reshape import chosen_months, unpivot
from meterwell.schemas import RICH_EVENT, RICH_INTS, RICH_MEASURES, USAGE_EVENT
from meterwell.settings import DEFAULTS, Settings

CORRUPT = "_corrupt_record"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_NARROW = ["total_og_mou", "total_ic_mou", "vol_2g_mb", "vol_3g_mb", "arpu", "total_rech_amt"]


def _monthly(
    wide: DataFrame, metrics: list[str], settings: Settings, months: Iterable[str] | None
) -> DataFrame:
    """Chosen metrics per customer and month; missing, NaN and absent count as 0."""
    have = wide.columns
    rows = [
        (label, [m + suffix for m in metrics])
        for suffix, label in chosen_months(settings, months)
    ]
    identity = {
        "mobile_number": F.col("mobile_number").cast("long"),
        "circle_id": column_or(have, "circle_id", F.lit("")).cast("string"),
        "aon": column_or(have, "aon", F.lit(0)).cast("int"),
    }
    long = unpivot(wide.withColumns(identity), list(identity), metrics, rows)
    return long.withColumns({m: number(m) for m in metrics})


def usage_events(
    wide: DataFrame,
    settings: Settings = DEFAULTS,
    months: Iterable[str] | None = None,
    event_time: Column | None = None,
    ordered: bool = False,
) -> DataFrame:
    """One event per customer and month: call minutes, data, revenue, recharge.

    Missing, NaN and zero measures all become 0. `event_time` may use any output
    column; it defaults to the current time. `ordered` sorts by month and region
    as a replay would, with the customer id splitting large regions.
    """
    m = _monthly(wide, _NARROW, settings, months)
    stamp = F.current_timestamp() if event_time is None else event_time
    events = m.select(
        "mobile_number",
        "circle_id",
        "report_month",
        F.round(F.col("total_og_mou") + F.col("total_ic_mou"), 2).alias("total_calls"),
        F.round(F.col("vol_2g_mb") + F.col("vol_3g_mb"), 2).alias("total_data_mb"),
        F.round("arpu", 2).alias("arpu"),
        F.round("total_rech_amt", 2).alias("total_rech_amt"),
        stamp.alias("event_time"),
        F.lit(False).alias("_anomaly"),
    )
    return events.orderBy("report_month", "circle_id", "mobile_number") if ordered else events


def rich_usage_events(
    wide: DataFrame,
    settings: Settings = DEFAULTS,
    months: Iterable[str] | None = None,
    event_time: Column | None = None,
) -> DataFrame:
    """The 22-field event: calls by kind, recharges, data, revenue and packs."""
    m = _monthly(wide, [*RICH_MEASURES, *RICH_INTS], settings, months)
    stamp = F.current_timestamp() if event_time is None else event_time
    return m.select(
        "mobile_number",
        "circle_id",
        "aon",
        "report_month",
        *RICH_MEASURES,
        *(F.col(c).cast("int").alias(c) for c in RICH_INTS),
        stamp.alias("event_time"),
    )


def narrow_events(rich: DataFrame) -> DataFrame:
    """The fields the window rules read, from rich events or declared stream rows."""
    return rich.select(
        "mobile_number",
        "circle_id",
        "report_month",
        (F.col("total_og_mou") + F.col("total_ic_mou")).alias("total_calls"),
        (F.col("vol_2g_mb") + F.col("vol_3g_mb")).alias("total_data_mb"),
        "arpu",
        "total_rech_amt",
        "event_time",
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Message rows: key `<customer>_<month>`, value the event as JSON text."""
    return events.select(
        F.concat_ws("_", "mobile_number", "report_month").alias("key"),
        event_json(events).alias("value"),
    )


def event_json(events: DataFrame) -> Column:
    """All columns as one JSON text, timestamps as ISO text with microseconds."""
    fields = [
        F.date_format(f.name, ISO_MICROS).alias(f.name)
        if isinstance(f.dataType, t.TimestampType)
        else F.col(f"`{f.name}`")
        for f in events.schema.fields
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def decode_events(
    messages: DataFrame,
    schema: t.StructType = USAGE_EVENT,
    value: str = "value",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Events from JSON text in a column, for file lines and messages alike.

    A value that is not valid JSON, or has no usable event time, keeps its text
    in `_corrupt_record`; split it off with `good_events` and `corrupt_events`.
    `keep` names message columns, such as the key, to carry along.
    """
    text = F.col(value).cast("string")
    wanted = t.StructType([*schema.fields, t.StructField(CORRUPT, t.StringType())])
    parsed = messages.select(
        *keep,
        text.alias("_text"),
        F.from_json(text, wanted, {"columnNameOfCorruptRecord": CORRUPT}).alias("e"),
    )
    stamp = F.col("e.event_time").try_cast("timestamp")
    return parsed.select(
        *keep,
        *(F.col(f"e.{f.name}") for f in schema.fields if f.name != "event_time"),
        stamp.alias("event_time"),
        F.coalesce(F.col(f"e.{CORRUPT}"), F.when(stamp.isNull(), F.col("_text"))).alias(CORRUPT),
    )


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


__all__ = [
    "RICH_EVENT",
    "USAGE_EVENT",
    "corrupt_events",
    "decode_events",
    "event_json",
    "event_messages",
    "good_events",
    "narrow_events",
    "rich_usage_events",
    "usage_events",
]
