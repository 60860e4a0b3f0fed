"""Column contracts of inputs and tables.

Fixed values: these names and types are the data contract of the producers and
of the report consumers.
"""

from __future__ import annotations

from pyspark.sql import types as t

from meterwell.settings import DEFAULTS, Settings

_TYPES = {
    "long": t.LongType(),
    "int": t.IntegerType(),
    "double": t.DoubleType(),
    "string": t.StringType(),
    "boolean": t.BooleanType(),
}


def struct(**columns: str) -> t.StructType:
    """Nullable schema from column=type pairs, in order."""
    return t.StructType([t.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def _all(kind: str, names: list[str]) -> dict[str, str]:
    return dict.fromkeys(names, kind)


# Metrics of the wide table that come once per month.
MONTHLY_DOUBLES = [
    "arpu",
    "onnet_mou", "offnet_mou", "roam_og_mou", "roam_ic_mou",
    "loc_og_mou", "std_og_mou", "isd_og_mou", "total_og_mou",
    "loc_ic_mou", "std_ic_mou", "isd_ic_mou", "total_ic_mou",
    "total_rech_num", "total_rech_amt", "max_rech_amt",
    "vol_2g_mb", "vol_3g_mb",
]
MONTHLY_INTS = ["monthly_2g", "monthly_3g", "sachet_2g", "sachet_3g", "night_pck_user", "fb_user"]
STATIC_DOUBLES = ["loc_og_t2o_mou", "std_og_t2o_mou", "loc_ic_t2o_mou"]
STATIC_INTS = ["jun_vbc_3g", "jul_vbc_3g", "aug_vbc_3g", "sep_vbc_3g"]

_CUSTOMER = {"mobile_number": "long", "circle_id": "string", "aon": "int"}


def wide_schema(settings: Settings = DEFAULTS) -> t.StructType:
    """The declared wide table: static columns and each metric for each month."""

    def monthly(kind: str, names: list[str]) -> dict[str, str]:
        return {name + suffix: kind for name in names for suffix, _ in settings.months}

    return struct(
        **_CUSTOMER,
        **_all("double", STATIC_DOUBLES),
        **monthly("string", sorted(settings.skipped_metrics)),
        **monthly("double", MONTHLY_DOUBLES),
        **monthly("int", MONTHLY_INTS),
        **_all("int", STATIC_INTS),
    )


USAGE_EVENT = struct(
    mobile_number="long",
    circle_id="string",
    report_month="string",
    total_calls="double",
    total_data_mb="double",
    arpu="double",
    total_rech_amt="double",
    event_time="string",
    _anomaly="boolean",
)

RICH_MEASURES = [
    "total_og_mou", "total_ic_mou", "loc_og_mou", "std_og_mou", "isd_og_mou",
    "roam_og_mou", "roam_ic_mou", "total_rech_num", "total_rech_amt", "max_rech_amt",
    "vol_2g_mb", "vol_3g_mb", "arpu",
]
RICH_INTS = ["monthly_2g", "monthly_3g", "night_pck_user", "fb_user"]

RICH_EVENT = struct(
    **_CUSTOMER,
    report_month="string",
    **_all("double", RICH_MEASURES),
    **_all("int", RICH_INTS),
    event_time="string",
)

STREAM_ROW_FIELDS = [
    "mobile_number", "circle_id", "aon", "report_month",
    "total_og_mou", "total_ic_mou", "total_rech_amt", "max_rech_amt",
    "vol_2g_mb", "vol_3g_mb", "arpu",
    "monthly_2g", "monthly_3g", "night_pck_user", "fb_user", "event_time",
]

STREAM_ROW = t.StructType([f for f in RICH_EVENT.fields if f.name in STREAM_ROW_FIELDS])

RISK_ALERT = struct(
    circle_id="string",
    window_start="string",
    window_end="string",
    customer_count="long",
    avg_calls="double",
    avg_data_mb="double",
    avg_arpu="double",
    total_recharge="double",
    silent_count="long",
    silent_rate="double",
    zero_call_rate="double",
    zero_data_rate="double",
    alert_level="string",
    alert_reason="string",
)

WINDOW_STATS = struct(
    window="string",
    total_events="long",
    circles_analyzed="long",
    alerts_triggered="long",
    n_critical="long",
    n_warning="long",
    n_info="long",
)

# Warehouse tables by name; the partition column comes last in storage.
TABLES: dict[str, t.StructType] = {
    "dws_customer_monthly_kpi": struct(
        **_CUSTOMER,
        report_month="string",
        total_calls_mou="double",
        total_rech_amt="double",
        total_data_mb="double",
        arpu="double",
        avg_rech_amt="double",
        is_heavy_caller="int",
        is_heavy_data_user="int",
        is_high_value="int",
        is_roamer="int",
        is_data_user="int",
        is_2g_user="int",
        is_3g_user="int",
    ),
    "dws_circle_monthly_kpi": struct(
        circle_id="string",
        report_month="string",
        total_customers="long",
        active_customers="long",
        active_rate="double",
        avg_tenure_days="double",
        total_og_mou="double",
        total_ic_mou="double",
        avg_mou_per_user="double",
        total_recharge_amt="double",
        avg_arpu="double",
        avg_rech_per_user="double",
        total_2g_mb="double",
        total_3g_mb="double",
        avg_data_mb_per_user="double",
        heavy_caller_pct="double",
        data_user_pct="double",
        high_value_pct="double",
        roamer_pct="double",
        inactive_customers="long",
        inactive_rate="double",
        zero_call_customers="long",
        zero_data_customers="long",
    ),
    "ads_circle_performance_ranking": struct(
        circle_id="string",
        report_month="string",
        total_customers="long",
        avg_arpu="double",
        avg_mou_per_user="double",
        avg_data_mb_per_user="double",
        active_rate="double",
        inactive_rate="double",
        arpu_score="double",
        activity_score="double",
        data_score="double",
        composite_score="double",
        rank="int",
    ),
    "ads_usage_decline_alert": struct(
        mobile_number="long",
        circle_id="string",
        report_month="string",
        prev_month="string",
        curr_calls_mou="double",
        curr_data_mb="double",
        curr_rech_amt="double",
        prev_calls_mou="double",
        prev_data_mb="double",
        prev_rech_amt="double",
        calls_decline_pct="double",
        data_decline_pct="double",
        recharge_decline_pct="double",
        alert_level="string",
        alert_reason="string",
    ),
    "ads_silent_customer_report": struct(
        **_CUSTOMER,
        report_month="string",
        prev_arpu="double",
        prev_total_calls="double",
        prev_data="double",
        prev_rech="double",
        risk_level="string",
        recommendation="string",
    ),
}

RAW_TABLE = "ods_telecom_raw"
DETAIL_TABLE = "dwd_customer_monthly"


def declared_schema(name: str, settings: Settings = DEFAULTS) -> t.StructType:
    """Columns a table has before anything is written to it.

    The raw and the detail table take further metrics from their input.
    """
    if name == RAW_TABLE:
        return wide_schema(settings)
    if name == DETAIL_TABLE:
        return struct(
            **_CUSTOMER,
            **_all("double", MONTHLY_DOUBLES),
            **_all("int", MONTHLY_INTS),
            report_month="string",
            total_data_mb="double",
            is_active_call="int",
            is_active_data="int",
            is_active="int",
        )
    return TABLES[name]


# Partition column of every warehouse table.
PARTITIONED_BY = {RAW_TABLE: "circle_id", DETAIL_TABLE: "report_month"} | dict.fromkeys(
    TABLES, "report_month"
)


def mismatches(actual: t.StructType, contract: t.StructType) -> list[str]:
    """Columns that are missing or of another type, as readable lines."""
    have = {f.name: f.dataType for f in actual.fields}
    return [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"got {have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in contract.fields
        if have.get(f.name) != f.dataType
    ]
