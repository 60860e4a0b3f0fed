"""The SQL equivalent of each query, for DuckDB over the same tables.

Fixed values: the report texts and thresholds in the SQL are the reports' contract, typed
here a second time so that the SQL stands for itself.
"""

from __future__ import annotations

METRICS = [
    "arpu", "total_rech_num", "total_rech_amt", "max_rech_amt", "total_og_mou", "total_ic_mou",
    "roam_og_mou", "roam_ic_mou", "vol_2g_mb", "vol_3g_mb", "loc_og_mou", "std_og_mou",
    "isd_og_mou", "monthly_2g", "monthly_3g", "night_pck_user", "fb_user",
]
INTS = METRICS[-4:]
YEARS = {1992 + m: (f"_{m}", f"2014-{m:02}") for m in range(3, 10)}
VBC_MONTHS = ("mar", "apr", "may", "jun", "jul", "aug", "sep")


def rnd(x: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return (
        f"CAST(CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) "
        "AS VARCHAR) AS DOUBLE)"
    )


def xsum(x: str) -> str:
    """Sum: exact for values that have six decimals, plain for all others."""
    off = f"abs(round(({x}) * 1000000) / 1000000 - ({x}))"
    fits = f"{off} <= 1e-15::DOUBLE * abs({x}) AND abs({x}) < 16777216"
    exact = f"sum(CASE WHEN {fits} THEN CAST(round(({x}) * 1000000) AS HUGEINT) END)"
    plain = f"sum(CASE WHEN NOT ({fits}) THEN {x} END)"
    exact = f"(CAST({exact} AS DOUBLE) / 1000000)"
    return f"(CASE WHEN {plain} IS NULL THEN {exact} ELSE coalesce({exact}, 0) + {plain} END)"


def xavg(x: str) -> str:
    return f"({xsum(x)} / count({x}))"


def z(x: str) -> str:
    return f"coalesce({x}, 0)"


def pct(part: str, whole: str) -> str:
    tenths = f"CAST((2000 * {part} + {whole}) // (2 * {whole}) AS BIGINT)"
    return f"CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR) || '%'"


def _usage() -> str:
    roam = "l_linestatus = 'F' AND l_discount >= 0.08"
    third = "l_returnflag = 'A' AND l_linenumber % 3"
    return f"""
yearly_orders AS (
  SELECT o_custkey AS ck, year(o_orderdate) AS y, {xsum("o_totalprice")} / 1000 AS arpu,
         CAST(count(*) AS DOUBLE) AS total_rech_num, {xsum("o_totalprice")} AS total_rech_amt,
         max(o_totalprice) AS max_rech_amt
  FROM orders GROUP BY 1, 2),
yearly_items AS (
  SELECT o_custkey AS ck, year(o_orderdate) AS y,
    sum(CASE WHEN l_returnflag = 'A' THEN l_quantity * 10 END) AS total_og_mou,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity * 10 END) AS total_ic_mou,
    sum(CASE WHEN l_returnflag = 'A' AND {roam} THEN l_quantity END) AS roam_og_mou,
    sum(CASE WHEN l_returnflag = 'R' AND {roam} THEN l_quantity END) AS roam_ic_mou,
    sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_quantity * 20 END) AS vol_2g_mb,
    sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_quantity * 20 END) AS vol_3g_mb,
    sum(CASE WHEN {third} = 0 THEN l_quantity * 10 END) AS loc_og_mou,
    sum(CASE WHEN {third} = 1 THEN l_quantity * 10 END) AS std_og_mou,
    sum(CASE WHEN {third} = 2 THEN l_quantity * 10 END) AS isd_og_mou,
    count(CASE WHEN l_linenumber = 1 THEN 1 END) AS monthly_2g,
    count(CASE WHEN l_linenumber = 2 THEN 1 END) AS monthly_3g,
    count(CASE WHEN l_linenumber = 3 THEN 1 END) AS night_pck_user,
    count(CASE WHEN l_linenumber = 4 THEN 1 END) AS fb_user,
    count(CASE WHEN l_linenumber = 5 THEN 1 END) AS vbc_3g
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
months(y, report_month) AS (
  VALUES {", ".join(f"({y}, '{label}')" for y, (_, label) in YEARS.items())}),
base AS (
  SELECT c_custkey AS mobile_number, CAST(c_nationkey AS VARCHAR) AS circle_id,
         CAST(c_custkey % 3000 AS INTEGER) AS aon, m.y, m.report_month,
         o.ck IS NOT NULL AS ordered,
         o.arpu, o.total_rech_num, o.total_rech_amt, o.max_rech_amt,
         {", ".join(f"i.{m}" for m in METRICS[4:13])},
         {", ".join(
             f"CAST(CASE WHEN o.ck IS NOT NULL THEN coalesce(i.{m}, 0) END AS INTEGER) AS {m}"
             for m in [*INTS, "vbc_3g"])}
  FROM customer CROSS JOIN months m
  LEFT JOIN yearly_orders o ON o.ck = c_custkey AND o.y = m.y
  LEFT JOIN yearly_items i ON i.ck = c_custkey AND i.y = m.y),
long AS (
  SELECT mobile_number, circle_id, aon, {", ".join(METRICS)}, report_month,
    {z("vol_2g_mb")} + {z("vol_3g_mb")} AS total_data_mb,
    CAST({z("total_og_mou")} + {z("total_ic_mou")} > 0 AS INTEGER) AS is_active_call,
    CAST({z("vol_2g_mb")} + {z("vol_3g_mb")} > 0 AS INTEGER) AS is_active_data,
    CAST({z("total_og_mou")} + {z("total_ic_mou")} > 0
      OR {z("vol_2g_mb")} + {z("vol_3g_mb")} > 0 AS INTEGER) AS is_active
  FROM base)"""


CALLS = f"({z('total_og_mou')} + {z('total_ic_mou')})"
ROAM = f"({z('roam_og_mou')} + {z('roam_ic_mou')})"


def _wide() -> str:
    columns = [
        f"max(CASE WHEN y = {y} THEN {m} END) AS {m}{suffix}"
        for m in METRICS
        for y, (suffix, _) in YEARS.items()
    ]
    columns += [
        f"max(CASE WHEN y = {y} THEN vbc_3g END) AS {name}_vbc_3g"
        for y, name in zip(YEARS, VBC_MONTHS)
    ]
    columns += [
        f"max(CASE WHEN y = {y} AND ordered THEN '{y}-12-31' END) AS last_date_of_month{suffix}"
        for y, (suffix, _) in YEARS.items()
    ]
    return f"SELECT mobile_number, circle_id, aon, {', '.join(columns)} FROM base GROUP BY 1, 2, 3"


def _kpi() -> str:
    def share(part: str) -> str:
        return rnd(f"{part} / CAST(n AS DOUBLE)", 4)

    return f"""
counted AS (
  SELECT circle_id, report_month, count(mobile_number) AS n, sum(is_active) AS act,
    avg(aon) AS avg_tenure_days,
    {xsum(z("total_og_mou"))} AS og, {xsum(z("total_ic_mou"))} AS ic,
    {xsum(z("total_rech_amt"))} AS rech, {xavg("arpu")} AS avg_arpu,
    {xsum(z("vol_2g_mb"))} AS g2, {xsum(z("vol_3g_mb"))} AS g3,
    sum(CASE WHEN {CALLS} > 500 THEN 1 ELSE 0 END) AS heavy,
    sum(CASE WHEN total_data_mb > 0 THEN 1 ELSE 0 END) AS data_users,
    sum(CASE WHEN arpu >= 500 THEN 1 ELSE 0 END) AS high,
    sum(CASE WHEN {ROAM} > 0 THEN 1 ELSE 0 END) AS roamers,
    CAST(sum(1 - is_active_call) AS BIGINT) AS zero_call_customers,
    CAST(sum(1 - is_active_data) AS BIGINT) AS zero_data_customers
  FROM long GROUP BY 1, 2),
kpi AS (
  SELECT circle_id, report_month, n AS total_customers, CAST(act AS BIGINT) AS active_customers,
    {share("act")} AS active_rate, avg_tenure_days, og AS total_og_mou, ic AS total_ic_mou,
    {rnd("(og + ic) / n", 2)} AS avg_mou_per_user, rech AS total_recharge_amt, avg_arpu,
    {rnd("rech / n", 2)} AS avg_rech_per_user, g2 AS total_2g_mb, g3 AS total_3g_mb,
    {rnd("(g2 + g3) / n", 2)} AS avg_data_mb_per_user,
    {share("heavy")} AS heavy_caller_pct, {share("data_users")} AS data_user_pct,
    {share("high")} AS high_value_pct, {share("roamers")} AS roamer_pct,
    CAST(n - act AS BIGINT) AS inactive_customers, {share("(n - act)")} AS inactive_rate,
    zero_call_customers, zero_data_customers
  FROM counted)"""


def _rank() -> str:
    def score(c: str) -> str:
        low, high = f"min({c}) OVER m", f"max({c}) OVER m"
        return (
            f"CASE WHEN {low} = {high} THEN 50.0::DOUBLE "
            f"ELSE ({c} - {low}) / ({high} - {low}) * 100 END"
        )

    total = "arpu_score * 0.4::DOUBLE + activity_score * 0.35::DOUBLE + data_score * 0.25::DOUBLE"
    return f"""
scores AS (
  SELECT *, {score("avg_arpu")} AS arpu_score, {score("active_rate")} AS activity_score,
    {score("avg_data_mb_per_user")} AS data_score
  FROM kpi WINDOW m AS (PARTITION BY report_month)),
scored AS (SELECT *, {rnd(total, 2)} AS composite_score FROM scores),
ranking AS (
  SELECT circle_id, report_month, total_customers, avg_arpu, avg_mou_per_user,
    avg_data_mb_per_user, active_rate, inactive_rate, arpu_score, activity_score, data_score,
    composite_score, CAST(row_number() OVER (
      PARTITION BY report_month ORDER BY composite_score DESC, circle_id) AS INTEGER) AS rank
  FROM scored)"""


def _compared() -> str:
    return """
compared AS (
  SELECT mobile_number, circle_id, aon, report_month, arpu, total_og_mou, total_ic_mou,
    total_data_mb, total_rech_amt, is_active_call, is_active_data,
    lag(report_month) OVER h AS prev_month, lag(arpu) OVER h AS prev_arpu,
    lag(total_og_mou) OVER h AS prev_og_mou, lag(total_ic_mou) OVER h AS prev_ic_mou,
    lag(total_data_mb) OVER h AS prev_data_mb, lag(total_rech_amt) OVER h AS prev_rech_amt
  FROM long WINDOW h AS (PARTITION BY mobile_number ORDER BY report_month))"""


def _alerts() -> str:
    def fall(now: str, before: str) -> str:
        return (
            f"CASE WHEN {before} > 0 THEN "
            + rnd(f"1 - {now} / {before}", 4)
            + " ELSE 0.0::DOUBLE END"
        )

    def text(label: str, c: str) -> str:
        return f"'{label}' || CAST({rnd(f'{c} * 100', 1)} AS VARCHAR) || '%'"

    prev_calls = f"({z('prev_og_mou')} + {z('prev_ic_mou')})"
    return f"""
declines AS (
  SELECT *, {CALLS} AS curr_calls_mou, {prev_calls} AS prev_calls_mou,
    {fall(CALLS, prev_calls)} AS calls_decline_pct,
    {fall("total_data_mb", "prev_data_mb")} AS data_decline_pct,
    {fall("total_rech_amt", "prev_rech_amt")} AS recharge_decline_pct
  FROM compared WHERE prev_og_mou IS NOT NULL),
alerts AS (
  SELECT mobile_number, circle_id, report_month, prev_month, curr_calls_mou,
    total_data_mb AS curr_data_mb, total_rech_amt AS curr_rech_amt, prev_calls_mou, prev_data_mb,
    prev_rech_amt, calls_decline_pct, data_decline_pct, recharge_decline_pct,
    CASE WHEN calls_decline_pct > 0.8 OR data_decline_pct > 0.8 THEN 'CRITICAL'
      ELSE 'WARNING' END AS alert_level,
    CASE WHEN calls_decline_pct > 0.5 THEN {text("通话下降", "calls_decline_pct")}
      ELSE {text("流量下降", "data_decline_pct")} END AS alert_reason
  FROM declines WHERE calls_decline_pct > 0.5 OR data_decline_pct > 0.5)"""


def _silent(also: str = "") -> str:
    return f"""
silent AS (
  SELECT mobile_number, circle_id, aon, report_month, prev_arpu,
    CAST({z("prev_og_mou")} + {z("prev_ic_mou")} AS DOUBLE) AS prev_total_calls,
    prev_data_mb AS prev_data, prev_rech_amt AS prev_rech,
    CASE WHEN prev_arpu >= 500 THEN 'HIGH' WHEN prev_arpu >= 200 THEN 'MEDIUM'
      ELSE 'LOW' END AS risk_level,
    CASE WHEN prev_arpu >= 500 THEN '高价值客户沉默, 建议客服48小时内回访'
      WHEN prev_arpu >= 200 THEN '中等价值客户, 建议推送优惠活动召回'
      ELSE '低价值客户, 建议短信营销触达' END AS recommendation
  FROM compared WHERE (is_active_call = 0 AND is_active_data = 0) {also})"""


def _events() -> str:
    silent = "(event_type = 'error' AND event_id % 2 = 0)"
    return f"""
ev AS (
  SELECT user_id AS mobile_number, CAST(user_id % 5 AS VARCHAR) AS circle_id,
    strftime(ts, '%Y-%m') AS report_month,
    CASE WHEN {silent} OR (event_type = 'signup' AND event_id % 4 = 0) THEN 0.0::DOUBLE
      ELSE value END AS total_calls,
    CASE WHEN {silent} OR (event_type = 'signup' AND event_id % 4 <> 0) THEN 0.0::DOUBLE
      ELSE value END AS total_data_mb,
    value * 4 AS arpu, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END
      AS total_rech_amt, ts
  FROM events)"""


def _risk(seconds: int) -> str:
    micros = seconds * 1_000_000
    c0, d0 = "total_calls = 0", "total_data_mb = 0"
    hv = "hvc > 0 AND hvs / CAST(hvc AS DOUBLE) > 0.1 AND hvc > 5"

    def rate(c: str) -> str:
        return f"({c} / CAST(n AS DOUBLE))"

    reasons = f"""concat_ws(' | ',
      CASE WHEN {rate("s")} > 0.3 THEN '高沉默率: ' || {pct("s", "n")}
        WHEN {rate("s")} > 0.15 THEN '沉默率偏高: ' || {pct("s", "n")} END,
      CASE WHEN {rate("zc")} > 0.2 THEN '零通话率: ' || {pct("zc", "n")} END,
      CASE WHEN {rate("zd")} > 0.3 THEN '零数据率: ' || {pct("zd", "n")} END,
      CASE WHEN {hv} THEN '高价值客户沉默: ' || hvs || '/' || hvc END)"""
    return f"""
win AS (
  SELECT circle_id, make_timestamp((epoch_us(ts) // {micros}) * {micros}) AS w0, count(*) AS n,
    {xavg("total_calls")} AS calls, {xavg("total_data_mb")} AS data, {xavg("arpu")} AS ar,
    {xsum("total_rech_amt")} AS rech, count(*) FILTER ({c0} AND {d0}) AS s,
    count(*) FILTER ({c0}) AS zc, count(*) FILTER ({d0}) AS zd,
    count(*) FILTER (arpu >= 500) AS hvc, count(*) FILTER (arpu >= 500 AND {c0} AND {d0}) AS hvs
  FROM ev GROUP BY 1, 2),
graded AS (
  SELECT circle_id, w0, strftime(w0, '%Y-%m-%dT%H:%M:%S') AS window_start,
    strftime(w0 + INTERVAL {seconds} SECOND, '%Y-%m-%dT%H:%M:%S') AS window_end,
    n AS customer_count, ar, {rnd("calls", 2)} AS avg_calls, {rnd("data", 2)} AS avg_data_mb,
    {rnd("ar", 2)} AS avg_arpu, {rnd("rech", 2)} AS total_recharge, s AS silent_count,
    {rnd(rate("s"), 3)} AS silent_rate, {rnd(rate("zc"), 3)} AS zero_call_rate,
    {rnd(rate("zd"), 3)} AS zero_data_rate,
    CASE WHEN {rate("s")} > 0.3 OR ({hv}) THEN 'CRITICAL'
      WHEN {rate("s")} > 0.15 OR {rate("zc")} > 0.2 OR {rate("zd")} > 0.3 THEN 'WARNING'
      ELSE 'INFO' END AS alert_level,
    CASE WHEN {reasons} = '' THEN 'Normal' ELSE {reasons} END AS alert_reason
  FROM win),
stats AS (
  SELECT strftime(w0, '%Y-%m-%dT%H:%M:%S') AS "window",
    CAST(sum(customer_count) AS BIGINT) AS total_events, count(*) AS circles_analyzed,
    count(*) FILTER (alert_level <> 'INFO') AS alerts_triggered,
    count(*) FILTER (alert_level = 'CRITICAL') AS n_critical,
    count(*) FILTER (alert_level = 'WARNING') AS n_warning,
    count(*) FILTER (alert_level = 'INFO') AS n_info
  FROM graded GROUP BY w0)"""


RISK_COLUMNS = """circle_id, window_start, window_end, customer_count, avg_calls, avg_data_mb,
  avg_arpu, total_recharge, silent_count, silent_rate, zero_call_rate, zero_data_rate,
  alert_level, alert_reason"""


def _chart() -> str:
    return f"""
chart AS (
  SELECT mobile_number, circle_id, report_month, arpu, total_rech_amt,
    total_og_mou + total_ic_mou AS total_calls, vol_2g_mb + vol_3g_mb AS total_data FROM long),
region_month AS (
  SELECT circle_id, report_month, {xavg("arpu")} AS avg_arpu,
    count(mobile_number) AS total_customers, {xavg("total_calls")} AS avg_calls,
    {xavg("total_data")} AS avg_data, {z(xsum("total_rech_amt"))} AS total_revenue
  FROM chart GROUP BY 1, 2)"""


def statements() -> dict[str, str]:
    def q(select: str, *parts: str) -> str:
        return "WITH " + ",".join(parts) + "\n" + select

    usage, events, chart = _usage(), _events(), _chart()
    kpi = [usage, _kpi()]
    rank = [*kpi, _rank()]
    compared = [usage, _compared()]
    alerts = [*compared, _alerts()]
    silent = [*compared, _silent()]
    day, five = [events, _risk(86_400)], [events, _risk(300)]

    measures = ", ".join(f"coalesce({m}, 0) AS {m}" for m in (
        "total_og_mou", "total_ic_mou", "loc_og_mou", "std_og_mou", "isd_og_mou", "roam_og_mou",
        "roam_ic_mou", "total_rech_num", "total_rech_amt", "max_rech_amt", "vol_2g_mb",
        "vol_3g_mb", "arpu", *INTS))
    stamp = "report_month || '-01T00:00:00.000000' AS event_time"
    narrow = f"""SELECT mobile_number, circle_id, report_month,
      {rnd(CALLS, 2)} AS total_calls, {rnd("total_data_mb", 2)} AS total_data_mb,
      {rnd(z("arpu"), 2)} AS arpu, {rnd(z("total_rech_amt"), 2)} AS total_rech_amt, {stamp},
      false AS _anomaly FROM long"""
    rich = f"SELECT mobile_number, circle_id, aon, report_month, {measures}, {stamp}"
    kpi_all = "SELECT * FROM kpi"
    top_alerts = "ORDER BY calls_decline_pct DESC NULLS LAST, mobile_number, report_month LIMIT 500"
    two_months = "WHERE report_month IN ('2014-07', '2014-08')"
    layers = " UNION ALL ".join(
        f"SELECT '{name}' AS layer, count(*) AS rows FROM {source}"
        for name, source in (
            ("ods_raw", "customer"), ("dwd_long", "long"), ("dws_customer_kpi", "long"),
            ("dws_circle_kpi", "kpi"), ("ads_ranking", "ranking"), ("ads_alerts", "alerts"),
            ("ads_silent", "silent"),
        )
    )

    def shown(c: str, digits: int) -> str:
        value = rnd(c, digits)
        text = f"CAST(CAST({value} AS BIGINT) AS VARCHAR)" if digits == 0 else f"CAST({value} AS VARCHAR)"
        return f"coalesce({text}, 'nan')"

    latest_rank = f"""SELECT circle_id, report_month, composite_score,
          {rnd("composite_score", 1)} AS score_label FROM ranking
        WHERE report_month = (SELECT max(report_month) FROM ranking)"""
    summary = """SELECT CAST(sum(total_events) AS BIGINT) AS total_events, count(*) AS windows,
          CAST(sum(alerts_triggered) AS BIGINT) AS total_alerts,
          CAST(sum(n_critical) AS BIGINT) AS n_critical,
          CAST(sum(n_warning) AS BIGINT) AS n_warning,
          CAST(sum(n_info) AS BIGINT) AS n_info FROM stats"""
    decline = f"""SELECT circle_id, window_start, window_end, {rnd("ar", 2)} AS avg_arpu,
          {rnd("p", 2)} AS prev_avg_arpu,
          CASE WHEN p > 0 THEN {rnd("1 - ar / p", 4)} ELSE 0.0::DOUBLE END AS arpu_decline_pct,
          CASE WHEN p > 0 AND 1 - ar / p > 0.5 THEN 'CRITICAL' ELSE 'INFO' END AS alert_level
        FROM (SELECT *, lag(ar) OVER (PARTITION BY circle_id ORDER BY w0) AS p FROM graded)"""
    return {
        "wide_table": q(_wide(), usage),
        "wide_scan_csv": q(_wide(), usage),
        "wide_to_long": q("SELECT * FROM long", usage),
        "wide_to_long_union": q("SELECT * FROM long", usage),
        "wide_to_long_two_months": q(f"SELECT * FROM long {two_months}", usage),
        "customer_month_kpi": q(
            f"""SELECT mobile_number, circle_id, aon, report_month,
              {CALLS} AS total_calls_mou, total_rech_amt, total_data_mb, arpu,
              CASE WHEN coalesce(total_rech_num, 0) > 0 THEN total_rech_amt / total_rech_num
                ELSE 0.0::DOUBLE END AS avg_rech_amt,
              CAST({CALLS} > 500 AS INTEGER) AS is_heavy_caller,
              CAST(total_data_mb > 1024 AS INTEGER) AS is_heavy_data_user,
              CAST(coalesce(arpu >= 500, false) AS INTEGER) AS is_high_value,
              CAST({ROAM} > 0 AS INTEGER) AS is_roamer,
              CAST(total_data_mb > 0 AS INTEGER) AS is_data_user,
              CAST(coalesce(vol_2g_mb, 0) > 0 AS INTEGER) AS is_2g_user,
              CAST(coalesce(vol_3g_mb, 0) > 0 AS INTEGER) AS is_3g_user FROM long""",
            usage,
        ),
        "region_month_kpi": q(kpi_all, *kpi),
        "region_month_kpi_join": q(kpi_all, *kpi),
        "region_scores": q(
            """SELECT circle_id, report_month, arpu_score, activity_score, data_score,
              composite_score FROM scored""",
            *rank,
        ),
        "region_ranking": q("SELECT * FROM ranking ORDER BY report_month, rank", *rank),
        "region_top5_month": q(
            "SELECT * FROM ranking WHERE report_month = '2014-09' ORDER BY rank LIMIT 5", *rank
        ),
        "month_over_month": q("SELECT * FROM compared", *compared),
        "month_over_month_lag": q("SELECT * FROM compared", *compared),
        "month_over_month_bucketed": q("SELECT * FROM compared", *compared),
        "usage_decline_alerts": q("SELECT * FROM alerts", *alerts),
        "usage_decline_one_month": q(
            "SELECT * FROM alerts WHERE report_month = '2014-09'", *alerts
        ),
        "usage_decline_top500": q(f"SELECT * FROM alerts {top_alerts}", *alerts),
        "silent_customers": q("SELECT * FROM silent", *silent),
        "silent_customers_join": q("SELECT * FROM silent", *silent),
        "silent_customers_bucketed": q("SELECT * FROM silent", *silent),
        "silent_top500": q(
            """SELECT * FROM silent
            ORDER BY prev_arpu DESC NULLS LAST, mobile_number, report_month LIMIT 500""",
            *silent,
        ),
        "report_top_regions": q(
            """SELECT circle_id, avg_arpu, avg_mou_per_user, active_rate, composite_score, rank
            FROM ranking WHERE report_month = '2014-09' ORDER BY rank LIMIT 5""",
            *rank,
        ),
        "report_critical_month": q(
            f"""SELECT mobile_number, circle_id, {rnd("calls_decline_pct * 100", 1)} AS
              calls_down_pct, {rnd("data_decline_pct * 100", 1)} AS data_down_pct, alert_level,
              alert_reason FROM alerts WHERE report_month = '2014-09' AND alert_level = 'CRITICAL'
            ORDER BY calls_decline_pct DESC, mobile_number LIMIT 20""",
            *alerts,
        ),
        "report_region_trend": q(
            f"""SELECT report_month, total_customers, active_customers,
              {rnd("avg_arpu", 2)} AS avg_arpu, {rnd("active_rate * 100", 1)} AS active_pct
            FROM kpi WHERE circle_id = '1' ORDER BY report_month""",
            *kpi,
        ),
        "report_silent_high": q(
            """SELECT mobile_number, circle_id, aon, prev_arpu, prev_total_calls, risk_level
            FROM silent WHERE report_month = '2014-09' AND risk_level = 'HIGH'
            ORDER BY prev_arpu DESC, mobile_number LIMIT 50""",
            *silent,
        ),
        "layer_counts": q(layers, *rank, _compared(), _alerts(), _silent()),
        "layer_counts_observed": q(layers, *rank, _compared(), _alerts(), _silent()),
        "mart_latest_rank": q(latest_rank, *rank),
        "month_rerun_corrected": q(
            "SELECT * FROM silent",
            *compared,
            _silent("OR (report_month = '2014-09' AND circle_id IN ('0', '1', '2'))"),
        ),
        "month_rerun_emptied": q("SELECT * FROM silent WHERE report_month <> '2014-09'", *silent),
        "mart_if_written": q("SELECT * FROM ranking", *rank),
        "mart_catalog_table": q("SELECT * FROM ranking", *rank),
        "mart_parquet_pruned": q("SELECT * FROM alerts WHERE report_month = '2014-09'", *alerts),
        "extract_csv_roundtrip": q("SELECT * FROM ranking", *rank),
        "usage_events": q(narrow, usage),
        "usage_events_two_months": q(f"{narrow} {two_months}", usage),
        "usage_events_absent_columns": q(
            f"""SELECT mobile_number, circle_id, report_month,
              {rnd(z("total_og_mou"), 2)} AS total_calls, {rnd(z("vol_3g_mb"), 2)} AS total_data_mb,
              {rnd(z("arpu"), 2)} AS arpu, {rnd(z("total_rech_amt"), 2)} AS total_rech_amt, {stamp},
              false AS _anomaly FROM long""",
            usage,
        ),
        "usage_events_rich": q(f"{rich} FROM long", usage),
        "usage_events_narrowed": q(
            f"""SELECT mobile_number, circle_id, report_month, {CALLS} AS total_calls,
              total_data_mb, coalesce(arpu, 0) AS arpu,
              coalesce(total_rech_amt, 0) AS total_rech_amt, {stamp} FROM long""",
            usage,
        ),
        "event_messages": q(
            f"{rich}, CAST(mobile_number AS VARCHAR) || '_' || report_month AS key FROM long",
            usage,
        ),
        "event_json_roundtrip": q(
            """SELECT mobile_number, circle_id, report_month, total_calls, total_data_mb, arpu,
              total_rech_amt, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_time FROM ev""",
            events,
        ),
        "window_risk": q(f"SELECT {RISK_COLUMNS} FROM graded", *day),
        "window_risk_5min": q(f"SELECT {RISK_COLUMNS} FROM graded", *five),
        "risk_alerts": q(
            f"SELECT {RISK_COLUMNS} FROM graded WHERE alert_level <> 'INFO'", *day
        ),
        "risk_alert_stream": q(
            f"SELECT {RISK_COLUMNS} FROM graded WHERE alert_level <> 'INFO'", *day
        ),
        "risk_alert_stream_5min": q(
            f"SELECT {RISK_COLUMNS} FROM graded WHERE alert_level <> 'INFO'", *five
        ),
        "stream_corrupt_lines": "SELECT '{broken ' || event_id AS line FROM events",
        "alert_topic_messages": q(
            f"SELECT circle_id AS key, {RISK_COLUMNS} FROM graded WHERE alert_level <> 'INFO'",
            *day,
        ),
        "risk_alert_late": q(
            f"SELECT {RISK_COLUMNS} FROM graded WHERE alert_level <> 'INFO'", *day
        ),
        "one_pass_alerts": q(
            f"SELECT {RISK_COLUMNS} FROM graded WHERE alert_level <> 'INFO'", *day
        ),
        "one_pass_stats": q("SELECT * FROM stats", *day),
        "one_pass_corrupt_lines": "SELECT '{broken ' || event_id AS line FROM events",
        "one_pass_totals": q(
            "SELECT (SELECT count(*) FROM ev) AS events, (SELECT count(*) FROM events) AS corrupt_lines",
            events,
        ),
        "late_rows_repaired": q(f"SELECT {RISK_COLUMNS} FROM graded", *day),
        "idle_end_stats": q("SELECT * FROM stats", *day),
        "one_pass_arpu_decline": q(decline, *day),
        "window_stats": q("SELECT * FROM stats", *day),
        "window_stats_stream": q("SELECT * FROM stats", *day),
        "alert_summary": q(summary, *five),
        "one_pass_summary": q(summary, *day),
        "window_arpu_decline": q(decline, *day),
        "window_top_alerts": q(
            """SELECT window_start, CAST(r AS INTEGER) AS position, alert_level, circle_id,
              customer_count, silent_rate, zero_call_rate, alert_reason
            FROM (SELECT *, row_number() OVER (PARTITION BY window_start
                ORDER BY alert_level, silent_rate DESC, circle_id) AS r
              FROM graded WHERE alert_level <> 'INFO') WHERE r <= 3""",
            *day,
        ),
        "dashboard_region_month": q("SELECT * FROM region_month", usage, chart),
        "dashboard_month_trend": q(
            f"""SELECT report_month, {xavg("arpu")} AS avg_arpu,
              {z(xsum("total_rech_amt"))} AS total_revenue,
              count(*) FILTER (total_calls > 0) AS active_users,
              {xavg("total_calls")} AS total_calls_avg, {xavg("total_data")} AS total_data_avg
            FROM chart GROUP BY 1""",
            usage,
            chart,
        ),
        "dashboard_latest_bubble": q(
            """SELECT circle_id, report_month, avg_arpu, avg_calls, total_customers,
              CAST(total_customers AS DOUBLE) / max(total_customers) OVER () * 50 AS bubble_size
            FROM region_month
            WHERE report_month = (SELECT max(report_month) FROM region_month)""",
            usage,
            chart,
        ),
        "dashboard_latest_rank": q(latest_rank, *rank),
        "dashboard_usage_sample": q(
            f"""SELECT mobile_number, circle_id, report_month,
              CASE WHEN total_calls > 2000 THEN 2000.0::DOUBLE ELSE total_calls END AS x_calls,
              CASE WHEN total_data > 5000 THEN 5000.0::DOUBLE ELSE total_data END AS y_data, arpu,
              'Circle ' || circle_id || '<br>Calls: ' || {shown("total_calls", 0)}
                || 'min<br>Data: ' || {shown("total_data", 0)} || 'MB<br>ARPU: '
                || {shown("arpu", 1)} AS hover
            FROM (SELECT * FROM chart
              ORDER BY md5(CAST(mobile_number AS VARCHAR) || '|' || report_month || '|42'),
                mobile_number, report_month LIMIT 5000)""",
            usage,
            chart,
        ),
    }
