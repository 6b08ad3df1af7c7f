"""The telemetry queries in DuckDB's SQL, over the events table."""

from __future__ import annotations

K = "cast(json_extract_string(props, '$.k') AS double)"
_T = f"""
T0 AS (
    SELECT event_id AS row_id, 'GEN' || (user_id % 10) AS generator_id, 'S' || (user_id % 5) AS site_name, ts AS timestamp,
           CASE WHEN event_id % 7 <> 0 THEN value END AS fuel_level_l, CASE WHEN event_id % 11 <> 0 THEN {K} END AS current,
           40.0 + {K} % 20 AS battery_voltage,
           CASE WHEN event_type IN ('click', 'view') THEN 'running' WHEN event_type IN ('purchase', 'signup') THEN 'stopped' END AS status
    FROM events),
T AS (SELECT *, epoch_us(timestamp) AS us, (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER w) / 1e6 AS gap FROM T0 WINDOW w AS (PARTITION BY generator_id ORDER BY timestamp, row_id)),
R AS (SELECT * FROM T0 UNION ALL SELECT row_id + 1000000000, generator_id, site_name, timestamp, fuel_level_l, NULL, battery_voltage, status FROM T0 WHERE row_id % 50 = 0)"""
_D = """,
D AS (
    SELECT *, fuel_level_l - lag(fuel_level_l) OVER w AS fuel_delta, current - lag(current) OVER w AS current_delta, battery_voltage - lag(battery_voltage) OVER w AS voltage_delta,
           -(fuel_level_l - lag(fuel_level_l) OVER w) / nullif(gap, 0) AS fuel_rate_lps
    FROM T WINDOW w AS (PARTITION BY generator_id ORDER BY timestamp, row_id))"""
_S = (
    _D
    + """,
S1 AS (
    SELECT *, current IS NOT NULL AS kc, battery_voltage >= 48 IS TRUE AS kb, fuel_delta IS NOT NULL AS kf,
           coalesce(current >= 30, false) AS rc, coalesce(fuel_delta < -0.02, false) AS rf,
           CASE WHEN current >= 150 THEN 1.0::DOUBLE WHEN current >= 80 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS sc
    FROM D),
S2 AS (
    SELECT *, 0.5::DOUBLE * kc::INT + 0.3::DOUBLE * kb::INT + 0.2::DOUBLE * kf::INT AS known,
           CASE WHEN rc THEN sc * 0.5::DOUBLE ELSE 0 END + CASE WHEN kb THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN rf THEN 0.2::DOUBLE ELSE 0 END AS score,
           rc::INT + kb::INT + rf::INT AS running, (kc AND NOT rc)::INT + (kf AND NOT rf)::INT AS stopped
    FROM S1),
S3 AS (SELECT *, round_even(CASE WHEN known = 0 THEN 0.5 ELSE score / known END, 3) AS running_probability FROM S2),
S4 AS (
    SELECT *, CASE WHEN running_probability >= 0.75 AND coalesce(current, 0) >= 150 THEN 'Running (High Load)' WHEN running_probability >= 0.75 AND coalesce(current, 0) >= 80 THEN 'Running (Medium Load)'
                   WHEN running_probability >= 0.75 THEN 'Running (Low Load)' WHEN running_probability >= 0.55 AND coalesce(current, 0) >= 30 THEN 'Running (Low Load)'
                   WHEN running_probability >= 0.55 THEN 'Idle' ELSE 'Unknown' END AS estimated_status,
           CASE WHEN running + stopped = 0 THEN 0 ELSE round_even(least(100, greatest(running, stopped) / (running + stopped) * 60 + abs(running_probability - 0.5) * 2 * 40), 2) END AS estimated_confidence
    FROM S3),
S AS (
    SELECT *, CASE WHEN estimated_confidence >= 90 THEN 'Very High' WHEN estimated_confidence >= 75 THEN 'High' WHEN estimated_confidence >= 50 THEN 'Medium' WHEN estimated_confidence >= 25 THEN 'Low' ELSE 'Very Low' END AS confidence_level,
           coalesce((status = 'running') <> contains(estimated_status, 'Running'), false) AS status_conflict,
           concat_ws('. ', CASE WHEN current IS NOT NULL THEN 'Current ' || printf('%.2f', current) || CASE WHEN current >= 150 THEN 'A indicates high load' WHEN current >= 80 THEN 'A indicates medium load' WHEN current >= 30 THEN 'A indicates low load' ELSE 'A below running threshold' END END,
                     CASE WHEN battery_voltage >= 48 THEN 'Battery ' || printf('%.2f', battery_voltage) || 'V indicates charging' END,
                     CASE WHEN fuel_delta < -0.02 THEN 'Fuel is decreasing' WHEN fuel_delta IS NOT NULL THEN 'Fuel is steady' END) AS says
    FROM S4)"""
)
_V = (
    _S
    + """,
V1 AS (
    SELECT *, coalesce(fuel_level_l NOT BETWEEN 0 AND 5000, false) AS fuel_invalid, coalesce(abs(fuel_delta) > 50, false) AS fuel_outlier,
           coalesce(current NOT BETWEEN 0 AND 500, false) AS current_invalid, coalesce(abs(current_delta) > 150, false) AS current_outlier,
           coalesce(battery_voltage NOT BETWEEN 0 AND 70, false) AS battery_invalid, coalesce(current > 20 AND battery_voltage < 10, false) AS battery_current_mismatch,
           coalesce((contains(estimated_status, 'Running') AND current <= 5) OR (estimated_status IN ('Stopped', 'Idle') AND current > 30), false) AS state_sensor_mismatch,
           count(*) OVER (PARTITION BY generator_id, timestamp) > 1 AS timestamp_duplicate, coalesce(gap > 180, false) AS timestamp_gap
    FROM S),
V AS (
    SELECT *, greatest(0, 100.0::DOUBLE - 20 * fuel_invalid::INT - 15 * fuel_outlier::INT - 20 * current_invalid::INT - 15 * current_outlier::INT - 15 * battery_invalid::INT - 5 * battery_current_mismatch::INT - 10 * state_sensor_mismatch::INT - 10 * timestamp_duplicate::INT - 15 * timestamp_gap::INT) AS telemetry_quality_score,
           concat_ws('; ', CASE WHEN fuel_invalid THEN 'Invalid fuel level' END, CASE WHEN fuel_outlier THEN 'Fuel spike detected' END, CASE WHEN current_invalid THEN 'Invalid current' END, CASE WHEN current_outlier THEN 'Current spike detected' END, CASE WHEN battery_invalid THEN 'Invalid battery voltage' END,
                     CASE WHEN battery_current_mismatch THEN 'Current load detected but battery charging signal missing' END, CASE WHEN state_sensor_mismatch THEN 'Estimated state conflicts with sensor behavior' END, CASE WHEN timestamp_duplicate THEN 'Duplicate telemetry' END, CASE WHEN timestamp_gap THEN 'Telemetry delay detected' END) AS problems
    FROM V1)"""
)


def _line(c: str, limit: int) -> str:
    """Interpolation of c by row position, at most limit rows from a value."""
    return f"""CASE WHEN {c} IS NOT NULL THEN {c}
        WHEN b_{c} IS NOT NULL AND a_{c} IS NOT NULL THEN CASE WHEN n - nb_{c} <= {limit} OR na_{c} - n <= {limit} THEN b_{c} + (a_{c} - b_{c}) * (n - nb_{c}) / (na_{c} - nb_{c}) END
        WHEN b_{c} IS NOT NULL THEN CASE WHEN n - nb_{c} <= {limit} THEN b_{c} END
        WHEN a_{c} IS NOT NULL THEN CASE WHEN na_{c} - n <= {limit} THEN a_{c} END END"""


def _neighbours(source: str) -> str:
    cs = ("fuel_level_l", "current", "battery_voltage")
    back = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    ahead = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    w = "PARTITION BY generator_id ORDER BY timestamp, row_id"
    found = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({w} {back}) AS b_{c}, last_value(CASE WHEN {c} IS NOT NULL THEN n END IGNORE NULLS) OVER ({w} {back}) AS nb_{c}, "
        f"first_value({c} IGNORE NULLS) OVER ({w} {ahead}) AS a_{c}, first_value(CASE WHEN {c} IS NOT NULL THEN n END IGNORE NULLS) OVER ({w} {ahead}) AS na_{c}"
        for c in cs
    )
    return f"N0 AS (SELECT *, row_number() OVER ({w}) AS n FROM {source}), N AS (SELECT *, {found} FROM N0)"


_I = (
    _V
    + f""",
{_neighbours("V")},
I1 AS (SELECT * EXCLUDE (fuel_level_l, current, battery_voltage, status), {", ".join(f"{_line(c, 10)} AS {c}, {c} AS raw_{c}" for c in ("fuel_level_l", "current", "battery_voltage"))}, status AS raw_status,
       coalesce(status, CASE WHEN contains(lower(estimated_status), 'running') OR estimated_status = 'Idle' THEN 'running' WHEN contains(lower(estimated_status), 'stopped') THEN 'stopped' ELSE 'unknown' END) AS status FROM N),
I2 AS (SELECT *, raw_fuel_level_l IS NULL AND fuel_level_l IS NOT NULL AS fuel_imputed, raw_current IS NULL AND current IS NOT NULL AS current_imputed,
       raw_battery_voltage IS NULL AND battery_voltage IS NOT NULL AS battery_imputed, raw_status IS NULL AS status_imputed FROM I1),
I3 AS (SELECT *, round_even(greatest(0, (100.0::DOUBLE - 20 * fuel_imputed::INT - 20 * current_imputed::INT - 20 * battery_imputed::INT - 15 * status_imputed::INT) * telemetry_quality_score / 100), 2) AS imputation_confidence FROM I2),
I AS (SELECT *, CASE WHEN imputation_confidence >= 90 THEN 'Very High' WHEN imputation_confidence >= 75 THEN 'High' WHEN imputation_confidence >= 50 THEN 'Medium' WHEN imputation_confidence >= 25 THEN 'Low' ELSE 'Very Low' END AS imputation_confidence_level FROM I3)"""
)
_H = (
    _I
    + """,
H1 AS (
    SELECT *, greatest(0, 100.0::DOUBLE - 60 * coalesce(fuel_level_l NOT BETWEEN 0 AND 2000, false)::INT - 20 * fuel_outlier::INT - 10 * fuel_imputed::INT) AS fuel_sensor_health,
           greatest(0, 100.0::DOUBLE - 60 * coalesce(current NOT BETWEEN 0 AND 400, false)::INT - 20 * current_outlier::INT - 10 * current_imputed::INT) AS current_sensor_health,
           greatest(0, 100.0::DOUBLE - 60 * coalesce(battery_voltage NOT BETWEEN 0 AND 60, false)::INT - 10 * battery_imputed::INT - 15 * battery_current_mismatch::INT) AS battery_sensor_health,
           greatest(0, 100.0::DOUBLE - 30 * status_conflict::INT - 15 * status_imputed::INT) AS status_sensor_health
    FROM I),
H2 AS (SELECT *, round_even((fuel_sensor_health + current_sensor_health + battery_sensor_health + status_sensor_health) / 4, 2) AS overall_sensor_health FROM H1),
H AS (SELECT *, CASE WHEN overall_sensor_health >= 90 THEN 'None' WHEN overall_sensor_health >= 75 THEN 'Low' WHEN overall_sensor_health >= 50 THEN 'Medium' WHEN overall_sensor_health >= 25 THEN 'High' ELSE 'Critical' END AS maintenance_priority FROM H2)"""
)
_A = (
    _V
    + """,
A1 AS (
    SELECT *, coalesce(fuel_delta < -5, false) AS fuel_theft, coalesce(fuel_delta > 5, false) AS refueling, coalesce(abs(fuel_delta) > 10, false) AS fuel_spike,
           coalesce(max(fuel_level_l) OVER w10 = min(fuel_level_l) OVER w10 AND count(fuel_level_l) OVER w10 = 10, false) AS fuel_stuck,
           coalesce(abs(current_delta) > 50, false) AS current_spike, coalesce(contains(estimated_status, 'Running') AND current <= 1, false) AS current_zero_running,
           coalesce(battery_voltage < 44, false) AS battery_low, coalesce(abs(voltage_delta) > 5, false) AS battery_spike,
           coalesce(CASE WHEN count(battery_voltage) OVER w5 = 5 THEN round(stddev_samp(battery_voltage) OVER w5, 9) END > 2, false) AS battery_unstable,
           concat_ws(', ', CASE WHEN contains(estimated_status, 'Running') AND current <= 1 THEN 'Running but zero current' END, CASE WHEN contains(estimated_status, 'Stopped') AND current > 10 THEN 'Stopped but current detected' END,
                     CASE WHEN contains(estimated_status, 'Stopped') AND fuel_delta < -0.2 THEN 'Fuel decreasing while stopped' END, CASE WHEN contains(estimated_status, 'Running') AND (battery_voltage IS NULL OR battery_voltage <= 0) THEN 'Battery unavailable' END) AS state_anomaly_reason,
           timestamp_duplicate::INT + timestamp_gap::INT + (telemetry_quality_score < 80)::INT AS trouble
    FROM V WINDOW w10 AS (PARTITION BY generator_id ORDER BY timestamp, row_id ROWS 9 PRECEDING), w5 AS (PARTITION BY generator_id ORDER BY timestamp, row_id ROWS 4 PRECEDING)),
A2 AS (
    SELECT *, state_anomaly_reason <> '' AS state_anomaly, trouble > 0 AS telemetry_anomaly, CASE trouble WHEN 0 THEN '' WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END AS telemetry_severity,
           least(100, 40.0::DOUBLE * fuel_theft::INT + 15 * refueling::INT + 25 * fuel_spike::INT + 20 * fuel_stuck::INT) AS f, least(100, 50.0::DOUBLE * current_spike::INT + 50 * current_zero_running::INT) AS c,
           least(100, 40.0::DOUBLE * battery_low::INT + 30 * battery_spike::INT + 30 * battery_unstable::INT) AS b
    FROM A1),
A3 AS (SELECT *, least(100, round_even(0.35::DOUBLE * f + 0.2::DOUBLE * c + 0.2::DOUBLE * b + 15 * state_anomaly::INT + 10 * telemetry_anomaly::INT, 2)) AS overall_anomaly_score FROM A2),
A AS (
    SELECT *, overall_anomaly_score > 20 AS anomaly_flag, CASE WHEN overall_anomaly_score = 0 THEN 'None' WHEN overall_anomaly_score < 25 THEN 'Low' WHEN overall_anomaly_score < 50 THEN 'Medium' WHEN overall_anomaly_score < 75 THEN 'High' ELSE 'Critical' END AS anomaly_severity,
           list_filter([CASE WHEN fuel_theft THEN 'Fuel theft suspected' END, CASE WHEN refueling THEN 'Refueling event' END, CASE WHEN fuel_stuck THEN 'Fuel sensor stuck' END, CASE WHEN current_spike THEN 'Current spike' END, CASE WHEN current_zero_running THEN 'Zero current while running' END,
                        CASE WHEN battery_low THEN 'Low battery' END, CASE WHEN battery_spike THEN 'Battery voltage spike' END, CASE WHEN battery_unstable THEN 'Battery unstable' END, CASE WHEN state_anomaly THEN 'Generator state conflict' END, CASE WHEN telemetry_anomaly THEN 'Telemetry issue' END], lambda x: x IS NOT NULL) AS found,
           list_sort(list_distinct(list_filter([CASE WHEN fuel_theft THEN 'Inspect fuel tank' END, CASE WHEN refueling THEN 'Verify refill' END, CASE WHEN fuel_stuck THEN 'Inspect fuel sensor' END, CASE WHEN current_spike THEN 'Inspect electrical load' END, CASE WHEN current_zero_running THEN 'Inspect current sensor' END,
                        CASE WHEN battery_low THEN 'Check battery' END, CASE WHEN battery_spike THEN 'Inspect charging system' END, CASE WHEN battery_unstable THEN 'Inspect battery' END, CASE WHEN state_anomaly THEN 'Verify generator state' END, CASE WHEN telemetry_anomaly THEN 'Inspect communication' END], lambda x: x IS NOT NULL))) AS acts
    FROM A3)"""
)
_TARGET = """,
valid AS (SELECT generator_id, timestamp, row_id, fuel_level_l FROM T WHERE fuel_level_l >= 0),
hit AS (SELECT T.*, v.fuel_level_l AS v, epoch_us(v.timestamp) AS vu FROM T ASOF LEFT JOIN valid v ON T.generator_id = v.generator_id AND T.timestamp + INTERVAL 3 HOUR <= v.timestamp),
F AS (SELECT * EXCLUDE (v, vu), CASE WHEN vu - us - 10800000000 <= 3600000000 THEN v END AS target_fuel, CASE WHEN vu - us - 10800000000 <= 3600000000 THEN vu END AS target_us FROM hit),
P AS (SELECT F.*, v.fuel_level_l AS persistence, epoch_us(v.timestamp) AS persistence_us FROM F ASOF LEFT JOIN valid v ON F.generator_id = v.generator_id AND F.timestamp >= v.timestamp),
E AS (SELECT *, persistence - target_fuel AS error, abs(persistence - target_fuel) AS absolute_error FROM P)"""
_GRID = """,
first_in_hour AS (SELECT * FROM (SELECT *, date_trunc('hour', timestamp) AS h, row_number() OVER (PARTITION BY generator_id, date_trunc('hour', timestamp) ORDER BY timestamp, row_id) AS k FROM T) WHERE k = 1),
hours AS (SELECT generator_id, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM first_in_hour GROUP BY generator_id),
G AS (
    SELECT hours.generator_id, hours.h, f.fuel_level_l, f.current, f.battery_voltage, f.status,
           coalesce(last_value(f.site_name IGNORE NULLS) OVER (PARTITION BY hours.generator_id ORDER BY hours.h ROWS UNBOUNDED PRECEDING), first_value(f.site_name IGNORE NULLS) OVER (PARTITION BY hours.generator_id ORDER BY hours.h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS site_name,
           f.fuel_level_l IS NULL AND f.current IS NULL AND f.battery_voltage IS NULL AND f.status IS NULL AS is_inserted_timestamp
    FROM hours LEFT JOIN first_in_hour f ON hours.generator_id = f.generator_id AND hours.h = f.h)"""
_C = """,
gaps AS (SELECT generator_id, gap FROM T WHERE gap > 1 AND gap <= 20000),
base AS (SELECT generator_id, mode(x ORDER BY x) AS base FROM (SELECT generator_id, round_even(gap, 0) AS x FROM gaps) GROUP BY generator_id),
cs AS (
    SELECT generator_id, any_value(base) AS base, count(*) AS samples, count(*) FILTER (abs(gap - base) <= greatest(5, 0.08::DOUBLE * base)) AS cluster,
           quantile_cont(gap, 0.5) FILTER (abs(gap - base) <= greatest(10, 0.25::DOUBLE * base)) AS middle, min(gap) AS least, max(gap) AS most, avg(gap) AS mean, quantile_cont(gap, 0.5) AS median, stddev_pop(gap) AS spread
    FROM gaps JOIN base USING (generator_id) GROUP BY generator_id),
C AS (
    SELECT i.generator_id, CAST(CASE WHEN samples >= 30 THEN round_even(middle, 0) ELSE 60 END AS INT) AS interval,
           round(CASE WHEN samples >= 30 THEN greatest(0, least(100, 100 * cluster / samples - 100 * spread / base)) ELSE 0 END, 4) AS confidence, coalesce(samples, 0) AS samples, coalesce(cluster, 0) AS cluster,
           round(least, 4) AS least, round(median, 4) AS median, round(mean, 4) AS mean, round(most, 4) AS most, round(spread, 4) AS spread
    FROM (SELECT DISTINCT generator_id FROM T) i LEFT JOIN cs USING (generator_id))"""


def _with(more: str, select: str) -> str:
    return f"WITH {_T.strip()}{more}\n{select}"


_UNPIVOT = "SELECT feature, n_missing, round(100 * n_missing / n, 4) AS percent FROM (SELECT {c} AS feature, count(*) AS n, count(*) FILTER ({x} IS NULL) AS n_missing FROM {t})"


def _missing(source: str) -> str:
    return " UNION ALL ".join(_UNPIVOT.format(c=f"'{c}'", x=c, t=source) for c in ("fuel_level_l", "current", "battery_voltage", "status"))


_KIND = "(fuel_level_l IS NULL)::INT + (current IS NULL)::INT + (battery_voltage IS NULL)::INT + (status IS NULL)::INT"
OVERVIEW = _with("", "SELECT count(*) AS n_rows, 8::BIGINT AS n_columns, count(DISTINCT generator_id) AS n_generators, count(DISTINCT site_name) AS n_sites, min(us) AS first_us, max(us) AS last_us FROM T")
MISSING = _with("", _missing("T"))
PACKETS = _with(f", kinds AS (SELECT CASE {_KIND} WHEN 0 THEN 'Complete' WHEN 4 THEN 'Empty' ELSE 'Partial' END AS packet_type FROM T)", "SELECT packet_type, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM kinds GROUP BY packet_type")
PARTIAL = _with(f", kinds AS (SELECT * FROM T WHERE {_KIND} BETWEEN 1 AND 3)", _missing("kinds"))
GENERATORS = _with("", """SELECT generator_id, first_us, last_us, expected, actual, greatest(0, expected - actual) AS missing, actual - times AS duplicates, round(100 * actual / expected, 4) AS availability
FROM (SELECT generator_id, min(epoch_us(timestamp)) AS first_us, max(epoch_us(timestamp)) AS last_us, CAST(floor((max(epoch_us(timestamp)) - min(epoch_us(timestamp))) / 60e6) AS BIGINT) + 1 AS expected, count(*) AS actual, count(DISTINCT timestamp) AS times FROM R GROUP BY generator_id)""")  # fmt: skip
GAP_HISTOGRAM = _with("", " UNION ALL ".join(f"SELECT '{name}' AS gap_class, count(*) FILTER (gap > {low}{'' if high is None else f' AND gap <= {high}'}) AS n FROM T" for name, low, high in [("<30 s", 0, 30), ("30-90 s", 30, 90), ("90-150 s", 90, 150), ("150-300 s", 150, 300), ("300-900 s", 300, 900), (">900 s", 900, None)]))
GAP_EVENTS = _with("", "SELECT generator_id, row_id, us AS gap_end_us, round(gap / 60, 4) AS gap_minutes FROM T WHERE gap / 60 > 60")
GAP_CATEGORIES = _with("", "SELECT CASE WHEN gap IS NULL THEN 'unknown' WHEN gap <= 120 THEN 'normal' WHEN gap <= 300 THEN 'short' WHEN gap <= 1800 THEN 'medium' ELSE 'long' END AS category, count(*) AS n FROM T GROUP BY ALL")
MISSING_HOURS = _with(_GRID, "SELECT generator_id, epoch_us(h) AS period_us FROM hours ANTI JOIN first_in_hour USING (generator_id, h)")
CROSSTAB = _with("", f"SELECT coalesce(status, 'none') AS status, count(*) FILTER ({_KIND} = 0) AS complete, count(*) FILTER ({_KIND} BETWEEN 1 AND 3) AS partial, count(*) FILTER ({_KIND} = 4) AS empty FROM T GROUP BY ALL")
DESCRIBE = _with("", " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c})::DOUBLE AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS least, round(max({c}), 4) AS most, " + ", ".join(f"round(quantile_cont({c}, {q}), 4) AS p{int(q * 100)}" for q in (0.25, 0.5, 0.75)) + " FROM T" for c in ("fuel_level_l", "current", "battery_voltage")))
_STABILITY = "CASE WHEN confidence >= 95 THEN 'Excellent' WHEN confidence >= 85 THEN 'Good' WHEN confidence >= 70 THEN 'Moderate' WHEN confidence >= 50 THEN 'Poor' ELSE 'Unstable' END AS stability"
CADENCE = _with(_C, f"SELECT *, {_STABILITY} FROM C")
CADENCE_PEAK = _with(_C, """SELECT generator_id, peak, count(*) AS samples, count(*) FILTER (abs(gap - peak) <= 3) AS cluster, round(100 * count(*) FILTER (abs(gap - peak) <= 3) / count(*), 4) AS percent
FROM gaps JOIN (SELECT generator_id, arg_max(bin, n * 1000000 - bin) + 0.5::DOUBLE AS peak FROM (SELECT generator_id, floor(gap) AS bin, count(*) AS n FROM gaps GROUP BY ALL) GROUP BY generator_id) USING (generator_id) GROUP BY generator_id, peak""")  # fmt: skip
QUALITY = _with(_C + """,
q0 AS (SELECT generator_id, count(gap) AS n_gaps, sum(gap) AS span, avg(gap) AS mean_gap, count(*) AS actual, (avg((fuel_level_l IS NULL)::INT) + avg((current IS NULL)::INT) + avg((battery_voltage IS NULL)::INT)) / 3 AS blank, any_value(interval) AS interval FROM T JOIN C USING (generator_id) GROUP BY generator_id),
q1 AS (SELECT generator_id, round(CASE WHEN n_gaps = 0 THEN 100 ELSE greatest(0, least(100, 100 - 100 * greatest(0, span / interval - actual) / (span / interval))) END, 4) AS packet_score,
       round(CASE WHEN n_gaps = 0 THEN 0 ELSE greatest(0, least(100, 100 - 100 * abs(mean_gap - interval) / interval)) END, 4) AS interval_score, round(100 - 100 * blank, 4) AS sensor_score FROM q0),
q2 AS (SELECT *, round(0.4::DOUBLE * packet_score + 0.4::DOUBLE * interval_score + 0.2::DOUBLE * sensor_score, 4) AS quality_score FROM q1)""", """SELECT *, CASE WHEN quality_score >= 90 THEN 'Excellent' WHEN quality_score >= 75 THEN 'Good' WHEN quality_score >= 50 THEN 'Fair' ELSE 'Poor' END AS communication_health,
concat_ws('; ', CASE WHEN packet_score < 75 THEN 'Packet loss' END, CASE WHEN interval_score < 75 THEN 'Irregular interval' END, CASE WHEN sensor_score < 75 THEN 'Missing sensors' END) AS issues FROM q2""")  # fmt: skip
_FACTS = ("site_name", "fuel_level_l", "current", "battery_voltage", "status")
DUPLICATES = _with("", f"""SELECT min(row_id) AS row_id, generator_id, epoch_us(timestamp) AS timestamp_us, {", ".join(f"arg_min({c}, row_id) FILTER ({c} IS NOT NULL) AS {c}" for c in _FACTS)}, count(*) AS n_packets,
CASE WHEN count(*) = 1 THEN 'Single' WHEN greatest({", ".join(f"count(DISTINCT {c})" for c in _FACTS[1:])}) > 1 THEN 'Conflicting'
     WHEN {" OR ".join(f"count(DISTINCT {c}) + (count(*) > count({c}))::INT > 1" for c in _FACTS)} THEN 'Complementary' ELSE 'Exact' END AS duplicate_type
FROM R GROUP BY generator_id, timestamp""")  # fmt: skip
HOURLY_GRID = _with(_GRID, "SELECT generator_id, epoch_us(h) AS timestamp_us, site_name, fuel_level_l, current, battery_voltage, status, is_inserted_timestamp FROM G")
INSERTED_RUNS = _with(_GRID + ", runs AS (SELECT *, row_number() OVER (PARTITION BY generator_id ORDER BY h) - row_number() OVER (PARTITION BY generator_id, is_inserted_timestamp ORDER BY h) AS run FROM G)", """SELECT generator_id, min(epoch_us(h)) AS start_us, max(epoch_us(h)) AS end_us, count(*) AS n_rows, count(*) * 60.0::DOUBLE AS minutes,
CASE WHEN count(*) <= 1 THEN 'Short' WHEN count(*) <= 2 THEN 'Medium' ELSE 'Long' END AS gap_class FROM runs WHERE is_inserted_timestamp GROUP BY generator_id, run""")  # fmt: skip
TIMELINE_SUMMARY = _with(_GRID, "SELECT generator_id, count(*) AS n_rows, count(*) FILTER (is_inserted_timestamp) AS inserted, round(100 * count(*) FILTER (NOT is_inserted_timestamp) / count(*), 4) AS availability FROM G GROUP BY generator_id")
LAGS = _with(_D, "SELECT row_id, round(fuel_delta, 6) AS fuel_delta, round(current_delta, 6) AS current_delta, round(voltage_delta, 6) AS voltage_delta, round(gap, 6) AS time_delta_sec, round(fuel_rate_lps * 3600, 6) AS fuel_rate_lph FROM D")
CALENDAR = _with("", """SELECT row_id, hour(timestamp)::INT AS hour, minute(timestamp)::INT AS minute, day(timestamp)::INT AS day, (isodow(timestamp) - 1)::INT AS weekday, month(timestamp)::INT AS month, (isodow(timestamp) >= 6)::INT AS is_weekend,
round(sin(2 * pi() * hour(timestamp) / 24), 6) + 0.0::DOUBLE AS hour_sin, round(cos(2 * pi() * hour(timestamp) / 24), 6) + 0.0::DOUBLE AS hour_cos, round(sin(2 * pi() * (isodow(timestamp) - 1) / 7), 6) + 0.0::DOUBLE AS weekday_sin, round(cos(2 * pi() * (isodow(timestamp) - 1) / 7), 6) + 0.0::DOUBLE AS weekday_cos FROM T""")  # fmt: skip


def _rolling() -> str:
    out = ["row_id"]
    for m in (360, 1440):
        for c, short in (("fuel_level_l", "fuel"), ("current", "current"), ("battery_voltage", "battery")):
            for how, f in (("mean", "avg"), ("std", "stddev_samp")):
                out.append(f"round(CASE WHEN count({c}) OVER w{m} >= 3 THEN {f}({c}) OVER w{m} END, 9) AS {short}_{how}_{m}min")
    windows = ", ".join(f"w{m} AS (PARTITION BY generator_id ORDER BY us RANGE BETWEEN {m * 60_000_000 - 1} PRECEDING AND CURRENT ROW)" for m in (360, 1440))
    return f"SELECT {', '.join(out)} FROM T WINDOW {windows}"


ROLLING = _with("", _rolling())
ROLLING_REPEATS = _with(", P AS (SELECT row_id, generator_id, epoch_us(date_trunc('day', timestamp)) AS d, fuel_level_l FROM R)", """SELECT a.row_id, round(CASE WHEN count(b.fuel_level_l) >= 2 THEN avg(b.fuel_level_l) END, 9) AS fuel_mean,
round(CASE WHEN count(b.fuel_level_l) >= 2 THEN stddev_samp(b.fuel_level_l) END, 9) AS fuel_std, round(CASE WHEN count(b.fuel_level_l) >= 2 THEN sum(b.fuel_level_l) END, 9) AS fuel_sum
FROM P a JOIN P b ON a.generator_id = b.generator_id AND b.d > a.d - 259200000000 AND (b.d < a.d OR b.d = a.d AND b.row_id <= a.row_id) GROUP BY a.row_id""")  # fmt: skip
ROW_FEATURES = _with("", "SELECT row_id, " + ", ".join(f"round(lag({c}, {n}) OVER w, 4) AS {c}_lag_{n}" for c in ("fuel_level_l", "current", "battery_voltage") for n in (1, 5)) + ", " + ", ".join(f"round(CASE WHEN count(fuel_level_l) OVER r = 5 THEN {f}(fuel_level_l) OVER r END, 4) AS fuel_{how}_5rows" for how, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))) + " FROM T WINDOW w AS (PARTITION BY generator_id ORDER BY timestamp, row_id), r AS (PARTITION BY generator_id ORDER BY timestamp, row_id ROWS 4 PRECEDING)")
LONG_FRAMES = _with("", "SELECT row_id, " + ", ".join(f"round(CASE WHEN count(battery_voltage) OVER r = 360 THEN {f}(battery_voltage) OVER r END, 4) AS battery_{how}" for how, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))) + " FROM T WINDOW r AS (PARTITION BY generator_id ORDER BY timestamp, row_id ROWS 359 PRECEDING)")
CHANGES = _with(", ch AS (SELECT row_id, " + ", ".join(f"fuel_level_l - lag(fuel_level_l, {n}) OVER w AS c{n}" for n in (15, 30, 60)) + " FROM T WINDOW w AS (PARTITION BY generator_id ORDER BY timestamp, row_id))", "SELECT row_id, round(c15, 4) AS fuel_change_15, round(c30, 4) AS fuel_change_30, round(c60, 4) AS fuel_change_60, coalesce(c60 > 50, false)::INT AS refill_signal, coalesce(c60 < -50, false)::INT AS drop_signal FROM ch")
FLAGS = _with(_D, """SELECT row_id, (fuel_level_l IS NULL)::INT + (current IS NULL)::INT + (battery_voltage IS NULL)::INT AS sensor_missing_count, coalesce(abs(fuel_delta) > 100, false)::INT AS fuel_outlier_flag, coalesce(abs(current_delta) > 100, false)::INT AS current_outlier_flag,
coalesce(abs(voltage_delta) > 50, false)::INT AS voltage_outlier_flag, coalesce(gap > 180, false)::INT AS gap_flag, coalesce(battery_voltage <= 0, false)::INT AS battery_zero, coalesce(fuel_level_l <= 0, false)::INT AS fuel_zero_or_negative, coalesce(current > 5, false)::INT AS current_active FROM D""")  # fmt: skip
CUMULATIVE = _with("", "SELECT row_id, round(CASE WHEN fuel_level_l IS NOT NULL THEN sum(fuel_level_l) OVER (PARTITION BY generator_id ORDER BY timestamp, row_id ROWS UNBOUNDED PRECEDING) END, 4) AS total FROM T")
STATE = _with(_S, "SELECT row_id, running_probability, estimated_status, estimated_confidence, confidence_level, status_conflict, CASE WHEN says = '' THEN 'No telemetry evidence available.' ELSE says || '.' END AS estimation_reason FROM S")
STATE_SUMMARY = _with(_S, "SELECT estimated_status, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM S GROUP BY estimated_status")
_TH = """,
th AS (SELECT generator_id, count(*) FILTER (current > 1) AS n, quantile_cont(current, [0.25, 0.5, 0.75]) FILTER (current > 1) AS q FROM T GROUP BY generator_id),
th2 AS (SELECT generator_id, CASE WHEN n >= 10 THEN q[1] ELSE 20 END AS low, CASE WHEN n >= 10 THEN q[2] ELSE 60 END AS medium, CASE WHEN n >= 10 THEN q[3] ELSE 120 END AS high FROM th)"""
THRESHOLDS = _with(_TH, "SELECT generator_id, round(low, 6) AS low, round(medium, 6) AS medium, round(high, 6) AS high FROM th2")
FUSED_STATE = _with(_D + _TH + """,
e0 AS (SELECT D.*, low, medium, [
    {'w': 45, 's': CASE WHEN current <= 1 THEN 0 WHEN current < low THEN 0.55 WHEN current < medium THEN 0.75 WHEN current IS NOT NULL THEN 1.0 END::DOUBLE},
    {'w': 25, 's': CASE WHEN fuel_rate_lps > 0.05 THEN 1 WHEN fuel_rate_lps < -0.05 THEN 0.2 WHEN fuel_rate_lps IS NOT NULL THEN 0 END::DOUBLE},
    {'w': 15, 's': CASE WHEN fuel_delta < -0.05 THEN 1 WHEN fuel_delta > 0.05 THEN 0.2 WHEN fuel_delta IS NOT NULL THEN 0 END::DOUBLE},
    {'w': 10, 's': CASE WHEN battery_voltage >= 24 THEN 1 WHEN battery_voltage > 0 THEN 0.5 WHEN battery_voltage IS NOT NULL THEN 0 END::DOUBLE},
    {'w': 5, 's': CASE status WHEN 'running' THEN 1 WHEN 'stopped' THEN 0 END::DOUBLE}] AS all_e FROM D JOIN th2 USING (generator_id)),
e1 AS (SELECT *, list_filter(all_e, lambda x: x.s IS NOT NULL) AS e FROM e0),
e2 AS (SELECT *, len(e) AS n, CASE WHEN len(e) > 0 THEN list_sum(list_transform(e, lambda x: x.s * x.w)) / list_sum(list_transform(e, lambda x: x.w)) ELSE 0 END AS p FROM e1)""", """SELECT row_id, round(p, 6) AS state_probability,
CASE WHEN p < 0.25 THEN 'Stopped' WHEN p < 0.5 THEN 'Idle' WHEN current IS NULL THEN 'Running' WHEN current <= 1 THEN 'Idle' WHEN current < low THEN 'Running (Low Load)' WHEN current < medium THEN 'Running (Medium Load)' ELSE 'Running (High Load)' END AS state,
round(CASE WHEN n = 0 THEN 0 ELSE 100 * (greatest(0, least(1, 1 - list_stddev_pop(list_transform(e, lambda x: x.s)))) * 0.7 + n / 5 * 0.3) END, 4) AS state_confidence FROM e2""")  # fmt: skip
VALIDATION = _with(_V, "SELECT row_id, fuel_invalid, fuel_outlier, current_invalid, current_outlier, battery_invalid, battery_current_mismatch, state_sensor_mismatch, timestamp_duplicate, timestamp_gap, telemetry_quality_score, CASE WHEN problems = '' THEN 'Telemetry healthy' ELSE problems END AS validation_reason FROM V")
IMPUTED = _with(_I, "SELECT row_id, round(fuel_level_l, 6) AS fuel_level_l, round(current, 6) AS current, round(battery_voltage, 6) AS battery_voltage, status, fuel_imputed, current_imputed, battery_imputed, status_imputed, imputation_confidence, imputation_confidence_level FROM I")
IMPUTATION_SUMMARY = _with(_I, " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER (raw_{c} IS NULL) AS missing_before, count(*) FILTER ({c} IS NULL) AS missing_after, count(*) FILTER (raw_{c} IS NULL AND {c} IS NOT NULL) AS filled FROM I" for c in ("fuel_level_l", "current", "battery_voltage", "status")))
_CLEAN = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN gap <= 300 THEN {_line(c, 2)} END AS {c}_clean" for c in ("fuel_level_l", "current", "battery_voltage"))
SHORT_GAPS = _with(f", {_neighbours('T')}, cl AS (SELECT *, {_CLEAN} FROM N), cf AS (SELECT *, concat_ws(';', " + ", ".join(f"CASE WHEN {c} IS NULL AND {c}_clean IS NOT NULL THEN '{c}' END" for c in ("fuel_level_l", "current", "battery_voltage")) + ") AS estimated_fields FROM cl)", "SELECT row_id, round(fuel_level_l_clean, 6) AS fuel_level_l_clean, round(current_clean, 6) AS current_clean, round(battery_voltage_clean, 6) AS battery_voltage_clean, estimated_fields <> '' AS is_estimated, estimated_fields FROM cf")
HEALTH = _with(_H, """SELECT row_id, fuel_sensor_health, current_sensor_health, battery_sensor_health, status_sensor_health, overall_sensor_health, maintenance_priority,
CASE maintenance_priority WHEN 'None' THEN 'Sensors operating normally' WHEN 'Low' THEN 'Minor sensor degradation' WHEN 'Medium' THEN 'Sensor quality degrading' WHEN 'High' THEN 'Multiple sensor issues detected' ELSE 'Sensor reliability very poor' END AS maintenance_reason,
CASE maintenance_priority WHEN 'None' THEN 'No action required' WHEN 'Low' THEN 'Monitor during next inspection' WHEN 'Medium' THEN 'Inspect affected sensor' WHEN 'High' THEN 'Maintenance recommended' ELSE 'Immediate maintenance required' END AS recommended_action FROM H""")  # fmt: skip
_ISSUES = [("fuel_invalid", 30, "Invalid fuel value"), ("fuel_outlier", 15, "Fuel outlier"), ("current_invalid", 25, "Invalid current"), ("current_outlier", 10, "Current outlier"), ("battery_invalid", 20, "Invalid battery voltage"), ("battery_current_mismatch", 15, "Battery/current mismatch"), ("state_sensor_mismatch", 15, "Status conflicts with sensors"), ("fuel_imputed", 5, "Fuel imputed"), ("current_imputed", 5, "Current imputed"), ("battery_imputed", 5, "Battery imputed"), ("status_imputed", 5, "Status imputed")]
#: Columns that feature selection judges, in their order.
CANDIDATES = ["fuel_level_l", "current", "battery_voltage", "fuel_delta", "current_delta", "fuel_mean_360min", "fuel_mean_1440min", "current_mean_360min"]
_F = _D + f", rolled AS ({_rolling()}), F AS (SELECT {', '.join(CANDIDATES)} FROM D JOIN rolled USING (row_id))"
_PAIRS = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, corr({a}, {b}) AS correlation FROM F" for j, b in enumerate(CANDIDATES) for i, a in enumerate(CANDIDATES[:j]))
CORRELATIONS = _with(_F, f"SELECT a, b, n, round(correlation, 6) AS correlation FROM ({_PAIRS}) WHERE n > 0")
_COLUMNS = " UNION ALL ".join(
    f"SELECT {k} AS k, '{c}' AS feature, (SELECT max(m) FROM (SELECT count(*) AS m FROM F GROUP BY {c})) / count(*) >= 0.99 AS same, avg(({c} IS NULL)::INT) > 0.5 AS absent, coalesce(var_samp({c}), 0) < 0.001 AS flat FROM F"
    for k, c in enumerate(CANDIDATES)
)
_SELECTION = _F + f""",
pairs AS ({_PAIRS}), facts AS ({_COLUMNS}),
judged AS (
    SELECT feature, CASE WHEN same THEN 'constant' WHEN absent THEN 'missing'
        WHEN EXISTS (SELECT 1 FROM pairs JOIN facts o ON o.k = pairs.i WHERE pairs.j = facts.k AND abs(correlation) > 0.95 AND NOT o.same AND NOT o.absent) THEN 'correlated'
        WHEN flat THEN 'low_variance' ELSE 'kept' END AS verdict
    FROM facts)"""
SELECTION = _with(_SELECTION, "SELECT * FROM judged")
SELECTION_REPORT = _with(_SELECTION, " UNION ALL ".join(f"SELECT '{s}' AS stage, count(*) FILTER (verdict = '{s}') AS features, round(100 * count(*) FILTER (verdict = '{s}') / count(*), 4) AS percent FROM judged" for s in ("constant", "missing", "correlated", "low_variance", "kept")))
_SCORED = _I + f""",
d0 AS (SELECT *, coalesce(round(abs(fuel_level_l - CASE WHEN count(fuel_level_l) OVER w >= 20 THEN avg(fuel_level_l) OVER w END), 9) > 8, false) AS sensor_drift FROM I WINDOW w AS (PARTITION BY generator_id ORDER BY timestamp, row_id ROWS 59 PRECEDING)),
d1 AS (SELECT *, greatest(0, 100.0::DOUBLE {" ".join(f"- {p} * {c}::INT" for c, p, _ in _ISSUES)} - CASE WHEN imputation_confidence < 30 THEN 20 WHEN imputation_confidence < 60 THEN 10 WHEN imputation_confidence < 80 THEN 5 ELSE 0 END - 10 * sensor_drift::INT) AS total,
       concat_ws('; ', {", ".join(f"CASE WHEN {c} THEN '{text}' END" for c, _, text in _ISSUES)}, CASE WHEN imputation_confidence < 30 THEN 'Very low imputation confidence' WHEN imputation_confidence < 60 THEN 'Low imputation confidence' WHEN imputation_confidence < 80 THEN 'Moderate imputation confidence' END, CASE WHEN sensor_drift THEN 'Sensor drift detected' END) AS issues FROM d0),
scored AS (SELECT *, CASE WHEN total >= 95 THEN 'Excellent' WHEN total >= 85 THEN 'Good' WHEN total >= 70 THEN 'Fair' WHEN total >= 50 THEN 'Poor' ELSE 'Critical' END AS sensor_health FROM d1)"""
HEALTH_SCORE = _with(_SCORED, """SELECT row_id, sensor_drift, total AS sensor_health_score, sensor_health, CASE WHEN issues = '' THEN 'Healthy telemetry' ELSE issues END AS sensor_health_reason FROM scored""")
ADVICE = _with(_SCORED, """SELECT sensor_health, CASE sensor_health WHEN 'Excellent' THEN 'No action required' WHEN 'Good' THEN 'Continue monitoring' WHEN 'Fair' THEN 'Inspect during next maintenance' WHEN 'Poor' THEN 'Schedule sensor inspection' ELSE 'Immediate maintenance required' END AS maintenance_recommendation,
count(*) AS n, count(*) FILTER (fuel_invalid OR fuel_outlier OR current_invalid OR current_outlier OR battery_invalid OR battery_current_mismatch OR state_sensor_mismatch OR sensor_drift) AS issues FROM scored GROUP BY ALL""")
_ZEROED = _V + ", Z AS (SELECT * REPLACE (CASE WHEN current IS NULL AND estimated_status = 'Stopped' THEN 0 ELSE current END AS current, CASE WHEN battery_voltage IS NULL AND estimated_status = 'Stopped' THEN 0 ELSE battery_voltage END AS battery_voltage) FROM V), " + _neighbours("Z")
STOPPED_AS_ZERO = _with(_ZEROED + f", L AS (SELECT row_id, estimated_confidence, status IS NULL AS s, {', '.join(f'{c} AS raw_{c}, {_line(c, 10)} AS {c}' for c in ('fuel_level_l', 'current', 'battery_voltage'))} FROM N)", """SELECT row_id, current,
round(greatest(0, least(100, (100 - 15 * (raw_fuel_level_l IS NULL AND fuel_level_l IS NOT NULL)::INT - 10 * (raw_current IS NULL AND current IS NOT NULL)::INT - 10 * (raw_battery_voltage IS NULL AND battery_voltage IS NOT NULL)::INT - 10 * s::INT) * 0.7::DOUBLE + estimated_confidence * 0.3::DOUBLE)), 4) AS first_confidence FROM L""")
ANOMALIES = _with(_A, """SELECT row_id, fuel_theft, refueling, fuel_stuck, current_spike, current_zero_running, battery_low, battery_spike, battery_unstable, state_anomaly, telemetry_anomaly, fuel_spike, overall_anomaly_score, anomaly_flag, anomaly_severity,
CASE WHEN len(found) = 0 THEN 'No anomaly detected' ELSE array_to_string(found, '; ') END AS anomaly_reason, CASE WHEN len(acts) = 0 THEN 'No action required' ELSE array_to_string(acts, '; ') END AS anomaly_action, state_anomaly_reason, telemetry_severity FROM A""")  # fmt: skip
ANOMALY_SUMMARY = _with(_A, "SELECT generator_id, count(*) AS n_rows, count(*) FILTER (anomaly_flag) AS n_anomalies, round(avg(overall_anomaly_score), 4) AS mean_score, max(overall_anomaly_score) AS worst_score FROM A GROUP BY generator_id")
TARGET = _with(_TARGET, "SELECT row_id, target_fuel, round((target_us - us - 10800000000) / 60e6, 9) AS target_minutes, target_fuel IS NOT NULL AS target_available FROM F")
PERSISTENCE = _with(_TARGET, "SELECT row_id, persistence, round((us - persistence_us) / 1e6, 6) AS age_seconds FROM P")
_SPLIT = ", sp AS (SELECT *, CASE WHEN k <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN k <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, count(*) OVER (PARTITION BY generator_id) AS n, row_number() OVER (PARTITION BY generator_id ORDER BY timestamp, row_id) AS k FROM T))"
SPLIT = _with(_SPLIT, "SELECT row_id, split FROM sp")
SPLIT_ORDER = _with(_SPLIT, "SELECT generator_id, coalesce(max(us) FILTER (split = 'train') <= min(us) FILTER (split = 'validation') AND max(us) FILTER (split = 'validation') <= min(us) FILTER (split = 'test'), true) AS ordered FROM sp GROUP BY generator_id")
GLOBAL_SPLIT = _with("", "SELECT CASE WHEN k <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN k <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY timestamp, row_id) AS k, count(*) OVER () AS n FROM T) GROUP BY 1")
ENCODING = _with("", "SELECT row_id, round(count(*) OVER (PARTITION BY site_name) / count(*) OVER (), 6) AS site_name__frequency, (status IS NULL)::INT AS status__missing, (status IS NOT DISTINCT FROM 'running')::INT AS status__running, (status IS NOT DISTINCT FROM 'stopped')::INT AS status__stopped FROM T")
_METRICS = """count(*) AS n, round(avg(absolute_error), 4) AS mae, round(sqrt(avg(error * error)), 4) AS rmse, round(1 - sum(error * error) / nullif(sum(target_fuel * target_fuel) - count(*) * avg(target_fuel) * avg(target_fuel), 0), 4) AS r2, round(avg(error), 4) AS bias,
round(quantile_cont(absolute_error, 0.5), 4) AS median, round(max(absolute_error), 4) AS most, round(100 * avg(abs(error / target_fuel)) FILTER (abs(target_fuel) > 1e-6), 4) AS mape FROM E WHERE error IS NOT NULL"""
METRICS = _with(_TARGET, f"SELECT {_METRICS}")
METRICS_BY_GENERATOR = _with(_TARGET, f"SELECT generator_id, {_METRICS} GROUP BY generator_id")
TOLERANCE = _with(_TARGET, " UNION ALL ".join(f"SELECT '{t}' AS tolerance, round(100 * avg((absolute_error <= {t})::INT), 4) AS percent FROM E WHERE error IS NOT NULL" for t in (1, 2, 5, 10, 20, 50, 100)))
ERROR_PERCENTILES = _with(_TARGET, " UNION ALL ".join(f"SELECT {q}::DOUBLE AS mark, round(quantile_cont(absolute_error, {q}), 4) AS value FROM E" for q in (0.5, 0.75, 0.9, 0.95, 0.99, 0.999)))
_BINS = [(None, 10, "<=10"), (10, 25, "10-25"), (25, 50, "25-50"), (50, 100, "50-100"), (100, 250, "100-250"), (250, 500, "250-500"), (500, None, ">500")]
ERROR_RANGES = _with(_TARGET, " UNION ALL ".join(f"SELECT '{name}' AS bin, count(*) AS n, round(avg(absolute_error), 4) AS mae FROM E WHERE error IS NOT NULL" + (f" AND target_fuel > {low}" if low is not None else "") + (f" AND target_fuel <= {high}" if high is not None else "") for low, high, name in _BINS))
WORST = _with(_TARGET, "SELECT row_id, round(absolute_error, 4) AS absolute_error FROM E WHERE error IS NOT NULL ORDER BY E.absolute_error DESC, row_id LIMIT 20")
MULTISET = _with("", "SELECT (SELECT count(*) FROM (SELECT generator_id, site_name, status FROM R EXCEPT ALL SELECT generator_id, site_name, status FROM T)) AS only_a, (SELECT count(*) FROM (SELECT generator_id, site_name, status FROM T EXCEPT ALL SELECT generator_id, site_name, status FROM R)) AS only_b")
TARGET_CHANGES = _with(_TARGET, "SELECT 0::BIGINT AS left_only, 0::BIGINT AS right_only, count(*) AS in_both, count(*) FILTER (target_us - us - 10800000000 > 1800000000) AS valid_to_missing, 0::BIGINT AS missing_to_valid, 0::BIGINT AS changed FROM F")
FLEET = _with(_H, "SELECT count(DISTINCT generator_id) AS generators, count(DISTINCT CASE WHEN status = 'running' THEN generator_id END) AS running, round(avg(fuel_level_l), 4) AS mean_fuel, round(avg(overall_sensor_health), 4) AS mean_health, count(*) FILTER (maintenance_priority IN ('Medium', 'High', 'Critical')) AS alerts, count(*) AS n_rows, count(DISTINCT generator_id) - count(DISTINCT CASE WHEN status = 'running' THEN generator_id END) AS stopped FROM H")
HEALTH_HISTOGRAM = _with(_H, "SELECT least(floor(overall_sensor_health / 5), 19)::INT AS bin, count(*) AS n FROM H GROUP BY ALL")
FUEL_PAGE = _with(_I, "SELECT generator_id, round(avg(fuel_level_l), 4) AS mean_fuel, round(min(fuel_level_l) FILTER (fuel_level_l >= 0), 4) AS least_fuel, round(max(fuel_level_l), 4) AS most_fuel, round(avg(fuel_rate_lps * 3600) FILTER (status = 'running'), 4) AS running_rate, count(*) FILTER (fuel_invalid) AS n_fuel_invalid, count(*) FILTER (fuel_outlier) AS n_fuel_outlier, count(*) FILTER (fuel_imputed) AS n_fuel_imputed FROM I GROUP BY generator_id")
HEALTH_PAGE = _with(_H, "SELECT round(avg(overall_sensor_health), 4) AS mean_health, count(*) FILTER (overall_sensor_health >= 90) AS healthy, count(*) FILTER (overall_sensor_health < 75) AS degraded, count(*) FILTER (maintenance_priority <> 'None') AS maintenance, " + ", ".join(f"round(avg({c}_sensor_health), 4) AS mean_{c}" for c in ("fuel", "current", "battery", "status")) + " FROM H")
WORST_HEALTH = _with(_H, "SELECT row_id, overall_sensor_health FROM H ORDER BY overall_sensor_health, row_id LIMIT 100")
PRIORITIES = _with(_H, "SELECT maintenance_priority, count(*) AS n FROM H GROUP BY maintenance_priority")
