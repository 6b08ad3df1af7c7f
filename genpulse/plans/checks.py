"""Queries of integrity, cleaning and comparison, each beside the SQL that states its result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import series as s
from ..operators import cadence as cad
from ..operators import compare as cmp
from ..operators import forecast as fc
from ..operators import compose, impute, rules, timeline
from ..operators import integrity as ok
from ..sources import tables as src
from . import oracles as sql
from .catalog import checked, completed, forecasts, query, stated

_W = "PARTITION BY generator_id ORDER BY timestamp, row_id"
_SENSORS = ("fuel_level_l", "current", "battery_voltage")
_DELTA = f", d AS (SELECT *, fuel_level_l - lag(fuel_level_l) OVER ({_W}) AS fd FROM T)"


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


def targeted(spark, sf_dir):
    return fc.target(src.telemetry(spark, sf_dir), 3, 60)


@query(sql._with(_DELTA, "SELECT row_id, round(CASE WHEN greatest(gap, 0) > 1e-6 THEN fd / gap END, 9) AS fuel_rate_lps, round(CASE WHEN greatest(gap, 0) > 1e-6 THEN fd / gap * 3600 END, 6) AS fuel_rate_lph FROM d"))
def signed_fuel_rate(spark, sf_dir):
    t = ok.signed_rates(src.telemetry(spark, sf_dir))
    return t.select("row_id", F.round("fuel_rate_lps", 9).alias("fuel_rate_lps"), F.round("fuel_rate_lph", 6).alias("fuel_rate_lph"))


@query(sql._with(_DELTA, "SELECT row_id, round(CASE WHEN gap > 0 AND -fd / gap >= 0 THEN abs(fd / gap) END, 9) AS fuel_rate_lps FROM d"))
def clamped_fuel_rate(spark, sf_dir):
    return ok.clamped_rates(src.telemetry(spark, sf_dir)).select("row_id", F.round(F.abs("fuel_rate_lps"), 9).alias("fuel_rate_lps"))


@query(sql._with("", "SELECT row_id, " + ", ".join(f"coalesce({c} - 30 < 0, false)::INT AS {c}_invalid" for c in _SENSORS) + ", coalesce(current - 30 > 5 AND battery_voltage - 30 <= 0, false)::INT AS sensor_state_conflict FROM T"))
def sensor_validity(spark, sf_dir):
    """Readings less 30, as the events hold none below zero."""
    t = src.telemetry(spark, sf_dir)
    t = ok.validity_flags(t.withColumns({c: F.col(c) - 30 for c in src.SENSORS}))
    return t.select("row_id", *[f"{c}_invalid" for c in src.SENSORS], "sensor_state_conflict")


_FLAGGED = ", f AS (SELECT *, CASE WHEN row_id % 13 = 0 THEN -0.24::DOUBLE ELSE fuel_level_l - 20 END AS x FROM T)"


def flagged(spark, sf_dir):
    """Fuel less 20, and the sentinel in every thirteenth row, as a target."""
    t = src.telemetry(spark, sf_dir).withColumn("target_fuel", F.when(F.col("row_id") % 13 == 0, -0.24).otherwise(F.col("fuel_level_l") - 20))
    return ok.target_flags(t)


@query(sql._with(_FLAGGED, "SELECT row_id, coalesce(x < 0, false)::INT AS target_negative, coalesce(abs(x + 0.24) <= 1e-6 + 1e-5 * 0.24, false)::INT AS target_sentinel, coalesce(x >= 0, false)::INT AS target_valid FROM f"))
def target_integrity(spark, sf_dir):
    return flagged(spark, sf_dir).select("row_id", "target_negative", "target_sentinel", "target_valid")


@query(sql._with(_FLAGGED, "SELECT count(*) FILTER (row_id % 17 = 0) AS target_negative, 0::BIGINT AS target_sentinel, 0::BIGINT AS target_valid FROM f"))
def flag_consistency(spark, sf_dir):
    """Every seventeenth flag turned over."""
    turned = flagged(spark, sf_dir).withColumn("target_negative", F.when(F.col("row_id") % 17 == 0, 1 - F.col("target_negative")).otherwise(F.col("target_negative")))
    return ok.flag_mismatches(turned)


@query(sql._with(_FLAGGED, "SELECT generator_id, count(*) AS n_rows, count(*) FILTER (x >= 0) AS valid, count(*) FILTER (x < 0) AS negative, round(100 * count(*) FILTER (x >= 0) / count(*), 4) AS percent FROM f GROUP BY generator_id"))
def target_availability(spark, sf_dir):
    return ok.target_availability(flagged(spark, sf_dir))


@query(sql._with(sql._TARGET, "SELECT count(target_us) AS matched, 0::BIGINT AS too_early, count(*) FILTER ((target_us - us - 10800000000) / 60e6 > 30) AS too_late FROM F"))
def target_timing(spark, sf_dir):
    return ok.target_timing(targeted(spark, sf_dir), 3, 30)


@query(sql._with(_FLAGGED, "SELECT row_id FROM f WHERE x >= 0"))
def valid_target_rows(spark, sf_dir):
    return ok.valid_targets(flagged(spark, sf_dir)).select("row_id")


@query(
    sql._with(
        _FLAGGED + f", g AS (SELECT *, x - lag(x, 15) OVER ({_W}) AS c FROM f)",
        "SELECT row_id, CASE WHEN x >= 0 THEN x END AS target_fuel, round(CASE WHEN abs(c) <= 50 THEN c END, 6) AS change_15, round(CASE WHEN fuel_level_l >= 0 THEN fuel_level_l END, 6) AS fuel_level_l FROM g",
    )
)
def clamped_model_values(spark, sf_dir):
    t = flagged(spark, sf_dir).withColumn("change_15", s.change("target_fuel", 15))
    return rounded(ok.clamped_changes(t, ["change_15"], 50.0, "target_fuel").select("row_id", "target_fuel", "change_15", "fuel_level_l"), "change_15", "fuel_level_l")


@query(sql._with(sql._D, "SELECT row_id, round(CASE WHEN fuel_level_l >= 0 THEN fuel_level_l END, 6) AS fuel_level_l, round(CASE WHEN abs(fuel_rate_lps * 3600) <= 100 THEN fuel_rate_lps * 3600 END, 6) AS fuel_rate_lph FROM D"))
def model_input(spark, sf_dir):
    return rounded(ok.model_input(rules.with_deltas(src.telemetry(spark, sf_dir))).select("row_id", "fuel_level_l", "fuel_rate_lph"), "fuel_level_l", "fuel_rate_lph")


@query(
    sql._with(
        _DELTA + ", e AS (SELECT *, coalesce(greatest(0, -fd), 0) AS used FROM d)",
        """SELECT row_id, round(used, 6) AS fuel_consumption_rate, round(CASE WHEN current > 0 THEN used / current ELSE 0 END, 9) AS fuel_per_amp, round(used * 60, 6) AS fuel_per_hour, (status IS NOT DISTINCT FROM 'running')::INT AS generator_running,
(status IS NOT DISTINCT FROM 'stopped')::INT AS generator_stopped, coalesce(current > 5, false)::INT AS has_current, coalesce(battery_voltage > 48, false)::INT AS battery_charging, 0 AS poor_quality FROM e""",
    )
)
def efficiency_features(spark, sf_dir):
    t = ok.efficiency(src.telemetry(spark, sf_dir))
    flags = ("generator_running", "generator_stopped", "has_current", "battery_charging", "poor_quality")
    t = rounded(t.select("row_id", "fuel_consumption_rate", "fuel_per_amp", "fuel_per_hour", *flags), "fuel_consumption_rate", "fuel_per_hour")
    return rounded(t, "fuel_per_amp", places=9)


@query(
    sql._with(
        sql._GRID,
        """SELECT generator_id, epoch_us(h) AS timestamp_us, fuel_level_l IS NULL AS is_missing_packet, round(lag(fuel_level_l) OVER w - fuel_level_l, 6) AS fuel_diff_raw, round(lag(fuel_level_l) OVER w - fuel_level_l, 6) AS fuel_consumption_rate,
coalesce(lag(fuel_level_l) OVER w - fuel_level_l < -5, false) AS is_refueling, round(avg(fuel_level_l) OVER (PARTITION BY generator_id ORDER BY h ROWS 5 PRECEDING), 9) AS fuel_mean_6, round(avg(fuel_level_l) OVER (PARTITION BY generator_id ORDER BY h ROWS 23 PRECEDING), 9) AS fuel_mean_24,
lead(fuel_level_l, 3) OVER w AS target FROM G WINDOW w AS (PARTITION BY generator_id ORDER BY h)""",
    )
)
def grid_pipeline(spark, sf_dir):
    """Grid, features and a target three hours on, by the hour as the events are sparse."""
    grid = timeline.regular(timeline.floored(src.telemetry(spark, sf_dir), "hour"), 3600)
    t = ok.grid_features(grid, (6, 24), 3)
    t = t.select("generator_id", s.micros().alias("timestamp_us"), "is_missing_packet", "fuel_diff_raw", "fuel_consumption_rate", "is_refueling", "fuel_mean_6", "fuel_mean_24", "target")
    return rounded(rounded(t, "fuel_diff_raw", "fuel_consumption_rate"), "fuel_mean_6", "fuel_mean_24", places=9)


@query(sql._with("", "SELECT generator_id, count(*) FILTER (back) AS out_of_order FROM (SELECT generator_id, us % 86400000000 <= lag(us % 86400000000) OVER (PARTITION BY generator_id ORDER BY row_id) AS back FROM T) GROUP BY generator_id"))
def chronology_check(spark, sf_dir):
    """Time of day instead of time, as the events are in order."""
    return ok.chronology(src.telemetry(spark, sf_dir).withColumn("timestamp", F.timestamp_micros(s.micros() % 86_400_000_000)))


@query(sql._with("", "SELECT count(*) FILTER (n > 1) AS groups, coalesce(sum(n - 1), 0)::BIGINT AS extra_rows FROM (SELECT count(*) AS n FROM R GROUP BY generator_id, timestamp)"))
def duplicate_structure(spark, sf_dir):
    return ok.duplicate_structure(src.telemetry_with_repeats(spark, sf_dir), ["generator_id", "timestamp"])


@query(sql._with("", "SELECT coalesce(sum(n - 1), 0)::BIGINT AS full_duplicates FROM (SELECT count(*) AS n FROM R GROUP BY generator_id, site_name, status)"))
def full_row_duplicates(spark, sf_dir):
    return ok.full_duplicates(src.telemetry_with_repeats(spark, sf_dir).select("generator_id", "site_name", "status"))


def _preserved(c):
    kept = f"(CASE WHEN abs({c}) <= 50 THEN {c} END)" if c == "current" else c
    return f"SELECT '{c}' AS feature, count(*) FILTER ({c} IS NULL) AS missing_before, count(*) FILTER ({c} < 0) AS negative_before, count(*) FILTER ({kept} IS NULL) AS missing_after, count(*) FILTER ({kept} < 0) AS negative_after, count(*) FILTER ({c} IS NULL) = count(*) FILTER ({kept} IS NULL) AS preserved FROM T"


@query(sql._with("", "SELECT 'rows' AS feature, count(*) AS missing_before, 0::BIGINT AS negative_before, count(*) AS missing_after, 0::BIGINT AS negative_after, true AS preserved FROM T UNION ALL " + " UNION ALL ".join(map(_preserved, _SENSORS))))
def preservation_check(spark, sf_dir):
    """Before and after large currents are set to null."""
    t = src.telemetry(spark, sf_dir)
    return ok.preservation(t, t.withColumn("current", F.when(F.abs("current") <= 50, F.col("current"))), list(src.SENSORS))


@query(sql._with("", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg(({c} IS NULL)::INT), 6) AS missing_rate, count(*) FILTER (isinf({c})) AS n_infinite, coalesce(min({c}) = max({c}), true) AS no_variance FROM T" for c in _SENSORS)))
def column_scan(spark, sf_dir):
    return ok.column_scan(src.telemetry(spark, sf_dir), list(src.SENSORS))


@query(sql._with(sql._TARGET, " UNION ALL ".join(f"SELECT '{c}' AS feature, round(abs(corr({c}, target_fuel)), 6) AS correlation FROM F" for c in _SENSORS)))
def target_correlation(spark, sf_dir):
    return ok.correlations(targeted(spark, sf_dir), list(src.SENSORS))


@query(sql._with("", "SELECT generator_id, min(us) AS start_us, max(us) AS end_us, count(*) AS n_rows, round((max(us) - min(us)) / 3600e6, 4) AS duration_hours FROM T GROUP BY generator_id"))
def coverage(spark, sf_dir):
    return ok.coverage(src.telemetry(spark, sf_dir))


@query(sql._with("", "SELECT a.generator_id, a.n AS n_rows_a, b.n AS n_rows_b FROM (SELECT generator_id, count(*) AS n FROM R GROUP BY 1) a LEFT JOIN (SELECT generator_id, count(*) AS n FROM T WHERE status = 'running' GROUP BY 1) b USING (generator_id)"))
def joined_summaries(spark, sf_dir):
    a, b = src.telemetry_with_repeats(spark, sf_dir), src.telemetry(spark, sf_dir).where("status = 'running'")
    rows = lambda df: ok.coverage(df).select("generator_id", "n_rows")
    return ok.joined_summaries(rows(a), rows(b))


@query(sql._with(_DELTA, "SELECT row_id, round(fd, 6) AS fuel_delta FROM d WHERE fd IS NOT NULL ORDER BY abs(fd) DESC, row_id LIMIT 20"))
def largest_changes(spark, sf_dir):
    return rounded(ok.largest(rules.with_deltas(src.telemetry(spark, sf_dir)), "fuel_delta").select("row_id", "fuel_delta"), "fuel_delta")


@query("SELECT " + ", ".join(["count(*) FILTER (is_estimated) AS rows_estimated", *[f"count(*) FILTER (contains(estimated_fields, '{c}')) AS {c}_estimated" for c in _SENSORS]]) + f" FROM ({sql.SHORT_GAPS})")
def estimation_summary(spark, sf_dir):
    return ok.estimation_summary(impute.short_gaps_filled(src.telemetry(spark, sf_dir)))


@query(sql._with("", f"SELECT row_id, round(avg(current) OVER w, 9) AS current_mean FROM T WINDOW w AS (PARTITION BY generator_id ORDER BY us RANGE BETWEEN {360 * 60_000_000 - 1} PRECEDING AND CURRENT ROW)"))
def rolling_from_one_value(spark, sf_dir):
    return rounded(ok.rolling_means(src.telemetry(spark, sf_dir), ["current"], 360).select("row_id", "current_mean"), "current_mean", places=9)


# states and health


@query(
    f"SELECT row_id, coalesce((status = 'running' AND NOT starts_with(state, 'Running')) OR (status = 'stopped' AND starts_with(state, 'Running')), false) AS state_conflict, CASE WHEN c >= 95 THEN 'Very High' WHEN c >= 85 THEN 'High' WHEN c >= 70 THEN 'Medium' WHEN c >= 50 THEN 'Low' ELSE 'Very Low' END AS state_confidence_level FROM ({sql.FUSED_STATE.replace('SELECT row_id, round(p, 6)', 'SELECT row_id, status, round(p, 6)').replace('AS state_confidence FROM e2', 'AS c FROM e2')})"
)
def fused_state_conflict(spark, sf_dir):
    t = rounded(rules.fused_state(rules.with_deltas(src.telemetry(spark, sf_dir))), "state_confidence", places=4)
    return rules.fused_conflict(t).select("row_id", "state_conflict", "state_confidence_level")


@query(sql._with(sql._S, "SELECT estimated_status AS state, confidence_level AS level, count(*) AS n, round(avg(estimated_confidence), 4) AS mean_confidence FROM S GROUP BY 1, 2"))
def state_report(spark, sf_dir):
    return rules.state_report(stated(spark, sf_dir))


@query(sql._with(sql._S, "SELECT coalesce(status, 'none') AS status, estimated_status, count(*) AS n FROM S GROUP BY 1, 2"))
def reported_vs_estimated(spark, sf_dir):
    return rules.counts_by(stated(spark, sf_dir).withColumn("status", F.coalesce("status", F.lit("none"))), "status", "estimated_status")


@query(sql.ADVICE)
def sensor_issue_advice(spark, sf_dir):
    t = rules.issue_advice(rules.sensor_score(completed(spark, sf_dir)))
    return t.groupBy("sensor_health", "maintenance_recommendation").agg(F.count(F.lit(1)).alias("n"), F.count_if("sensor_issue_detected").alias("issues"))


@query(sql.STOPPED_AS_ZERO)
def imputed_stopped_as_zero(spark, sf_dir):
    t = impute.imputed(rules.validated(stated(spark, sf_dir)), 10, stopped_is_zero=True)
    return t.select("row_id", "current", F.round(impute.first_confidence(F.col("estimated_confidence")), 4).alias("first_confidence"))


# cadence


@query(sql._with("", "SELECT generator_id, greatest(1, coalesce(mode(floor(gap) ORDER BY floor(gap)) FILTER (gap <= 20000), 60))::INT AS interval FROM T GROUP BY generator_id"))
def simple_interval(spark, sf_dir):
    return cad.simple_interval(src.telemetry(spark, sf_dir), 20_000.0)


@query(sql._with("", "SELECT generator_id, count(gap) AS n, round(avg(gap), 4) AS mean, round(stddev_samp(gap), 4) AS std, round(min(gap), 4) AS least, round(max(gap), 4) AS most FROM T GROUP BY generator_id"))
def interval_diagnostics(spark, sf_dir):
    return cad.interval_diagnostics(src.telemetry(spark, sf_dir))


@query(sql._with(sql._C, "SELECT T.row_id, coalesce(C.interval, 60) AS reporting_interval_sec FROM T LEFT JOIN (SELECT * FROM C WHERE generator_id <> 'GEN3') C USING (generator_id)"))
def interval_lookup(spark, sf_dir):
    """One generator left out of the table, to meet the default."""
    t = src.telemetry(spark, sf_dir)
    return cad.with_interval(t, cad.cadence(t, 20_000.0).where("generator_id <> 'GEN3'")).select("row_id", "reporting_interval_sec")


_SHORT = sql._with(sql._C.replace("gap <= 20000", "gap <= 600"), "SELECT * FROM C")


@query(f"SELECT coalesce(a.generator_id, b.generator_id) AS generator_id, a.interval AS interval_a, a.confidence AS confidence_a, b.interval AS interval_b, b.confidence AS confidence_b, a.interval IS DISTINCT FROM b.interval AS differ FROM ({sql._with(sql._C, 'SELECT * FROM C')}) a FULL JOIN ({_SHORT}) b ON a.generator_id = b.generator_id")
def interval_comparison(spark, sf_dir):
    """Cadences of all gaps beside those of gaps up to ten minutes."""
    t = src.telemetry(spark, sf_dir)
    return cad.compared(cad.cadence(t, 20_000.0), cad.cadence(t, 600.0))


@query(sql._with(sql._C + """,
o AS (SELECT interval, min(generator_id) AS first, count(*) AS n FROM C GROUP BY interval)""", """SELECT c.generator_id, c.interval, k::INT AS class, v::INT AS class_interval FROM C c JOIN (
    WITH RECURSIVE s AS (
        SELECT [arg_min(interval, first)] AS begun FROM o
        UNION ALL SELECT list_append(begun, next) FROM s, LATERAL (SELECT arg_min(interval, first) AS next FROM o WHERE list_bool_and(list_transform(begun, lambda b: abs(b - interval) > 5))) WHERE next IS NOT NULL),
    b AS (SELECT unnest(begun) AS start, unnest(range(1, len(begun) + 1)) AS k FROM (SELECT begun FROM s ORDER BY len(begun) DESC LIMIT 1)),
    m AS (SELECT k, start, o.interval, o.first, o.n FROM b JOIN o ON abs(o.interval - start) <= 5),
    apart AS (SELECT (SELECT count(*) FROM m) = (SELECT count(*) FROM o) AS yes)
    SELECT m.interval, CASE WHEN yes THEN k ELSE row_number() OVER (ORDER BY m.first) END AS k,
        CASE WHEN yes THEN (SELECT round_even(quantile_cont(c2.interval, 0.5), 0) FROM C c2 WHERE abs(c2.interval - m.start) <= 5) ELSE m.interval END AS v
    FROM (SELECT DISTINCT ON (interval) * FROM m) m, apart) x ON x.interval = c.interval"""))
def cadence_classes(spark, sf_dir):
    return cad.cadence_classes(cad.cadence(src.telemetry(spark, sf_dir), 20_000.0))


@query(sql._with(sql._S, """SELECT row_id, CASE WHEN current IS NULL THEN 'Unknown' WHEN rc THEN 'Running' ELSE 'Stopped' END AS current_vote, CASE WHEN kb THEN 'Running' ELSE 'Unknown' END AS battery_vote,
CASE WHEN NOT kf THEN 'Unknown' WHEN rf THEN 'Running' ELSE 'Stopped' END AS fuel_vote, round(CASE WHEN rc THEN sc * 0.5::DOUBLE ELSE 0 END, 6) AS current_running_weight, CASE WHEN kb THEN 0.3::DOUBLE ELSE 0 END AS battery_running_weight, CASE WHEN rf THEN 0.2::DOUBLE ELSE 0 END AS fuel_running_weight FROM S"""))
def sensor_votes(spark, sf_dir):
    t = rules.sensor_votes(rules.with_deltas(src.telemetry(spark, sf_dir)))
    return t.select("row_id", "current_vote", "battery_vote", "fuel_vote", F.round("current_running_weight", 6).alias("current_running_weight"), "battery_running_weight", "fuel_running_weight")


@query(sql._with(sql._S, "SELECT row_id, coalesce(status, estimated_status) AS status, status IS NULL AS status_imputed FROM S"))
def completed_status(spark, sf_dir):
    return impute.completed_status(stated(spark, sf_dir)).select("row_id", "status", "status_imputed")


@query(sql._with(sql._V, "SELECT row_id, " + ", ".join(f"round(CASE WHEN count({c}) OVER w{m} >= 3 THEN avg({c}) OVER w{m} END, 9) AS {c.removesuffix('_score')}_mean_{m}min" for m in (360, 1440) for c in ("running_probability", "telemetry_quality_score")) + " FROM V WINDOW " + ", ".join(f"w{m} AS (PARTITION BY generator_id ORDER BY us RANGE BETWEEN {m * 60_000_000 - 1} PRECEDING AND CURRENT ROW)" for m in (360, 1440))))
def rolling_probability_and_quality(spark, sf_dir):
    t = fc.windowed(checked(spark, sf_dir), (360, 1440), more=("running_probability", "telemetry_quality_score"), segment=3 * 86_400.0)
    return t.select("row_id", *[F.round(c, 9).alias(c) for c in t.columns if c.startswith(("running_probability_mean", "telemetry_quality_mean"))])


@query(sql._with(", V1 AS (SELECT * FROM T)", "SELECT row_id, '' AS anomaly_reason, 0.0::DOUBLE AS anomaly_score, false AS battery_low, current FROM V1"))
def anomaly_columns(spark, sf_dir):
    return rules.with_anomaly_columns(src.telemetry(spark, sf_dir)).select("row_id", "anomaly_reason", "anomaly_score", "battery_low", "current")


_MINUTES = """,
m AS (SELECT * EXCLUDE (k) FROM (SELECT *, date_trunc('minute', timestamp) AS minute, row_number() OVER (PARTITION BY {by}, date_trunc('minute', timestamp) ORDER BY timestamp, row_id) AS k FROM T) WHERE k = 1)"""


@query(sql._with(_MINUTES.format(by="generator_id") + """,
steps AS (SELECT generator_id, 60 * greatest(1, coalesce(mode(floor(gap) ORDER BY floor(gap)) FILTER (gap <= 20000), 60))::INT AS step FROM T GROUP BY generator_id),
g AS (SELECT generator_id, step, unnest(generate_series(min(minute), max(minute), to_seconds(step))) AS tick FROM m JOIN steps USING (generator_id) GROUP BY generator_id, step)""",
"SELECT g.generator_id, step AS reporting_interval_sec, epoch_us(tick) AS timestamp_us, m.fuel_level_l, m.fuel_level_l IS NULL AND m.current IS NULL AND m.battery_voltage IS NULL AND m.status IS NULL AS is_inserted_timestamp FROM g LEFT JOIN m ON g.generator_id = m.generator_id AND g.tick = m.minute"))
def cadence_grid(spark, sf_dir):
    """Every generator on a grid of its own interval, here in minutes as its gaps are."""
    t = src.telemetry(spark, sf_dir)
    steps = cad.simple_interval(t, 20_000.0).withColumn("interval", (F.col("interval") * 60).cast("int"))
    grid = timeline.regular(timeline.floored(t, "minute"), steps, segment=7 * 86_400.0)
    return grid.select("generator_id", "reporting_interval_sec", s.micros().alias("timestamp_us"), "fuel_level_l", "is_inserted_timestamp")


@query(sql._with(""",
h AS (SELECT * EXCLUDE (k) FROM (SELECT *, date_trunc('hour', timestamp) AS hour, row_number() OVER (PARTITION BY generator_id, date_trunc('hour', timestamp) ORDER BY timestamp, row_id) AS k FROM T) WHERE k = 1),
g AS (SELECT site_name, generator_id, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS tick FROM h GROUP BY site_name, generator_id)""",
"SELECT g.site_name, g.generator_id, epoch_us(tick) AS timestamp_us, h.current, h.fuel_level_l IS NULL AND h.current IS NULL AND h.battery_voltage IS NULL AND h.status IS NULL AS is_inserted_timestamp FROM g LEFT JOIN h ON g.generator_id = h.generator_id AND g.site_name = h.site_name AND g.tick = h.hour"))
def site_timeline(spark, sf_dir):
    grid = timeline.regular(timeline.floored(src.telemetry(spark, sf_dir), "hour"), 3600, by=("site_name", "generator_id"))
    return grid.select("site_name", "generator_id", s.micros().alias("timestamp_us"), "current", "is_inserted_timestamp")


@query(sql._with(sql._TARGET, "SELECT row_id, generator_id, target_fuel - 40 AS shifted FROM E WHERE target_fuel - 40 < 0 ORDER BY generator_id, timestamp, row_id LIMIT 30"))
def negative_target_sample(spark, sf_dir):
    """The first rows whose target, less 40, is negative: the table's own targets are not."""
    t = fc.target(src.telemetry(spark, sf_dir), 3, 60).withColumn("shifted", F.col("target_fuel") - 40)
    return cmp.negative_sample(t, 30, "shifted").select("row_id", "generator_id", "shifted")


@query()
def required_features(spark, sf_dir):
    return ok.required_features(compose.features(src.telemetry(spark, sf_dir)))


# models and splits


@query(
    sql._with(
        sql._TARGET,
        """SELECT scope, n, round(m, 4) AS model_mae, round(b, 4) AS baseline_mae, round(100 * (b - m) / nullif(b, 0), 4) AS improvement FROM (
SELECT 'all' AS scope, count(abs(fuel_level_l - target_fuel)) AS n, avg(abs(fuel_level_l - target_fuel)) AS m, avg(absolute_error) AS b FROM E
UNION ALL SELECT 'comparable', count(*), avg(abs(fuel_level_l - target_fuel)), avg(absolute_error) FROM E WHERE fuel_level_l - target_fuel IS NOT NULL AND error IS NOT NULL)""",
    )
)
def model_comparison(spark, sf_dir):
    """The reading itself as a model, where there is one, against persistence."""
    return cmp.model_comparison(forecasts(spark, sf_dir), model="fuel_level_l")


@query(
    sql._with(
        sql._TARGET,
        "SELECT count(error) AS n, round(avg(error), 4) AS bias, round(stddev_samp(error), 4) AS std, count(*) FILTER (error > 1e-6) AS over, count(*) FILTER (error < -1e-6) AS under, count(*) FILTER (absolute_error <= 1e-6) AS exact, "
        + ", ".join(f"round(100 * avg((absolute_error > {m})::INT) FILTER (error IS NOT NULL), 4) AS beyond_{m}" for m in (5, 10, 20, 50, 100, 200))
        + " FROM E",
    )
)
def error_shares(spark, sf_dir):
    return cmp.error_shares(forecasts(spark, sf_dir))


@query(sql._with(sql._TARGET, f"SELECT coalesce(status, 'none') AS status, {sql._METRICS} GROUP BY coalesce(status, 'none')"))
def error_by_status(spark, sf_dir):
    return fc.metrics(forecasts(spark, sf_dir).withColumn("status", F.coalesce("status", F.lit("none"))), ["status"])


@query(
    sql._with(
        _FLAGGED,
        "SELECT generator_id, sum(n)::BIGINT AS n, round(min(least), 4) AS least, round(sum(total) / sum(n), 4) AS mean, round(max(most), 4) AS most, arg_max(status, (n, status)) AS status FROM (SELECT generator_id, coalesce(status, 'none') AS status, count(*) AS n, min(x) AS least, sum(x) AS total, max(x) AS most FROM f WHERE x < 0 GROUP BY 1, 2) GROUP BY 1",
    )
)
def negative_targets(spark, sf_dir):
    return cmp.negative_targets(flagged(spark, sf_dir))
