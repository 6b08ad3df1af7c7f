"""Every telemetry query by name, with the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import series as s
from ..functions.gram import correlations
from ..operators import cadence as cad
from ..operators import compose
from ..operators import dashboard as dash
from ..operators import forecast as fc
from ..operators import impute, profile, rules, timeline
from ..sources import tables as src
from . import oracles as sql

QUERIES: dict = {}
ORACLES: dict = {}
#: Gaps of the events table are minutes, not seconds; cadence, windows and tolerances follow.
LONGEST, MINUTES = 20_000.0, (360, 1440)


def query(oracle: str | None = None):
    """Registers a function of telemetry tables under its name, with its SQL where there is one."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, sf_dir)
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register


def stated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.stated(src.telemetry(spark, sf_dir))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.checked(src.telemetry(spark, sf_dir))


def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.completed(src.telemetry(spark, sf_dir))


def healthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.healthy(src.telemetry(spark, sf_dir))


def anomalous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.anomalous(src.telemetry(spark, sf_dir))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence as the prediction of fuel three hours on, within an hour."""
    t = fc.persistence(fc.target(src.telemetry(spark, sf_dir), 3, 60))
    return fc.with_errors(t, "persistence")


@query(sql.OVERVIEW)
def dataset_overview(spark, sf_dir):
    return src.overview(src.telemetry(spark, sf_dir))


@query(sql.MISSING)
def missing_analysis(spark, sf_dir):
    return profile.missing_by_column(src.telemetry(spark, sf_dir), src.READINGS)


@query(sql.PACKETS)
def packet_summary(spark, sf_dir):
    return profile.packet_summary(src.telemetry(spark, sf_dir))


@query(sql.PARTIAL)
def partial_packets(spark, sf_dir):
    return profile.partial_packets(src.telemetry(spark, sf_dir))


@query(sql.GENERATORS)
def generator_summary(spark, sf_dir):
    return profile.generator_summary(src.telemetry_with_repeats(spark, sf_dir))


@query(sql.GAP_HISTOGRAM)
def gap_distribution(spark, sf_dir):
    return profile.gap_histogram(src.telemetry(spark, sf_dir))


@query(sql.GAP_EVENTS)
def gap_events(spark, sf_dir):
    return profile.gap_events(src.telemetry(spark, sf_dir), 60)


@query(sql.GAP_CATEGORIES)
def gap_categories(spark, sf_dir):
    return profile.gap_categories(src.telemetry(spark, sf_dir))


@query(sql.MISSING_HOURS)
def missing_hours(spark, sf_dir):
    return profile.missing_periods(src.telemetry(spark, sf_dir), "hour")


@query(sql.CROSSTAB)
def status_crosstab(spark, sf_dir):
    return profile.status_crosstab(src.telemetry(spark, sf_dir))


@query(sql.DESCRIBE)
def describe_sensors(spark, sf_dir):
    return profile.describe(src.telemetry(spark, sf_dir), src.SENSORS)


@query(sql.CADENCE)
def reporting_cadence(spark, sf_dir):
    return cad.cadence(src.telemetry(spark, sf_dir), LONGEST)


@query(sql.CADENCE_PEAK)
def cadence_histogram(spark, sf_dir):
    return cad.cadence_histogram(src.telemetry(spark, sf_dir), LONGEST)


@query(sql.QUALITY)
def telemetry_quality(spark, sf_dir):
    t = src.telemetry(spark, sf_dir)
    return cad.telemetry_quality(t, cad.cadence(t, LONGEST))


@query(sql.DUPLICATES)
def duplicate_resolution(spark, sf_dir):
    out = timeline.resolved_duplicates(src.telemetry_with_repeats(spark, sf_dir))
    return out.withColumn("timestamp_us", s.micros()).drop("timestamp")


@query(sql.HOURLY_GRID)
def hourly_timeline(spark, sf_dir):
    grid = timeline.regular(timeline.floored(src.telemetry(spark, sf_dir), "hour"), 3600)
    return grid.select("generator_id", s.micros().alias("timestamp_us"), "site_name", "fuel_level_l", "current", "battery_voltage", "status", "is_inserted_timestamp")


@query(sql.INSERTED_RUNS)
def inserted_gap_runs(spark, sf_dir):
    return timeline.inserted_runs(timeline.regular(timeline.floored(src.telemetry(spark, sf_dir), "hour"), 3600), 60, 120)


@query(sql.TIMELINE_SUMMARY)
def timeline_summary(spark, sf_dir):
    return timeline.timeline_summary(timeline.regular(timeline.floored(src.telemetry(spark, sf_dir), "hour"), 3600))


@query(sql.LAGS)
def lag_features(spark, sf_dir):
    t = rules.with_deltas(src.telemetry(spark, sf_dir))
    return t.select("row_id", *[F.round(c, 6).alias(c) for c in ("fuel_delta", "current_delta", "voltage_delta", "time_delta_sec", "fuel_rate_lph")])


@query(sql.CALENDAR)
def calendar_features(spark, sf_dir):
    t = fc.calendar(src.telemetry(spark, sf_dir))
    return t.select("row_id", "hour", "minute", "day", "weekday", "month", "is_weekend", *[(F.round(c, 6) + 0.0).alias(c) for c in ("hour_sin", "hour_cos", "weekday_sin", "weekday_cos")])


@query(sql.ROLLING)
def rolling_time_features(spark, sf_dir):
    t = fc.windowed(src.telemetry(spark, sf_dir), MINUTES)
    return t.select("row_id", *[F.round(c, 9).alias(c) for c in t.columns if "min" in c and ("_mean_" in c or "_std_" in c)])


@query(sql.ROLLING_REPEATS)
def rolling_with_repeats(spark, sf_dir):
    """Packets sent twice, on whole seconds: peers after a row stay out of its frame, and so does its bound."""
    t = src.telemetry_with_repeats(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    return t.select("row_id", *[F.round(s.rolling("fuel_level_l", 3 * 86_400, 2, how), 9).alias(f"fuel_{how}") for how in ("mean", "std", "sum")])


@query(sql.ROW_FEATURES)
def rolling_row_features(spark, sf_dir):
    t = fc.row_features(src.telemetry(spark, sf_dir), (1, 5), (5,))
    return t.select("row_id", *[F.round(c, 4).alias(c) for c in t.columns if "_lag_" in c or "rows" in c])


@query(sql.CHANGES)
def row_changes(spark, sf_dir):
    t = fc.changes(src.telemetry(spark, sf_dir))
    return t.select("row_id", *[F.round(f"fuel_change_{n}", 4).alias(f"fuel_change_{n}") for n in (15, 30, 60)], "refill_signal", "drop_signal")


@query(sql.FLAGS)
def sensor_flags(spark, sf_dir):
    t = fc.sensor_flags(src.telemetry(spark, sf_dir))
    return t.select("row_id", "sensor_missing_count", *[c for c in t.columns if c.endswith("_flag")], "battery_zero", "fuel_zero_or_negative", "current_active")


@query(sql.CUMULATIVE)
def cumulative_fuel(spark, sf_dir):
    return src.telemetry(spark, sf_dir).select("row_id", F.round(s.cumulative("fuel_level_l"), 4).alias("total"))


@query(sql.STATE)
def generator_state(spark, sf_dir):
    return stated(spark, sf_dir).select("row_id", "running_probability", "estimated_status", "estimated_confidence", "confidence_level", "status_conflict", "estimation_reason")


@query(sql.STATE_SUMMARY)
def state_summary(spark, sf_dir):
    return rules.share_by(stated(spark, sf_dir), "estimated_status")


@query(sql.THRESHOLDS)
def learned_thresholds(spark, sf_dir):
    t = rules.learned_thresholds(src.telemetry(spark, sf_dir))
    return t.select("generator_id", *[F.round(c, 6).alias(c) for c in ("low", "medium", "high")])


@query(sql.FUSED_STATE)
def fused_state(spark, sf_dir):
    t = rules.fused_state(rules.with_deltas(src.telemetry(spark, sf_dir)))
    return t.select("row_id", F.round("state_probability", 6).alias("state_probability"), "state", F.round("state_confidence", 4).alias("state_confidence"))


@query(sql.VALIDATION)
def telemetry_validation(spark, sf_dir):
    return checked(spark, sf_dir).select("row_id", *rules.VALIDATION, "telemetry_quality_score", "validation_reason")


@query(sql.IMPUTED)
def imputed_readings(spark, sf_dir):
    t = completed(spark, sf_dir)
    return t.select("row_id", *[F.round(c, 6).alias(c) for c in src.SENSORS], "status", "fuel_imputed", "current_imputed", "battery_imputed", "status_imputed", "imputation_confidence", "imputation_confidence_level")


@query(sql.IMPUTATION_SUMMARY)
def imputation_summary(spark, sf_dir):
    return impute.imputation_summary(src.telemetry(spark, sf_dir), completed(spark, sf_dir))


@query(sql.SHORT_GAPS)
def short_gap_estimates(spark, sf_dir):
    t = impute.short_gaps_filled(src.telemetry(spark, sf_dir))
    return t.select("row_id", *[F.round(f"{c}_clean", 6).alias(f"{c}_clean") for c in src.SENSORS], "is_estimated", "estimated_fields")


@query(sql.HEALTH)
def sensor_health(spark, sf_dir):
    return healthy(spark, sf_dir).select("row_id", *[f"{c}_sensor_health" for c in ("fuel", "current", "battery", "status")], "overall_sensor_health", "maintenance_priority", "maintenance_reason", "recommended_action")


@query(sql.HEALTH_SCORE)
def sensor_health_score(spark, sf_dir):
    return rules.sensor_score(completed(spark, sf_dir)).select("row_id", "sensor_drift", "sensor_health_score", "sensor_health", "sensor_health_reason")


@query(sql.ANOMALIES)
def anomaly_detection(spark, sf_dir):
    return anomalous(spark, sf_dir).select("row_id", *rules.ANOMALIES, "fuel_spike", "overall_anomaly_score", "anomaly_flag", "anomaly_severity", "anomaly_reason", "anomaly_action", "state_anomaly_reason", "telemetry_severity")


@query(sql.ANOMALY_SUMMARY)
def generator_anomaly_summary(spark, sf_dir):
    a = anomalous(spark, sf_dir)
    return a.groupBy("generator_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("anomaly_flag").alias("n_anomalies"), F.round(F.avg("overall_anomaly_score"), 4).alias("mean_score"), F.max("overall_anomaly_score").alias("worst_score"))


@query(sql.TARGET)
def forecast_target(spark, sf_dir):
    return fc.target(src.telemetry(spark, sf_dir), 3, 60).select("row_id", "target_fuel", F.round("target_minutes", 9).alias("target_minutes"), "target_available")


@query(sql.PERSISTENCE)
def persistence_baseline(spark, sf_dir):
    return fc.persistence(src.telemetry(spark, sf_dir)).select("row_id", "persistence", F.round((s.micros() - F.col("persistence_us")) / 1e6, 6).alias("age_seconds"))


@query(sql.SPLIT)
def chronological_split(spark, sf_dir):
    return fc.split(src.telemetry(spark, sf_dir)).select("row_id", "split")


@query(sql.SPLIT_ORDER)
def split_order(spark, sf_dir):
    return fc.split_order(fc.split(src.telemetry(spark, sf_dir)))


@query(sql.GLOBAL_SPLIT)
def global_time_split(spark, sf_dir):
    return fc.global_split(src.telemetry(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(sql.ENCODING)
def categorical_encoding(spark, sf_dir):
    t = fc.one_hot(fc.frequency_encoded(src.telemetry(spark, sf_dir), "site_name"), "status")
    return t.select("row_id", F.round("site_name__frequency", 6).alias("site_name__frequency"), *[F.col(f"`status__{v}`").alias(f"status__{v.strip('<>').lower()}") for v in (fc.MISSING, "running", "stopped")])


@query(sql.METRICS)
def persistence_metrics(spark, sf_dir):
    return fc.metrics(forecasts(spark, sf_dir))


@query(sql.METRICS_BY_GENERATOR)
def error_by_generator(spark, sf_dir):
    return fc.metrics(forecasts(spark, sf_dir), ["generator_id"])


@query(sql.TOLERANCE)
def tolerance_curve(spark, sf_dir):
    return fc.tolerance_curve(forecasts(spark, sf_dir))


@query(sql.ERROR_PERCENTILES)
def error_percentiles(spark, sf_dir):
    return fc.error_percentiles(forecasts(spark, sf_dir))


@query(sql.ERROR_RANGES)
def error_by_target_range(spark, sf_dir):
    return fc.error_by_range(forecasts(spark, sf_dir))


@query(sql.WORST)
def worst_predictions(spark, sf_dir):
    return fc.worst(forecasts(spark, sf_dir)).select("row_id", F.round("absolute_error", 4).alias("absolute_error"))


@query(sql.MULTISET)
def multiset_difference(spark, sf_dir):
    t = src.telemetry_with_repeats(spark, sf_dir).select("generator_id", "site_name", "status")
    return fc.multiset_difference(t, src.telemetry(spark, sf_dir).select("generator_id", "site_name", "status"))


@query(sql.TARGET_CHANGES)
def target_changes(spark, sf_dir):
    t = src.telemetry(spark, sf_dir)
    return fc.target_changes(fc.target(t, 3, 60), fc.target(t, 3, 30))


def candidates(spark, sf_dir):
    return fc.windowed(rules.with_deltas(src.telemetry(spark, sf_dir)), MINUTES)


@query(sql.SELECTION)
def feature_selection(spark, sf_dir):
    return fc.selected_features(candidates(spark, sf_dir), sql.CANDIDATES)


@query(sql.SELECTION_REPORT)
def selection_statistics(spark, sf_dir):
    return fc.selection_report(fc.selected_features(candidates(spark, sf_dir), sql.CANDIDATES))


@query(sql.CORRELATIONS)
def feature_correlations(spark, sf_dir):
    return correlations(candidates(spark, sf_dir), sql.CANDIDATES).withColumn("correlation", F.round("correlation", 6))


@query(sql.FLEET)
def fleet_overview(spark, sf_dir):
    return dash.fleet(healthy(spark, sf_dir))


@query(sql.HEALTH_HISTOGRAM)
def health_histogram(spark, sf_dir):
    return dash.health_histogram(healthy(spark, sf_dir))


@query(sql.FUEL_PAGE)
def fuel_page(spark, sf_dir):
    return dash.fuel_page(completed(spark, sf_dir))


@query(sql.HEALTH_PAGE)
def sensor_health_page(spark, sf_dir):
    return dash.health_page(healthy(spark, sf_dir))


@query(sql.WORST_HEALTH)
def worst_sensor_health(spark, sf_dir):
    return dash.worst_health(healthy(spark, sf_dir)).select("row_id", "overall_sensor_health")


@query(sql.PRIORITIES)
def maintenance_priorities(spark, sf_dir):
    return rules.counts_by(healthy(spark, sf_dir), "maintenance_priority")


from . import checks, mechanisms  # noqa: E402,F401  register more queries
