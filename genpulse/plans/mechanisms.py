"""Queries of series in segments, exact selection and boosted trees, with the SQL of the same results."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import segments as seg
from ..functions import series as s
from ..operators import boosting as gb
from ..operators import forecast as fc
from ..operators import impute, rules, states, timeline
from ..sources import tables as src
from ..sources.scratch import folder, stored
from . import oracles as sql
from .catalog import MINUTES, checked, healthy, query

#: Seconds of a segment in these queries: short ones, so that a generator of the test tables has several.
DAYS = 3 * 86_400.0


@query(sql.LAGS)
def segmented_lags(spark, sf_dir):
    t = rules.with_deltas(src.telemetry(spark, sf_dir), segment=DAYS)
    return t.select("row_id", *[F.round(c, 6).alias(c) for c in ("fuel_delta", "current_delta", "voltage_delta", "time_delta_sec", "fuel_rate_lph")])


@query(sql.CUMULATIVE)
def segmented_totals(spark, sf_dir):
    t = seg.scan(src.telemetry(spark, sf_dir), {"total": seg.total("fuel_level_l")}, DAYS)
    return t.select("row_id", F.round("total", 4).alias("total"))


@query(sql.ROLLING)
def segmented_frames(spark, sf_dir):
    t = fc.windowed(src.telemetry(spark, sf_dir), MINUTES, segment=DAYS)
    return t.select("row_id", *[F.round(c, 9).alias(c) for c in t.columns if "min" in c and ("_mean_" in c or "_std_" in c)])


@query(sql.ROLLING_REPEATS)
def segmented_repeats(spark, sf_dir):
    """Frames that end at the edges of segments, over packets sent twice."""
    t = src.telemetry_with_repeats(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    t = seg.framed(t, {f"fuel_{how}": seg.Frame("fuel_level_l", 3 * 86_400, 2, how) for how in ("mean", "std", "sum")}, 86_400)
    return t.select("row_id", *[F.round(f"fuel_{how}", 9).alias(f"fuel_{how}") for how in ("mean", "std", "sum")])


@query(sql.ROW_FEATURES)
def segmented_row_features(spark, sf_dir):
    t = fc.row_features(src.telemetry(spark, sf_dir), (1, 5), (5,), segment=DAYS)
    return t.select("row_id", *[F.round(c, 4).alias(c) for c in t.columns if "_lag_" in c or "rows" in c])


@query(sql.LONG_FRAMES)
def long_row_frames(spark, sf_dir):
    """Frames of 360 rows, which cost what short ones do."""
    t = seg.row_framed(src.telemetry(spark, sf_dir), {how: seg.RowFrame("battery_voltage", 360, how) for how in ("mean", "std", "min", "max")}, DAYS)
    return t.select("row_id", *[F.round(how, 4).alias(f"battery_{how}") for how in ("mean", "std", "min", "max")])


@query(sql.IMPUTED)
def segmented_imputation(spark, sf_dir):
    t = impute.imputed(checked(spark, sf_dir), segment=DAYS)
    return t.select("row_id", *[F.round(c, 6).alias(c) for c in src.SENSORS], "status", "fuel_imputed", "current_imputed", "battery_imputed", "status_imputed", "imputation_confidence", "imputation_confidence_level")


@query(sql.HOURLY_GRID)
def segmented_grid(spark, sf_dir):
    """The hourly timeline, its sites carried over inserted rows from segment to segment."""
    grid = timeline.regular(timeline.floored(src.telemetry(spark, sf_dir), "hour"), 3600, segment=DAYS)
    return grid.select("generator_id", s.micros().alias("timestamp_us"), "site_name", "fuel_level_l", "current", "battery_voltage", "status", "is_inserted_timestamp")


@query(sql.TARGET)
def segmented_target(spark, sf_dir):
    t = fc.target(src.telemetry(spark, sf_dir), 3, 60, segment=DAYS)
    return t.select("row_id", "target_fuel", F.round("target_minutes", 9).alias("target_minutes"), "target_available")


@query(sql.PERSISTENCE)
def segmented_persistence(spark, sf_dir):
    t = fc.persistence(src.telemetry(spark, sf_dir), segment=DAYS)
    return t.select("row_id", "persistence", F.round((s.micros() - F.col("persistence_us")) / 1e6, 6).alias("age_seconds"))


#: Features of the fuel model.
FEATURES = [*src.SENSORS, "fuel_delta", "current_delta", "time_delta_sec", "hour_sin", "hour_cos", "weekday", "fuel_mean_360min", "fuel_std_360min", "current_mean_360min", "fuel_mean_1440min"]


def model_rows(spark, sf_dir):
    """Features, target and split of the rows that have a target."""
    t = fc.calendar(fc.windowed(rules.with_deltas(src.telemetry(spark, sf_dir)), MINUTES))
    # the join of targets packs whole rows, so frames that no feature needs would be made for it
    t = t.select("row_id", "generator_id", "timestamp", *FEATURES)
    return stored(fc.split(fc.target(t, 3, 60)).where("target_available").select("row_id", "generator_id", "timestamp", "split", "target_fuel", *FEATURES), "model-rows")


def model_of(rows):
    """A model of the rows' training part, of the baseline's full size."""
    return gb.fit(rows.where("split = 'train'"), FEATURES)


def predicted(rows, model):
    """The test rows with predictions, made once for all that reads them."""
    return stored(model.predict(rows.where("split = 'test'")), "predictions")


@query()
def boosted_tree_forecast(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    return fc.metrics(fc.with_errors(predicted(rows, model_of(rows))))


@query()
def tuned_forecast(spark, sf_dir):
    """Each configuration's trees and errors; the chosen one's errors on the test rows, which played no part."""
    rows = model_rows(spark, sf_dir)
    best, model, report = gb.tuned(rows.where("split = 'train'"), rows.where("split = 'validation'"), FEATURES)
    off = fc.with_errors(model.predict(rows.where("split = 'test'"))).agg(F.avg("absolute_error").alias("test_mae"))
    out = spark.createDataFrame([(*r, r[0] == best) for r in report], "config string, trees int, train_mae double, validation_mae double, chosen boolean")
    return out.join(off.withColumn("_best", F.lit(True)), F.col("chosen") == F.col("_best"), "left").drop("_best")


@query()
def forecast_importances(spark, sf_dir):
    return model_of(model_rows(spark, sf_dir)).importances(spark)


@query()
def generator_model_performance(spark, sf_dir):
    """Errors of the model for each generator's test rows, and those of persistence over the same rows."""
    rows = model_rows(spark, sf_dir)
    return fc.beside_persistence(predicted(rows, model_of(rows)), src.telemetry(spark, sf_dir))


def in_two_appends(spark, sf_dir):
    """States of the scored telemetry, which arrives in two parts."""
    place = f"{folder(spark)}/dashboard-{uuid.uuid4().hex}"
    store, scored = states.DashboardStore(spark, f"{place}/store"), healthy(spark, sf_dir)
    for part in ("row_id % 3 = 0", "row_id % 3 <> 0"):
        scored.where(part).write.mode("append").parquet(f"{place}/scored")
        store.append(f"{place}/scored")
    return store.states()


@query(sql.FLEET)
def fleet_from_states(spark, sf_dir):
    return states.fleet(in_two_appends(spark, sf_dir))


@query(sql.HEALTH_HISTOGRAM)
def health_histogram_from_states(spark, sf_dir):
    return states.health_histogram(in_two_appends(spark, sf_dir))


@query(sql.FUEL_PAGE)
def fuel_page_from_states(spark, sf_dir):
    return states.fuel_page(in_two_appends(spark, sf_dir))


_DAY = "floor(epoch_us(timestamp) / 86400000000)::BIGINT * 86400000000"


@query(sql._with(sql._H, f"SELECT generator_id, {_DAY} AS start_us, round(avg(fuel_level_l), 8) AS mean_fuel, count(*) AS n_rows FROM H GROUP BY ALL"))
def overview_fuel_series(spark, sf_dir):
    return states.fuel_series(in_two_appends(spark, sf_dir))


@query(sql._with(sql._H, f"SELECT {_DAY} AS start_us, round(avg(overall_sensor_health), 8) AS mean_health, count(*) FILTER (maintenance_priority IN ('Medium', 'High', 'Critical')) AS alerts, count(*) AS n_rows FROM H GROUP BY ALL"))
def sensor_health_trend(spark, sf_dir):
    return states.health_trend(in_two_appends(spark, sf_dir))


@query(sql._with(sql._H, "SELECT s AS status, (SELECT count(*) FROM H WHERE (CASE WHEN contains(lower(status), 'running') THEN 'running' WHEN status = 'stopped' THEN 'stopped' ELSE 'unknown' END) = s) AS n FROM (VALUES ('running'), ('stopped'), ('unknown')) v(s)"))
def overview_status_counts(spark, sf_dir):
    return states.status_counts(in_two_appends(spark, sf_dir))
