"""Whole stages, from a table of telemetry to a table of results: what a user chains on tables of their own.

Each takes telemetry (row_id, generator_id, site_name, timestamp, the readings of sources.tables.READINGS
and any other columns) and adds columns to it. segment is the number of seconds of a series that one
task takes where the stage allows it; None keeps a generator in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import forecast, impute, rules, timeline

Stage = Callable[[DataFrame], DataFrame]


def stated(telemetry: DataFrame, segment: float | None = None) -> DataFrame:
    """Changes and rates, and the state that sensors vote for."""
    return rules.estimated_state(rules.with_deltas(telemetry, segment))


def checked(telemetry: DataFrame, segment: float | None = None) -> DataFrame:
    """stated(), validated."""
    return rules.validated(stated(telemetry, segment))


def completed(telemetry: DataFrame, limit: int = 10, segment: float | None = None) -> DataFrame:
    """checked(), with missing readings and states filled in."""
    return impute.imputed(checked(telemetry, segment), limit, segment=segment)


def healthy(telemetry: DataFrame, segment: float | None = None) -> DataFrame:
    """completed(), with the health of each sensor and maintenance priorities."""
    return rules.sensor_health(completed(telemetry, segment=segment))


def anomalous(telemetry: DataFrame, segment: float | None = None) -> DataFrame:
    """checked(), with anomalies, their scores and actions."""
    return rules.anomalies(checked(telemetry, segment))


def fused(telemetry: DataFrame, segment: float | None = None) -> DataFrame:
    """Changes and rates, and the state fused from evidence against learnt thresholds."""
    return rules.fused_state(rules.with_deltas(telemetry, segment))


def regular(telemetry: DataFrame, step_seconds: int | DataFrame, segment: float | None = None) -> DataFrame:
    """Duplicates resolved, then every generator on its grid."""
    return timeline.regular(timeline.resolved_duplicates(telemetry), step_seconds, segment)


def features(telemetry: DataFrame, minutes: tuple[int, ...] = (5, 15, 30, 60), segment: float | None = None) -> DataFrame:
    """What a fuel model sees: calendar, changes, flags and frames, with those of probability and quality."""
    t = forecast.calendar(forecast.sensor_flags(forecast.changes(checked(telemetry, segment))))
    return forecast.windowed(t, minutes, more=("running_probability", "telemetry_quality_score"), segment=segment)


def model_rows(telemetry: DataFrame, hours: float = 3, tolerance_minutes: float = 5, minutes: tuple[int, ...] = (5, 15, 30, 60), segment: float | None = None) -> DataFrame:
    """features() with target and split, where there is a target."""
    return forecast.split(forecast.target(features(telemetry, minutes, segment), hours, tolerance_minutes)).where("target_available")


def run(telemetry: DataFrame, stages: list[Stage]) -> DataFrame:
    """The stages one after another."""
    out = telemetry
    for stage in stages:
        out = stage(out)
    return out
