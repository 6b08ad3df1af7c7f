"""Filling of missing readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import segments
from ..functions.series import bands, clipped, flag, interpolated, seconds_since_last
from ..sources.tables import SENSORS
from .profile import gap_category
from .rules import LEVELS

SHORT = {"fuel_level_l": "fuel", "current": "current", "battery_voltage": "battery"}


def short_gaps_filled(df: DataFrame, limit: int = 2) -> DataFrame:
    """df with <sensor>_clean, is_estimated, estimated_fields: values in line over at most `limit`
    rows, only in rows whose gap to the one before is normal or short."""
    out = df.withColumn("gap_type", gap_category(seconds_since_last() / 60))
    near = F.col("gap_type").isin("normal", "short")
    out = out.withColumns({f"{c}_clean": F.when(F.col(c).isNotNull(), F.col(c)).when(near, interpolated(c, limit)) for c in SENSORS})
    filled = [F.when(F.col(c).isNull() & F.col(f"{c}_clean").isNotNull(), c) for c in SENSORS]
    return out.withColumn("estimated_fields", F.concat_ws(";", *filled)).withColumn("is_estimated", F.col("estimated_fields") != "")


def imputed(df: DataFrame, limit: int = 10, stopped_is_zero: bool = False, segment: float | None = None) -> DataFrame:
    """df with readings filled in line by row position, and a flag for each that was.

    stopped_is_zero: a missing current or voltage of a stopped generator is 0 before the line is
    drawn. A missing status, or one that says nothing, becomes running, stopped or unknown after
    estimated_status. imputation_confidence falls with each filled reading and with telemetry quality.
    segment: seconds of a series that one task takes; None: a generator in one task.
    """
    out = df
    if stopped_is_zero:
        zero = F.col("estimated_status") == "Stopped"
        out = out.withColumns({c: F.when(F.col(c).isNull() & zero, 0.0).otherwise(F.col(c)) for c in ("current", "battery_voltage")})
    if segment is None:
        out = out.withColumns({f"_{c}": interpolated(c, limit) for c in SENSORS})
    else:
        out = segments.scan(out, {f"_{c}": segments.line(c, limit) for c in SENSORS}, segment)
    flags = {f"{short}_imputed": df_null(c) & F.col(f"_{c}").isNotNull() for c, short in SHORT.items()}
    silent = F.col("status").isNull() | F.lower(F.trim("status")).isin("unknown", "nan", "none")
    state = F.lower(F.coalesce("estimated_status", F.lit("")))
    told = F.when(F.contains(state, F.lit("running")) | (state == "idle"), "running").when(F.contains(state, F.lit("stopped")), "stopped").otherwise("unknown")
    out = out.withColumns({**flags, "status_imputed": silent})
    out = out.withColumns({c: F.col(f"_{c}") for c in SENSORS}).withColumn("status", F.when(silent, told).otherwise(F.col("status"))).drop(*[f"_{c}" for c in SENSORS])
    return out.withColumn("imputation_confidence", confidence()).withColumn("imputation_confidence_level", bands(F.col("imputation_confidence"), LEVELS, "Very Low"))


def completed_status(df: DataFrame) -> DataFrame:
    """The older completion: a missing status becomes the estimated one as it is, flagged by status_imputed."""
    return df.withColumns({"status_imputed": F.col("status").isNull(), "status": F.coalesce("status", "estimated_status")})


def df_null(column: str) -> F.Column:
    return F.col(column).isNull()


def confidence() -> F.Column:
    """100, less 20 for each filled sensor and 15 for the status, times quality in percent."""
    lost = sum(20 * flag(F.col(f"{s}_imputed")).cast("int") for s in SHORT.values()) + 15 * flag(F.col("status_imputed")).cast("int")
    return F.bround(clipped((100.0 - lost) * F.coalesce("telemetry_quality_score", F.lit(100.0)) / 100), 2)


def first_confidence(estimated_confidence: F.Column) -> F.Column:
    """The older measure: 15 for fuel and 10 for each other filled reading, blended with the state's confidence."""
    lost = 15 * flag(F.col("fuel_imputed")).cast("int") + sum(10 * flag(F.col(f"{s}_imputed")).cast("int") for s in ("current", "battery", "status"))
    return clipped((100.0 - lost) * 0.7 + estimated_confidence * 0.3)


def imputation_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """feature, missing_before, missing_after, filled."""
    columns = [*SENSORS, "status"]
    count = lambda df, name: df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot([], columns, "feature", name)
    out = count(before, "missing_before").join(count(after, "missing_after"), "feature")
    return out.withColumn("filled", F.col("missing_before") - F.col("missing_after"))
