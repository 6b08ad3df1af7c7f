"""Aggregates behind the fleet's dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.series import KEY

ALERTS = ("Medium", "High", "Critical")


def fleet(df: DataFrame) -> DataFrame:
    """Generators, those ever running and the rest, mean fuel and health, alerts, rows; one pass."""
    running = F.when(F.contains(F.lower("status"), F.lit("running")), F.col(KEY))
    out = df.agg(F.countDistinct(KEY).alias("generators"), F.countDistinct(running).alias("running"), F.round(F.avg("fuel_level_l"), 4).alias("mean_fuel"), F.round(F.avg("overall_sensor_health"), 4).alias("mean_health"), F.count_if(F.col("maintenance_priority").isin(*ALERTS)).alias("alerts"), F.count(F.lit(1)).alias("n_rows"))
    return out.withColumn("stopped", F.col("generators") - F.col("running"))


def health_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    at = F.least(F.floor(F.col("overall_sensor_health") * bins / 100), F.lit(bins - 1)).cast("int")
    return df.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def fuel_page(df: DataFrame) -> DataFrame:
    """Each generator's mean, least valid and most fuel, mean rate while running, and flagged rows."""
    rate = F.when(F.col("status") == "running", F.col("fuel_rate_lph"))
    return df.groupBy(KEY).agg(
        *[F.round(f, 4).alias(n) for n, f in (("mean_fuel", F.avg("fuel_level_l")), ("least_fuel", F.min(F.when(F.col("fuel_level_l") >= 0, F.col("fuel_level_l")))), ("most_fuel", F.max("fuel_level_l")), ("running_rate", F.avg(rate)))],
        *[F.count_if(c).alias(f"n_{c}") for c in ("fuel_invalid", "fuel_outlier", "fuel_imputed")],
    )


def health_page(df: DataFrame) -> DataFrame:
    health = F.col("overall_sensor_health")
    means = [F.round(F.avg(f"{s}_sensor_health"), 4).alias(f"mean_{s}") for s in ("fuel", "current", "battery", "status")]
    return df.agg(F.round(F.avg(health), 4).alias("mean_health"), F.count_if(health >= 90).alias("healthy"), F.count_if(health < 75).alias("degraded"), F.count_if(F.col("maintenance_priority") != "None").alias("maintenance"), *means)


def worst_health(df: DataFrame, n: int = 100) -> DataFrame:
    return df.orderBy("overall_sensor_health", "row_id").limit(n)


def one_generator(df: DataFrame, generator: str = "All") -> DataFrame:
    return df if generator == "All" else df.where(F.col(KEY) == generator)
