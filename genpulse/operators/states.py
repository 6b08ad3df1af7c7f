"""Dashboard aggregates that grow with the files that arrive.

A table of scored telemetry is read once: each append lists its files, reads those that no batch has
taken yet, and stores mergeable sums of each generator and hour as a batch of its own. A batch counts
once its list of files is written, which is the last step, so an append that breaks off leaves nothing
behind. Pages come from the merged states, whose number depends on generators and hours alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.series import KEY
from .dashboard import ALERTS

BINS = 20
_HOUR = "hour_us"
_FLAGS = ("fuel_invalid", "fuel_outlier", "fuel_imputed")
#: How states of one generator and hour are merged.
_MERGED = {"least_fuel": F.min, "most_fuel": F.max}


def states(df: DataFrame) -> DataFrame:
    """One row for each generator and hour of scored telemetry: counts, sums and extremes."""
    health, fuel = F.col("overall_sensor_health"), F.col("fuel_level_l")
    running = F.contains(F.lower("status"), F.lit("running"))
    at = F.least(F.floor(health * BINS / 100), F.lit(BINS - 1))
    rate = F.when(F.col("status") == "running", F.col("fuel_rate_lph"))
    sums: dict[str, Column] = {
        "n_rows": F.count(F.lit(1)), "n_running": F.count_if(running), "n_stopped": F.count_if(F.col("status") == "stopped"), "n_unknown": F.count_if(F.col("status").isNull() | ~(running | (F.col("status") == "stopped"))),
        "n_fuel": F.count(fuel), "sum_fuel": F.sum(fuel), "least_fuel": F.min(F.when(fuel >= 0, fuel)), "most_fuel": F.max(fuel), "n_rate": F.count(rate), "sum_rate": F.sum(rate),
        "n_health": F.count(health), "sum_health": F.sum(health), "alerts": F.count_if(F.col("maintenance_priority").isin(*ALERTS)), "n_null_health": F.count_if(health.isNull()),
    }
    sums |= {f"n_{c}": F.count_if(c) for c in _FLAGS} | {f"bin_{b}": F.count_if(at == b) for b in range(BINS)}
    return df.groupBy(KEY, F.unix_micros(F.date_trunc("hour", "timestamp")).alias(_HOUR)).agg(*[x.alias(c) for c, x in sums.items()])


def merged(parts: DataFrame) -> DataFrame:
    """states() of all rows from states() of their parts."""
    sums = [c for c in parts.columns if c not in (KEY, _HOUR)]
    return parts.groupBy(KEY, _HOUR).agg(*[_MERGED.get(c, F.sum)(c).alias(c) for c in sums])


class DashboardStore:
    """States under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        # a table without a batch yet has no folder
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        exists = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if exists else self.spark.createDataFrame([], schema)

    def taken(self) -> DataFrame:
        """(batch, file) of the files whose rows are in the states."""
        return self._read("taken", "batch string, file string")

    def append(self, table: str) -> int:
        """Takes the Parquet files of table that no batch holds; their number. Only these are read."""
        files = self.spark.createDataFrame([(f,) for f in self.spark.read.parquet(table).inputFiles()], "file string")
        new = [r.file for r in files.join(self.taken(), "file", "left_anti").orderBy("file").collect()]
        if new:
            batch = uuid.uuid4().hex
            states(self.spark.read.parquet(*new)).withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.path}/states")
            self.spark.createDataFrame([(batch, f) for f in new], "batch string, file string").coalesce(1).write.mode("append").parquet(f"{self.path}/taken")
        return len(new)

    def states(self) -> DataFrame:
        """The merged states of all batches that have been taken whole."""
        parts = self.spark.read.parquet(f"{self.path}/states")
        return merged(parts.join(self.taken().select("batch").distinct(), "batch", "left_semi").drop("batch"))


def _mean(name: str, digits: int = 4) -> Column:
    return F.round(F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}")), digits)


def fleet(s: DataFrame) -> DataFrame:
    """dashboard.fleet() from states."""
    per = s.groupBy(KEY).agg(*[F.sum(c).alias(c) for c in ("n_running", "n_rows", "alerts", "n_fuel", "sum_fuel", "n_health", "sum_health")])
    # a null generator has states, but is no generator
    known = F.col(KEY).isNotNull()
    out = per.agg(F.count_if(known).alias("generators"), F.count_if(known & (F.col("n_running") > 0)).alias("running"), _mean("fuel").alias("mean_fuel"), _mean("health").alias("mean_health"), F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
    return out.withColumn("stopped", F.col("generators") - F.col("running"))


def health_histogram(s: DataFrame) -> DataFrame:
    """dashboard.health_histogram() from states."""
    one = s.agg(*[F.sum(f"bin_{b}").alias(str(b)) for b in range(BINS)], F.sum("n_null_health").alias("none"))
    long = one.unpivot([], [f"`{b}`" for b in range(BINS)] + ["none"], "bin", "n")
    return long.where("n > 0").select(F.expr("try_cast(bin AS int)").alias("bin"), "n")


def fuel_page(s: DataFrame) -> DataFrame:
    """dashboard.fuel_page() from states."""
    return s.groupBy(KEY).agg(_mean("fuel").alias("mean_fuel"), F.round(F.min("least_fuel"), 4).alias("least_fuel"), F.round(F.max("most_fuel"), 4).alias("most_fuel"), _mean("rate").alias("running_rate"), *[F.sum(f"n_{c}").alias(f"n_{c}") for c in _FLAGS])


def fuel_series(s: DataFrame, hours: int = 24) -> DataFrame:
    """Mean fuel of each generator in each stretch of hours: the overview's curve."""
    at = (F.floor(F.col(_HOUR) / (hours * 3_600_000_000)) * (hours * 3_600_000_000)).alias("start_us")
    return s.where(f"{_HOUR} IS NOT NULL").groupBy(KEY, at).agg(_mean("fuel", 8).alias("mean_fuel"), F.sum("n_rows").alias("n_rows"))


def health_trend(s: DataFrame, hours: int = 24) -> DataFrame:
    """Mean health of the fleet and rows that need maintenance, by stretches of hours: the health page's trend."""
    at = (F.floor(F.col(_HOUR) / (hours * 3_600_000_000)) * (hours * 3_600_000_000)).alias("start_us")
    return s.where(f"{_HOUR} IS NOT NULL").groupBy(at).agg(_mean("health", 8).alias("mean_health"), F.sum("alerts").alias("alerts"), F.sum("n_rows").alias("n_rows"))


def status_counts(s: DataFrame) -> DataFrame:
    """Rows by status: the overview's shares."""
    one = s.agg(*[F.sum(f"n_{k}").alias(k) for k in ("running", "stopped", "unknown")])
    return one.unpivot([], ["running", "stopped", "unknown"], "status", "n")
