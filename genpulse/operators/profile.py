"""Profiles of raw telemetry: packets, gaps, availability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.selection import percentiles
from ..functions.series import KEY, micros, seconds_since_last
from ..sources.tables import READINGS

#: Gap histogram: label, lower bound excluded, upper bound included, in seconds.
GAPS = [("<30 s", 0, 30), ("30-90 s", 30, 90), ("90-150 s", 90, 150), ("150-300 s", 150, 300), ("300-900 s", 300, 900), (">900 s", 900, None)]


def classified(df: DataFrame) -> DataFrame:
    """df with missing_sensor_count and packet_type: Complete, Partial or Empty."""
    missing = sum(F.col(c).isNull().cast("int") for c in READINGS)
    kind = F.when(F.col("missing_sensor_count") == 0, "Complete").when(F.col("missing_sensor_count") == len(READINGS), "Empty").otherwise("Partial")
    return df.withColumn("missing_sensor_count", missing).withColumn("packet_type", kind)


def packet_summary(df: DataFrame) -> DataFrame:
    counts = classified(df).groupBy("packet_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def missing_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature, n_missing, percent of each column, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = one.unpivot(["n"], columns, "feature", "n_missing")
    return long.select("feature", "n_missing", F.round(F.try_divide(100 * F.col("n_missing"), "n"), 4).alias("percent"))


def partial_packets(df: DataFrame) -> DataFrame:
    return missing_by_column(classified(df).where("packet_type = 'Partial'"), READINGS)


def generator_summary(df: DataFrame, minutes: float = 1.0) -> DataFrame:
    """Expected and actual records of each generator at a cadence of `minutes`; availability may exceed 100."""
    span = df.groupBy(KEY).agg(F.min(micros()).alias("first_us"), F.max(micros()).alias("last_us"), F.count(F.lit(1)).alias("actual"), F.countDistinct("timestamp").alias("_times"))
    expected = (F.floor((F.col("last_us") - F.col("first_us")) / (60e6 * minutes)) + 1).cast("long")
    out = span.withColumn("expected", expected)
    return out.select(
        KEY, "first_us", "last_us", "expected", "actual",
        F.greatest(F.lit(0), F.col("expected") - F.col("actual")).cast("long").alias("missing"),
        (F.col("actual") - F.col("_times")).alias("duplicates"),
        F.round(100 * F.col("actual") / F.col("expected"), 4).alias("availability"),
    )


def gap_histogram(df: DataFrame) -> DataFrame:
    """Count of gaps in each class; classes without gaps stay, gaps of zero seconds fall in none."""
    gap = df.select(seconds_since_last().alias("gap"))
    inside = lambda low, high: (F.col("gap") > low) & (F.lit(True) if high is None else F.col("gap") <= high)
    one = gap.agg(*[F.count_if(inside(low, high)).alias(name) for name, low, high in GAPS])
    return one.unpivot([], [f"`{name}`" for name, _, _ in GAPS], "gap_class", "n")


def gap_events(df: DataFrame, minutes: float = 2.0) -> DataFrame:
    """Gaps longer than `minutes`: generator, end in microseconds, length in minutes."""
    gaps = df.select(KEY, "row_id", micros().alias("gap_end_us"), (seconds_since_last() / 60).alias("gap_minutes"))
    return gaps.where(F.col("gap_minutes") > minutes).withColumn("gap_minutes", F.round("gap_minutes", 4))


def gap_category(minutes: F.Column) -> F.Column:
    """unknown, normal (2), short (5), medium (30) or long, by the gap before a row in minutes."""
    return F.when(minutes.isNull(), "unknown").when(minutes <= 2, "normal").when(minutes <= 5, "short").when(minutes <= 30, "medium").otherwise("long")


def gap_categories(df: DataFrame) -> DataFrame:
    return df.withColumn("category", gap_category(seconds_since_last() / 60)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def missing_periods(df: DataFrame, unit: str = "hour") -> DataFrame:
    """Periods between a generator's first and last without a record: generator, period_us."""
    there = df.select(KEY, F.date_trunc(unit, "timestamp").alias("period")).distinct()
    span = there.groupBy(KEY).agg(F.min("period").alias("a"), F.max("period").alias("b"))
    grid = span.select(KEY, F.explode(F.expr(f"sequence(a, b, interval 1 {unit})")).alias("period"))
    return grid.join(there, [KEY, "period"], "left_anti").select(KEY, micros("period").alias("period_us"))


def status_crosstab(df: DataFrame) -> DataFrame:
    """Reported status against packet type."""
    kinds = ["Complete", "Partial", "Empty"]
    counts = classified(df).groupBy(F.coalesce("status", F.lit("none")).alias("status"))
    return counts.agg(*[F.count_if(F.col("packet_type") == k).alias(k.lower()) for k in kinds])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles of each column, one row each."""
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "least": F.min, "most": F.max}
    measured = [F.struct(F.lit(c).alias("feature"), *[f(c).cast("double").alias(k) for k, f in stats.items()]) for c in columns]
    rows = df.agg(F.array(*measured).alias("all")).select(F.explode("all").alias("r")).select("r.*")
    quartiles = percentiles(df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "feature", "value"), "value", [0.25, 0.5, 0.75], ["feature"])
    rows = rows.join(quartiles, "feature", "left").withColumns({f"p{p}": F.col("q")[k] for k, p in enumerate((25, 50, 75))}).drop("q")
    return rows.withColumns({c: F.round(c, 4) for c in rows.columns if c != "feature"})
