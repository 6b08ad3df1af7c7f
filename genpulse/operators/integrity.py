"""Checks of features and targets before a model sees them, and values cleaned for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.series import KEY, change, flag, interpolated, micros, rolling, seconds_since_last, series
from ..sources.tables import SENSORS
from .forecast import leaking

#: The reading that some sensors send for "no value", and the tolerances it is met with.
SENTINEL, ABSOLUTE, RELATIVE = -0.24, 1e-6, 1e-5
#: Shortest time over which a rate is taken.
EPSILON = 1e-6


def signed_rates(df: DataFrame) -> DataFrame:
    """df with fuel_rate_lps and fuel_rate_lph, refills positive; null unless time has passed."""
    seconds = F.greatest(seconds_since_last(), F.lit(0.0))
    rate = F.when(seconds > EPSILON, change("fuel_level_l") / seconds)
    return df.withColumn("fuel_rate_lps", rate).withColumn("fuel_rate_lph", F.col("fuel_rate_lps") * 3600)


def clamped_rates(df: DataFrame) -> DataFrame:
    """df with fuel_rate_lps and fuel_rate_lph of consumption; null unless time has passed and fuel has not risen."""
    seconds = seconds_since_last()
    rate = F.when(seconds > 0, -change("fuel_level_l") / seconds)
    return df.withColumn("_rate", rate).withColumn("fuel_rate_lps", F.when(F.col("_rate") >= 0, F.col("_rate"))).withColumn("fuel_rate_lph", F.col("fuel_rate_lps") * 3600).drop("_rate")


def validity_flags(df: DataFrame) -> DataFrame:
    """df with 0/1 flags: <sensor>_invalid for negative readings, and sensor_state_conflict: current flows at no voltage."""
    low = {f"{c}_invalid": flag(F.col(c) < 0).cast("int") for c in SENSORS}
    return df.withColumns({**low, "sensor_state_conflict": flag((F.col("current") > 5) & (F.col("battery_voltage") <= 0)).cast("int")})


def target_flags(df: DataFrame, target: str = "target_fuel") -> DataFrame:
    """df with 0/1 flags target_negative, target_sentinel and target_valid: present and not negative."""
    t = F.col(target)
    near = F.abs(t - SENTINEL) <= ABSOLUTE + RELATIVE * abs(SENTINEL)
    return df.withColumns({"target_negative": flag(t < 0).cast("int"), "target_sentinel": flag(near).cast("int"), "target_valid": flag(t >= 0).cast("int")})


def flag_mismatches(df: DataFrame, target: str = "target_fuel") -> DataFrame:
    """One row: how many rows carry a target flag other than their target gives."""
    names = ["target_negative", "target_sentinel", "target_valid"]
    again = target_flags(df.withColumns({f"_{n}": F.col(n) for n in names}), target)
    return again.agg(*[F.count_if(~F.col(n).eqNullSafe(F.col(f"_{n}"))).alias(n) for n in names])


def target_availability(df: DataFrame, target: str = "target_fuel") -> DataFrame:
    """Rows, valid and negative targets, and the percentage valid, of each generator."""
    out = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(target) >= 0).alias("valid"), F.count_if(F.col(target) < 0).alias("negative"))
    return out.withColumn("percent", F.round(100 * F.col("valid") / F.col("n_rows"), 4))


def target_timing(df: DataFrame, hours: float = 3, tolerance_minutes: float = 5) -> DataFrame:
    """One row: targets matched before their time, and later than the tolerance allows; over forecast.target()."""
    late = (F.col("target_us") - micros() - int(hours * 3600e6)) / 60e6
    return df.agg(F.count("target_us").alias("matched"), F.count_if(late < 0).alias("too_early"), F.count_if(late > tolerance_minutes).alias("too_late"))


def valid_targets(df: DataFrame, target: str = "target_fuel") -> DataFrame:
    return df.where(F.col(target).isNotNull() & (F.col(target) >= 0) & F.col("timestamp").isNotNull() & F.col(KEY).isNotNull())


def clamped_changes(df: DataFrame, columns: list[str], most: float = 500.0, target: str | None = None) -> DataFrame:
    """df with negative fuel, negative targets and changes beyond `most` set to null."""
    out = {"fuel_level_l": F.when(F.col("fuel_level_l") >= 0, F.col("fuel_level_l"))}
    out.update({c: F.when(F.abs(c) <= most, F.col(c)) for c in columns})
    if target:
        out[target] = F.when(F.col(target) >= 0, F.col(target))
    return df.withColumns(out)


def model_input(df: DataFrame, most: float = 100.0) -> DataFrame:
    """df with negative fuel and hourly rates beyond `most` set to null."""
    return df.withColumns({"fuel_level_l": F.when(F.col("fuel_level_l") >= 0, F.col("fuel_level_l")), "fuel_rate_lph": F.when(F.abs("fuel_rate_lph") <= most, F.col("fuel_rate_lph"))})


def efficiency(df: DataFrame) -> DataFrame:
    """df with consumption since the row before, by ampere and by hour, and 0/1 flags of what the generator does."""
    used = F.coalesce(F.greatest(F.lit(0.0), -change("fuel_level_l")), F.lit(0.0)) + F.lit(0.0)  # no negative zero
    out = df.withColumn("fuel_consumption_rate", used)
    rate = F.col("fuel_consumption_rate")
    return out.withColumns(
        {
            "fuel_per_amp": F.when(F.col("current") > 0, F.try_divide(rate, "current")).otherwise(0.0),
            "fuel_per_hour": rate * 60,
            "generator_running": flag(F.col("status") == "running").cast("int"),
            "generator_stopped": flag(F.col("status") == "stopped").cast("int"),
            "has_current": flag(F.col("current") > 5).cast("int"),
            "battery_charging": flag(F.col("battery_voltage") > 48).cast("int"),
            "poor_quality": flag(F.coalesce("telemetry_quality_score", F.lit(100.0)) < 80).cast("int") if "telemetry_quality_score" in df.columns else F.lit(0),
        }
    )


def grid_features(grid: DataFrame, windows: tuple[int, ...] = (15, 60), ahead: int = 180, refill: float = -5.0) -> DataFrame:
    """Features of a regular grid by row: is_missing_packet, fuel_diff_raw (consumption positive),
    fuel_consumption_rate (only from one packet to the next), is_refueling, means over the last
    windows of steps, and target: fuel `ahead` rows on."""
    step = F.first("reporting_interval_sec").over(Window.partitionBy(KEY))
    there = F.col("fuel_level_l").isNotNull()
    out = grid.withColumns({"is_missing_packet": ~there, "fuel_diff_raw": -change("fuel_level_l"), "_step": step})
    steady = there & (seconds_since_last() == F.col("_step"))
    means = {f"fuel_mean_{n}": F.avg("fuel_level_l").over(series().rowsBetween(-(n - 1), 0)) for n in windows}
    return out.withColumns(
        {
            "fuel_consumption_rate": F.when(steady, F.col("fuel_diff_raw")),
            "is_refueling": flag(F.col("fuel_diff_raw") < refill),
            **means,
            "target": F.lead("fuel_level_l", ahead).over(series()),
        }
    ).drop("_step")


def chronology(df: DataFrame) -> DataFrame:
    """For each generator, how many rows come no later than the row before, by row_id."""
    before = F.lag(micros()).over(Window.partitionBy(KEY).orderBy("row_id"))
    return df.select(KEY, (micros() <= before).alias("back")).groupBy(KEY).agg(F.count_if("back").alias("out_of_order"))


def duplicate_structure(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: groups of rows that share their keys, and rows beyond the first of each."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"))


def full_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows that repeat another in every column."""
    return duplicate_structure(df, df.columns).select(F.col("extra_rows").alias("full_duplicates"))


def doubled_columns(df: DataFrame) -> list[str]:
    return sorted({c for c in df.columns if df.columns.count(c) > 1})


#: The features that a forecasting table must have.
REQUIRED_FEATURES = [
    "hour", "minute", "weekday", "day", "month", "is_weekend",
    "fuel_delta", "time_delta_sec", "fuel_rate_lps", "fuel_rate_lph", "current_delta", "voltage_delta",
    "fuel_invalid", "current_invalid", "battery_invalid", "fuel_outlier", "current_outlier", "timestamp_gap_seconds", "timestamp_gap",
    "fuel_change_15min", "fuel_change_30min", "fuel_change_60min", "fuel_refill_signal", "fuel_drop_signal",
    *[f"{s}_{how}_{m}min" for s in ("fuel", "current", "battery") for how in ("mean", "std") for m in (5, 15, 30, 60)],
    "fuel_trend_15min", "fuel_trend_30min", "fuel_trend_60min", "battery_zero", "fuel_zero_or_negative", "current_active", "sensor_state_conflict",
]


def required_features(df: DataFrame) -> DataFrame:
    """(feature, present) of the features that a forecasting table must have; means of probability and
    quality are among them where the table has these."""
    names = list(REQUIRED_FEATURES)
    for source, short in (("running_probability", "running_probability"), ("telemetry_quality_score", "telemetry_quality")):
        if source in df.columns:
            names += [f"{short}_mean_{m}min" for m in (5, 15, 30, 60)]
    missing = set(required(df, names))
    return df.sparkSession.createDataFrame([(c, c not in missing) for c in names], "feature string, present boolean")


def required(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of columns that df lacks."""
    return [c for c in columns if c not in df.columns]


def preservation(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each column, and `rows` first: missing and negative values before and after, and whether they are the same."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        per = [F.struct(F.lit("rows").alias("feature"), F.count(F.lit(1)).alias("missing"), F.lit(0).cast("long").alias("negative"))]
        per += [F.struct(F.lit(c).alias("feature"), F.count_if(F.col(c).isNull()).alias("missing"), F.count_if(F.col(c) < 0).alias("negative")) for c in columns]
        one = df.agg(F.array(*per).alias("all")).select(F.explode("all").alias("r"))
        return one.select("r.feature", F.col("r.missing").alias(f"missing_{name}"), F.col("r.negative").alias(f"negative_{name}"))

    out = counts(before, "before").join(counts(after, "after"), "feature")
    return out.withColumn("preserved", (F.col("missing_before") == F.col("missing_after")) & (F.col("negative_before") == F.col("negative_after")))


def column_scan(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature, missing_rate, n_infinite and no_variance of each column, from one pass."""
    endless = lambda c: F.abs(F.col(c).cast("double")) == float("inf")
    per = [
        F.struct(F.lit(c).alias("feature"), F.round(F.avg(F.col(c).isNull().cast("double")), 6).alias("missing_rate"), F.count_if(endless(c)).alias("n_infinite"), F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias("no_variance"))
        for c in columns
    ]
    return df.agg(F.array(*per).alias("all")).select(F.explode("all").alias("r")).select("r.*")


def validated_output(before: DataFrame, after: DataFrame, features: list[str], target: str = "target_fuel") -> DataFrame:
    """after, or an error where it has other rows or targets than before, doubled or missing columns,
    leaking features, or infinite values. Three aggregates; no rows come to the driver."""
    wrong = [*doubled_columns(after), *required(after, features), *leaking(features)]
    if wrong:
        raise ValueError(f"doubled, missing or leaking columns: {wrong}")
    facts = lambda df: tuple(df.agg(F.count(F.lit(1)), F.count(target), F.sum(F.xxhash64(target).cast("decimal(38,0)"))).first())
    if facts(before) != facts(after):
        raise ValueError("rows or targets are not those of the input")
    endless = column_scan(after, features).where("n_infinite > 0").select("feature").collect()
    if endless:
        raise ValueError(f"infinite values: {[r.feature for r in endless]}")
    return after


def correlations(df: DataFrame, features: list[str], target: str = "target_fuel", top: int = 20) -> DataFrame:
    """feature and absolute correlation with the target where both are known, strongest first."""
    both = lambda c: F.corr(F.when(F.col(target).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(target)))
    one = df.agg(*[F.abs(both(c)).alias(c) for c in features])
    out = one.unpivot([], features, "feature", "correlation").withColumn("correlation", F.round("correlation", 6))
    return out.orderBy(F.desc_nulls_last("correlation"), "feature").limit(top)


def coverage(df: DataFrame) -> DataFrame:
    """First and last time, rows and hours of each generator."""
    out = df.groupBy(KEY).agg(F.min(micros()).alias("start_us"), F.max(micros()).alias("end_us"), F.count(F.lit(1)).alias("n_rows"))
    return out.withColumn("duration_hours", F.round((F.col("end_us") - F.col("start_us")) / 3600e6, 4))


def joined_summaries(left: DataFrame, right: DataFrame, suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """left join of two tables of one row a generator, their other columns told apart by suffix."""
    named = lambda df, s: df.select(KEY, *[F.col(c).alias(f"{c}{s}") for c in df.columns if c != KEY])
    return named(left, suffixes[0]).join(named(right, suffixes[1]), KEY, "left")


def largest(df: DataFrame, column: str | Column, n: int = 20, tie: str = "row_id") -> DataFrame:
    """The n rows of largest magnitude."""
    value = F.col(column) if isinstance(column, str) else column
    return df.where(value.isNotNull()).orderBy(F.desc(F.abs(value)), tie).limit(n)


def estimation_summary(df: DataFrame) -> DataFrame:
    """How many rows were estimated, and how many values of each sensor; over impute.short_gaps_filled()."""
    filled = {c: F.count_if(F.col(c).isNull() & F.col(f"{c}_clean").isNotNull()).alias(f"{c}_estimated") for c in SENSORS}
    return df.agg(F.count_if("is_estimated").alias("rows_estimated"), *filled.values())


def stopped_filled(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """df with missing readings of a stopped generator as 0, and then filled in line over at most limit rows."""
    zero = F.when(F.col(column).isNull() & (F.lower("status") == "stopped"), 0.0).otherwise(F.col(column))
    return df.withColumn(column, zero).withColumn(column, interpolated(column, limit))


def rolling_means(df: DataFrame, columns: list[str], minutes: int) -> DataFrame:
    """df with <column>_mean: over the last minutes, from one value on."""
    return df.withColumns({f"{c}_mean": rolling(c, 60 * minutes, 1, "mean") for c in columns})
