"""Telemetry tables: schema, readers, writers, coercions and guards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("site_name", T.StringType()),
        T.StructField("generator_id", T.StringType()),
        T.StructField("site_quality", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("fuel_level_l", T.StringType()),
        T.StructField("current", T.StringType()),
        T.StructField("battery_voltage", T.StringType()),
    ]
)
SENSORS = ["fuel_level_l", "current", "battery_voltage"]
READINGS = [*SENSORS, "status"]


def read_csv(spark: SparkSession, path: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Raw telemetry from CSV: bad timestamps and numbers become null instead of failing the read."""
    return coerce(spark.read.csv(path, header=True, schema=RAW_SCHEMA), timestamp_format)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Some columns of a Parquet table; only these are read."""
    return spark.read.parquet(path).select(*columns)


def coerce(df: DataFrame, timestamp_format: str = "yyyy-MM-dd HH:mm:ss", numbers: Iterable[str] = SENSORS) -> DataFrame:
    """timestamp parsed, numbers cast, NaN and infinities null: what cannot be read is missing."""
    out = df.withColumn("timestamp", F.try_to_timestamp("timestamp", F.lit(timestamp_format)))
    return finite(out.withColumns({c: F.expr(f"try_cast({c} AS double)") for c in numbers}), numbers)


def finite(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """df with NaN and infinite values of the columns null."""
    return df.withColumns({c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in columns})


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_timestamps(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """df, or an error if any of its timestamps is null."""
    bad = df.select(F.count_if(F.col(column).isNull())).first()[0]
    if bad:
        raise ValueError(f"{bad} rows have no {column}")
    return df


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; arrays, maps and structs as JSON text."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    df.withColumns({c: F.to_json(c) for c in nested}).write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(spark: SparkSession, lines: list[str], path: str) -> None:
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """A list written by write_lines: a list of feature names, never a table."""
    return [r.value for r in spark.read.text(path).collect()]


def overview(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_columns, n_generators, n_sites, first and last timestamp in microseconds."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.countDistinct("generator_id").alias("n_generators"),
        F.countDistinct("site_name").alias("n_sites"),
        F.unix_micros(F.min("timestamp")).alias("first_us"),
        F.unix_micros(F.max("timestamp")).alias("last_us"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry made of the events table: row_id orders rows of one generator and timestamp."""
    load = F.get_json_object("props", "$.k").cast("double")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("row_id"),
        F.concat(F.lit("GEN"), (F.col("user_id") % 10).cast("string")).alias("generator_id"),
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("site_name"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("fuel_level_l"),
        F.when(F.col("event_id") % 11 != 0, load).alias("current"),
        (40.0 + load % 20).alias("battery_voltage"),
        F.when(F.col("event_type").isin("click", "view"), "running").when(F.col("event_type").isin("purchase", "signup"), "stopped").alias("status"),
    )


def telemetry_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """telemetry() with every fiftieth packet sent twice, the second time without its current."""
    t = telemetry(spark, sf_dir)
    again = t.where("row_id % 50 = 0").withColumns({"row_id": F.col("row_id") + 1_000_000_000, "current": F.lit(None).cast("double")})
    return t.unionByName(again)
