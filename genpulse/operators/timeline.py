"""Regular timelines, duplicates and runs of inserted rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import segments
from ..functions.series import KEY, filled_both_ways, micros
from ..sources.tables import READINGS


def resolved_duplicates(df: DataFrame) -> DataFrame:
    """One row for each generator and timestamp, with duplicate_type and n_packets.

    Exact: the packets agree in every reading. Complementary: no reading has two different values.
    Conflicting: some has; review those with conflicting_packets(). Each reading is the first one
    given, by row_id."""
    facts = ["site_name", *READINGS]
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row_id"))).alias(c) for c in facts]
    kinds = [f(c).alias(f"_{c}_{n}") for c in facts for n, f in (("least", F.min), ("most", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_{c}_null") for c in facts]
    out = df.groupBy(KEY, "timestamp").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("n_packets"), *firsts, *kinds, *nulls)
    # two values differ where the least is not the most; no count of different values, which would multiply the rows
    several = lambda c: F.coalesce(F.col(f"_{c}_least") != F.col(f"_{c}_most"), F.lit(False))
    either = lambda found: reduce(or_, found)
    conflict = either([several(c) for c in READINGS])
    partly = either([several(c) | ((F.col(f"_{c}_null") > 0) & F.col(f"_{c}_least").isNotNull()) for c in facts])
    kind = F.when(F.col("n_packets") == 1, "Single").when(conflict, "Conflicting").when(partly, "Complementary").otherwise("Exact")
    return out.withColumn("duplicate_type", kind).select("row_id", KEY, "timestamp", *facts, "n_packets", "duplicate_type")


def conflicting_packets(df: DataFrame) -> DataFrame:
    bad = resolved_duplicates(df).where("duplicate_type = 'Conflicting'").select(KEY, "timestamp")
    return df.join(bad, [KEY, "timestamp"], "left_semi")


def duplicate_marks(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp_duplicate", F.count(F.lit(1)).over(Window.partitionBy(KEY, "timestamp")) > 1)


def regular(df: DataFrame, step_seconds: int | DataFrame, segment: float | None = None, by: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Every generator on a grid from its first to its last timestamp, readings joined where they
    fall on it exactly. step_seconds: a number, or a table (generator_id, interval). Sites are
    carried to inserted rows. Timestamps must be unique; resolve duplicates first. segment: seconds of
    a series over which one task carries sites; None: a generator in one task. by: what a timeline
    belongs to; where that is a site's generator, sites are those of the timeline."""
    span = df.groupBy(*by).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    if isinstance(step_seconds, DataFrame):
        span = span.join(step_seconds.select(KEY, "interval"), KEY)
    else:
        span = span.withColumn("interval", F.lit(step_seconds))
    grid = span.select(*by, F.col("interval").alias("reporting_interval_sec"), F.explode(F.expr("sequence(a, b, make_dt_interval(0, 0, 0, interval))")).alias("timestamp"))
    out = grid.join(df, [*by, "timestamp"], "left")
    if "site_name" in by:
        pass
    elif segment is None:
        out = out.withColumn("site_name", filled_both_ways("site_name"))
    else:
        out = segments.scan(out, {"site_name": segments.either_known("site_name")}, segment)
    inserted = F.lit(True)
    for c in READINGS:
        inserted = inserted & F.col(c).isNull()
    return out.withColumns({"is_inserted_timestamp": inserted, "is_original_record": ~inserted})


def floored(df: DataFrame, unit: str = "minute") -> DataFrame:
    """df with timestamps floored to the unit and one packet in each: the first."""
    first = Window.partitionBy(KEY, "_unit").orderBy("timestamp", "row_id")
    out = df.withColumn("_unit", F.date_trunc(unit, "timestamp")).withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return out.withColumn("timestamp", F.col("_unit")).drop("_unit", "_n")


def inserted_runs(grid: DataFrame, short: float = 2, medium: float = 10) -> DataFrame:
    """Runs of inserted rows: generator, start_us, end_us, n_rows, minutes and gap_class."""
    w = Window.partitionBy(KEY).orderBy("timestamp")
    changed = F.coalesce((F.col("is_inserted_timestamp") != F.lag("is_inserted_timestamp").over(w)).cast("int"), F.lit(1))
    runs = grid.withColumn("_changed", changed).withColumn("_run", F.sum("_changed").over(w))
    out = runs.where("is_inserted_timestamp").groupBy(KEY, "_run").agg(F.min(micros()).alias("start_us"), F.max(micros()).alias("end_us"), F.count(F.lit(1)).alias("n_rows"), F.first("reporting_interval_sec").alias("_step"))
    minutes = F.col("n_rows") * F.col("_step") / 60
    kind = F.when(minutes <= short, "Short").when(minutes <= medium, "Medium").otherwise("Long")
    return out.select(KEY, "start_us", "end_us", "n_rows", F.round(minutes, 4).alias("minutes"), kind.alias("gap_class"))


def timeline_summary(grid: DataFrame) -> DataFrame:
    out = grid.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("is_inserted_timestamp").alias("inserted"))
    return out.withColumn("availability", F.round(100 * (F.col("n_rows") - F.col("inserted")) / F.col("n_rows"), 4))
