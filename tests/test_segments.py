import math
import random
import re

import pytest
from helpers import column, telemetry
from pyspark.sql import functions as F

from genpulse.functions import segments as seg
from genpulse.functions import series as s


def some_rows(spark, seed=1, n=400):
    """Three generators, one of few rows, with ties on the edges of segments, gaps of several segments, nulls and rows without a time."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        t = rng.choice([rng.randrange(4000), 100 * rng.randrange(40), 100 * rng.randrange(8), 9000 + rng.randrange(50)])
        x = rng.choice([None, None, float(rng.randrange(100)), rng.randrange(1000) / 8])
        rows.append((rng.choice(["A", "A", "A", "B"]) if k > 5 else "C", t, x, rng.choice([None, float(k)]), None, rng.choice([None, "on", "off"])))
    df = telemetry(spark, rows)
    lost = F.col("row_id").isin(7, 8, 9, 10)
    return df.withColumn("timestamp", F.when(~lost, F.col("timestamp"))).withColumn("generator_id", F.when(F.col("row_id") % 50 != 0, F.col("generator_id"))).repartition(3)


@pytest.mark.parametrize("width", [100.0, 1000.0, 1e9])
def test_scans_equal_windows_over_whole_series(spark, width):
    df = some_rows(spark)
    w = s.series()
    want = df.withColumns(
        {
            "lag1": F.lag("current", 1).over(w), "lag7": F.lag("status", 7).over(w), "lag40": F.lag("fuel_level_l", 40).over(w), "total": s.cumulative("fuel_level_l"), "n": F.row_number().over(w),
            "before": F.last("status", True).over(s.so_far(w)), "after": F.last("status", True).over(s.so_far(s.reversed_series())), "known": s.filled_both_ways("fuel_level_l"),
            "line2": s.interpolated("fuel_level_l", 2), "line50": s.interpolated("current", 50),
        }
    )
    steps = {
        "lag1": seg.lag("current"), "lag7": seg.lag("status", 7), "lag40": seg.lag("fuel_level_l", 40), "total": seg.total("fuel_level_l"), "n": seg.place(),
        "before": seg.last_known("status"), "after": seg.next_known("status"), "known": seg.either_known("fuel_level_l"), "line2": seg.line("fuel_level_l", 2), "line50": seg.line("current", 50),
    }
    got = seg.scan(df, steps, width)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("width", [100.0, 700.0, 1e9])
def test_frames_equal_windows_over_whole_series(spark, width):
    df = some_rows(spark, 2)
    frames = {f"{how}{t}": seg.Frame("fuel_level_l", t, 2, how) for how in ("mean", "std", "sum") for t in (60, 100, 650)}
    want = df.withColumns({name: s.rolling(f.column, f.seconds, f.least, f.how) for name, f in frames.items()})
    # frames of rows without a time mean nothing; in segments they hold these rows only
    known = "timestamp IS NOT NULL"
    assert sorted(map(str, seg.framed(df, frames, width).where(known).collect())) == sorted(map(str, want.where(known).collect()))


@pytest.mark.parametrize("width", [100.0, 1e9])
def test_row_frames_equal_windows_over_whole_series(spark, width):
    df = some_rows(spark, 6).withColumn("current", F.col("row_id").cast("double"))
    frames = {f"{c}_{how}{n}": seg.RowFrame(c, n, how) for c in ("fuel_level_l", "current") for how in ("mean", "std", "min", "max") for n in (1, 2, 7, 60)}
    want = df.withColumns({name: s.rolling_rows(f.column, f.rows, f.how) for name, f in frames.items()})
    got, rounded = seg.row_framed(df, frames, width), [F.round(c, 7).alias(c) for c in frames]
    assert got.columns == want.columns
    assert sorted(map(str, got.select("row_id", *rounded).collect())) == sorted(map(str, want.select("row_id", *rounded).collect()))


def test_long_row_frames_take_linear_time(spark):
    import time

    rows = spark.range(200_000).selectExpr("id AS row_id", "'G' AS generator_id", "timestamp_seconds(id * 60) AS timestamp", "double(id % 1000) AS x")
    began = time.perf_counter()
    got = seg.row_framed(rows, {"top": seg.RowFrame("x", 20_000, "max"), "mid": seg.RowFrame("x", 20_000, "mean")}, 86_400.0).agg(F.count("top"), F.min("top"), F.min("mid"), F.max("mid")).first()
    assert got[:2] == (180_001, 999.0) and got[2:] == pytest.approx((499.5, 499.5)) and time.perf_counter() - began < 90


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("tolerance", [None, 300])
def test_asof_equals_one_window(spark, forward, tolerance):
    probes, builds = some_rows(spark, 3), some_rows(spark, 4).where("fuel_level_l IS NOT NULL AND timestamp IS NOT NULL AND generator_id IS NOT NULL")
    at = F.col("timestamp") + F.expr("interval 130 seconds")
    for width in (100.0, 1e9):
        got = seg.asof(probes, builds, at, forward, tolerance, "fuel_level_l", "v", "t", width).where("timestamp IS NOT NULL")
        want = s.asof(probes, builds, at, forward, tolerance, "fuel_level_l", "v", "t").where("timestamp IS NOT NULL")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_generator_runs_in_many_tasks(spark):
    rows = spark.range(400_000).selectExpr("id AS row_id", "'G' AS generator_id", "timestamp_seconds(id * 60) AS timestamp", "CASE WHEN id % 5 = 0 THEN double(id) END AS fuel_level_l")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = seg.scan(rows, {"line": seg.line("fuel_level_l", 10), "before": seg.lag("fuel_level_l", 5)}, 86_400.0)
        tasks = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("line").alias("n"), F.max(F.abs(F.col("line") - F.col("row_id"))).alias("off"), F.count("before").alias("b")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and min(r.n for r in tasks) > 50_000
    assert sum(r.n for r in tasks) == 400_000 and max(r.off for r in tasks) == 4 and sum(r.b for r in tasks) == 80_000 - 1


def test_empty_series(spark):
    none = some_rows(spark).where("false")
    assert seg.scan(none, {"x": seg.lag("current"), "y": seg.line("current", 2)}).count() == seg.framed(none, {"x": seg.Frame("current", 5)}).count() == 0


def test_frames_survive_readings_that_no_decimal_holds(spark):
    nan, inf = float("nan"), float("inf")
    df = telemetry(spark, [("G", k, v, None, None, None) for k, v in enumerate([1, 1e10, 3, nan, inf, 1e-7, 5])])
    for got in (df.withColumn("x", s.rolling("fuel_level_l", 100, 1, "sum")), seg.framed(df, {"x": seg.Frame("fuel_level_l", 100, 1, "sum")}, 2.0)):
        assert column(got, "x") == [1, 1, 4, 4, 4, 4, 9] and not any(map(math.isnan, column(got, "x")))


def test_frames_in_segments_sort_rows_once(spark):
    df = telemetry(spark, [("G", 60 * k, k, k, k, "x") for k in range(50)])
    out = seg.framed(df, {f"{how}_{n}": seg.Frame("current", n, 2, how) for how in ("mean", "std", "sum") for n in (300, 900)}, 1800)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"\bSort \[", plan)) == 1
