import random
import time

import numpy as np
import pandas as pd
import pytest
from helpers import column, telemetry
from pyspark.sql import functions as F

from genpulse.functions import series as s
from genpulse.operators import cadence, forecast, impute, profile, rules, timeline
from genpulse.sources import tables


def fuel(spark, times, values):
    return telemetry(spark, [("G", t, v, None, None, None) for t, v in zip(times, values)])


def test_time_frame_ends_at_the_row_and_not_at_its_peers(spark):
    df = fuel(spark, [0, 300, 300, 600, 900], [1, 2, 4, 8, 16])
    assert column(df.withColumn("x", s.rolling("fuel_level_l", 300, 1, "sum")), "x") == [1, 2, 6, 8, 16]


def test_time_frame_needs_enough_values(spark):
    df = fuel(spark, [0, 60, 120, 180], [1, None, 3, 4])
    assert [x and round(x, 4) for x in column(df.withColumn("x", s.rolling("fuel_level_l", 300, 3)), "x")] == [None, None, None, 2.6667]


def test_row_frame_needs_a_full_window(spark):
    df = fuel(spark, range(5), [1, None, 3, 4, 5])
    assert column(df.withColumn("x", s.rolling_rows("fuel_level_l", 3)), "x") == [None, None, None, None, 4]


def test_interpolation_is_limited_from_both_sides(spark):
    n = None
    df = fuel(spark, range(13), [n, n, n, 1, n, n, n, n, n, 7, n, n, n])
    assert column(df.withColumn("x", s.interpolated("fuel_level_l", 2)), "x") == [n, 1, 1, 1, 2, 3, n, 5, 6, 7, 7, 7, n]


def test_a_long_series_takes_time_in_proportion(spark):
    n = 100_000
    rows = spark.range(n).selectExpr("id AS row_id", "'G' AS generator_id", "'S' AS site_name", "timestamp_seconds(1700000000 + id * 60) AS timestamp", "CASE WHEN id % 5 = 0 THEN double(id) END AS fuel_level_l")
    began = time.perf_counter()
    out = rows.withColumns({"line": s.interpolated("fuel_level_l", 10), "site": s.filled_both_ways("site_name"), "mean": s.rolling("fuel_level_l", 86_400, 3), "std": s.rolling("fuel_level_l", 86_400, 3, "std")})
    got = out.agg(F.count("line"), F.max(F.abs(F.col("line") - F.col("row_id"))), F.count("mean"), F.count("std")).first()
    # the last four rows have no value after them; two values are too few for a mean
    assert got[0] == n and got[1] == 4 and got[2] == got[3] == n - 10
    assert time.perf_counter() - began < 60


def test_deviation_keeps_its_digits_late_in_a_series(spark):
    values = [1e6 + k % 3 for k in range(3000)]
    df = fuel(spark, range(3000), values).withColumn("x", s.rolling("fuel_level_l", 7, 3, "std"))
    assert column(df, "x")[-1] == pytest.approx(np.std(values[-7:], ddof=1), rel=1e-12)


def test_running_sum_is_null_where_the_value_is(spark):
    assert column(fuel(spark, range(3), [1, None, 2]).withColumn("x", s.cumulative("fuel_level_l")), "x") == [1, None, 3]


def test_asof_matches_pandas(spark):
    rng = random.Random(3)
    rows = [(f"G{rng.randrange(3)}", rng.randrange(4000), rng.choice([None, rng.randrange(100)]), None, None, None) for _ in range(300)]
    df = telemetry(spark, rows)
    p = df.toPandas().sort_values(["timestamp", "row_id"])
    valid = p[p.fuel_level_l.notna()][["generator_id", "timestamp", "fuel_level_l"]]
    for forward in (True, False):
        ours = s.asof(df, df.where("fuel_level_l IS NOT NULL"), F.col("timestamp") + F.expr("interval 5 minutes"), forward, 600, "fuel_level_l", "v", "t").toPandas().set_index("row_id").v
        probe = p.assign(at=p.timestamp + pd.Timedelta("5min")).sort_values("at")
        theirs = pd.merge_asof(probe.drop(columns="fuel_level_l"), valid.rename(columns={"timestamp": "found"}), left_on="at", right_on="found", by="generator_id", direction="forward" if forward else "backward", tolerance=pd.Timedelta("10min")).set_index("row_id").fuel_level_l
        np.testing.assert_array_equal(ours.sort_index().astype(float).to_numpy(), theirs.sort_index().to_numpy())


def test_gap_histogram_leaves_out_zero_gaps_and_keeps_empty_classes(spark):
    df = fuel(spark, [0, 0, 30, 61, 962], [1] * 5)
    got = {r.gap_class: r.n for r in profile.gap_histogram(df).collect()}
    assert got == {"<30 s": 1, "30-90 s": 1, "90-150 s": 0, "150-300 s": 0, "300-900 s": 0, ">900 s": 1}


def test_cadence_takes_the_lowest_mode_and_defaults_on_few_samples(spark):
    times = np.cumsum([0] + [15] * 40 + [60] * 40).tolist()
    df = telemetry(spark, [("A", t, 1, 1, 1, "running") for t in times] + [("B", t, 1, 1, 1, "running") for t in (0, 70, 140)])
    got = {r.generator_id: (r.interval, r.samples) for r in cadence.cadence(df).collect()}
    assert got == {"A": (15, 80), "B": (60, 2)}


def test_duplicates_by_kind(spark):
    rows = [("G", 0, 1, 5, 50, "running"), ("G", 0, 1, 5, 50, "running"), ("G", 1, 1, None, 50, None), ("G", 1, None, 7, 50, "stopped"), ("G", 2, 1, 5, 50, None), ("G", 2, 2, 5, 50, None), ("G", 3, 1, 1, 1, None)]
    got = timeline.resolved_duplicates(telemetry(spark, rows)).orderBy("timestamp").collect()
    assert [(r.duplicate_type, r.fuel_level_l, r.current, r.status) for r in got] == [("Exact", 1, 5, "running"), ("Complementary", 1, 7, "stopped"), ("Conflicting", 1, 5, None), ("Single", 1, 1, None)]


def test_state_votes(spark):
    df = telemetry(spark, [("G", 0, 10, 160, 50, None), ("H", 0, 10, 0, 12, None), ("I", 0, None, None, None, None)])
    df = df.withColumn("fuel_delta", F.when(F.col("generator_id") == "G", -0.1).when(F.col("generator_id") == "H", 0.0))
    got = [(r.running_probability, r.estimated_status, r.estimated_confidence, r.confidence_level, r.estimation_reason) for r in rules.estimated_state(df).orderBy("row_id").collect()]
    assert got[0][:4] == (1.0, "Running (High Load)", 100.0, "Very High")
    assert got[1][:3] == (0.0, "Unknown", 100.0)
    assert got[2] == (0.5, "Unknown", 0.0, "Very Low", "No telemetry evidence available.")


def test_validation_scores_and_reasons(spark):
    df = telemetry(spark, [("G", 0, 0, 10, 50, None), ("G", 200, -1, 10, 50, None)]).withColumn("estimated_status", F.lit("Idle"))
    r = rules.validated(df).orderBy("row_id").collect()[1]
    assert (r.telemetry_quality_score, r.validation_reason) == (65.0, "Invalid fuel level; Telemetry delay detected")


def test_health_of_an_imputed_reading_out_of_range(spark):
    df = telemetry(spark, [("G", 0, 2500, 10, 50, None)]).withColumns({f"{c}_imputed": F.lit(c == "fuel") for c in ("fuel", "current", "battery", "status")})
    df = df.withColumns({c: F.lit(False) for c in ("fuel_outlier", "current_outlier", "battery_current_mismatch", "status_conflict")})
    r = rules.sensor_health(df).first()
    assert (r.fuel_sensor_health, r.overall_sensor_health, r.maintenance_priority) == (30, 82.5, "Low")


def test_imputation_confidence(spark):
    df = spark.createDataFrame([(True, False, False, True, 80.0)], "fuel_imputed boolean, current_imputed boolean, battery_imputed boolean, status_imputed boolean, telemetry_quality_score double")
    assert df.select(impute.confidence()).first()[0] == 52.0


def test_split_sizes_and_order(spark):
    df = forecast.split(fuel(spark, range(20), [1] * 20))
    assert {r.split: r["count"] for r in df.groupBy("split").count().collect()} == {"train": 14, "validation": 3, "test": 3}
    assert forecast.split_order(df).first().ordered


def test_multisets_differ_by_count(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "x string") for xs in (["a", "a", None], ["a", "b"]))
    assert tuple(forecast.multiset_difference(a, b).first()) == (2, 1)


def test_leaks_are_no_features():
    assert forecast.leaking(["target_minutes", "future_load", "a_future_b", "fuel"]) == ["target_minutes", "future_load", "a_future_b"]


def test_csv_in_and_out(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write("timestamp,site_name,generator_id,site_quality,status,fuel_level_l,current,battery_voltage\n2026-01-01 00:00:00,S,G,ok,running,1.5,NaN,inf\nnonsense,S,G,ok,,x,2,3\n")
    rows = tables.read_csv(spark, path).collect()
    assert [(r.timestamp is None, r.fuel_level_l, r.current, r.battery_voltage) for r in rows] == [(False, 1.5, None, None), (True, None, 2.0, 3.0)]
    with pytest.raises(ValueError):
        tables.require_timestamps(tables.read_csv(spark, path))
    with pytest.raises(ValueError):
        tables.require_columns(spark.range(1), ["generator_id"])
    tables.write_lines(spark, ["a", "b"], str(tmp_path / "lines"))
    assert tables.read_lines(spark, str(tmp_path / "lines")) == ["a", "b"]
    tables.write_csv(spark.sql("SELECT 1 AS a, array('x') AS b"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).first().b == '["x"]'


def test_target_changes_of_packets_at_one_time_meet_one_to_one(spark):
    t = spark.createDataFrame([("G", 0, 1, 5.0), ("G", 0, 2, None), ("G", 0, 3, 7.0), (None, 0, 4, 1.0), ("G", None, 5, 2.0), ("G", 9, 6, 3.0), ("G", 9, 6, 3.0)], "generator_id string, timestamp int, row_id long, target_fuel double")
    assert tuple(forecast.target_changes(t, t).first()) == (0, 0, 7, 0, 0, 0)
    other = spark.createDataFrame([("G", 0, 1, None), ("G", 0, 2, 5.0), (None, 0, 4, 4.0), ("G", None, 5, 2.0), ("G", 9, 6, 3.0), ("G", 8, 7, 3.0)], t.schema)
    assert tuple(forecast.target_changes(t, other).first()) == (2, 1, 5, 1, 1, 1)
