import pytest
from helpers import column, telemetry
from pyspark.sql import functions as F

from genpulse.operators import cadence, forecast, impute, rules
from genpulse.operators import integrity as ok
from genpulse.sources import tables


def rows(spark, fuel, current=None, battery=None, status=None, step=60):
    n = len(fuel)
    current, battery, status = current or [None] * n, battery or [None] * n, status or [None] * n
    return telemetry(spark, [("G", k * step, *x) for k, x in enumerate(zip(fuel, current, battery, status))])


def test_rates_keep_or_clamp_refills(spark):
    df = telemetry(spark, [("G", t, f, None, None, None) for t, f in [(0, 10), (60, 4), (60, 5), (120, 65)]])
    assert column(ok.signed_rates(df), "fuel_rate_lps") == [None, pytest.approx(-0.1), None, 1.0]
    assert column(ok.clamped_rates(df), "fuel_rate_lps") == [None, pytest.approx(0.1), None, None]


def test_target_flags_know_the_sentinel(spark):
    df = rows(spark, [-0.24, -0.2400001, -0.25, 0, None]).withColumnRenamed("fuel_level_l", "target_fuel")
    out = ok.target_flags(df)
    assert column(out, "target_sentinel") == [1, 1, 0, 0, 0]
    assert column(out, "target_negative") == [1, 1, 1, 0, 0] and column(out, "target_valid") == [0, 0, 0, 1, 0]
    assert set(ok.flag_mismatches(out).first()) == {0}


def test_output_is_held_to_its_input(spark):
    df = rows(spark, [1, 2, 3], [1, 2, 3]).withColumn("target_fuel", F.col("fuel_level_l"))
    assert ok.validated_output(df, df, ["current"]).count() == 3
    for after, features in [(df.limit(2), ["current"]), (df.withColumn("target_fuel", F.lit(1.0)), ["current"]), (df, ["target_fuel"]), (df, ["absent"]), (df.withColumn("current", F.lit(float("inf"))), ["current"])]:
        with pytest.raises(ValueError):
            ok.validated_output(df, after, features)


def test_global_split_cuts_exactly_within_ties(spark):
    df = telemetry(spark, [("AB"[k % 2], 0 if k < 8 else k * 4000, 1, None, None, None) for k in range(20)])
    assert column(forecast.global_split(df), "split") == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3
    tied = telemetry(spark, [("G", 0, 1, None, None, None)] * 10)
    assert column(forecast.global_split(tied), "split") == ["train"] * 7 + ["validation"] + ["test"] * 2
    assert forecast.global_split(df.where("false")).count() == 0


def test_stopped_generators_are_filled_with_zero(spark):
    df = rows(spark, [None] * 4, [8, None, None, 4], status=["running", "stopped", "running", "running"])
    assert column(ok.stopped_filled(df, "current"), "current") == [8, 0, 2, 4]
    lost = df.withColumns({f"{c}_imputed": F.lit(True) for c in ("fuel", "current", "battery", "status")})
    assert column(lost.withColumn("x", impute.first_confidence(F.lit(100.0))), "x") == [pytest.approx(68.5)] * 4


def test_advice_follows_health(spark):
    df = spark.createDataFrame([(0, "Critical", True), (1, "Excellent", None)], "row_id int, sensor_health string, fuel_invalid boolean")
    df = df.withColumns({c: F.lit(False) for c in ("fuel_outlier", "current_invalid", "current_outlier", "battery_invalid", "battery_current_mismatch", "state_sensor_mismatch", "sensor_drift")})
    out = rules.issue_advice(df)
    assert column(out, "sensor_issue_detected") == [True, False]
    assert column(out, "maintenance_recommendation") == ["Immediate maintenance required", "No action required"]


def test_cadence_classes_group_around_one_interval(spark):
    def found(intervals):
        table = spark.createDataFrame([(chr(65 + k), i) for k, i in enumerate(intervals)], "generator_id string, interval int")
        return [r.class_interval for r in cadence.cadence_classes(table).orderBy("generator_id").collect()]

    assert found([60, 63, 64, 90]) == [63, 63, 63, 90]
    assert found([71, 74, 76, 75, 71]) == [74] * 5
    # the classes of 70 and 78 would share 74
    assert found([70, 74, 78]) == [70, 74, 78]
    assert found([15, None, 16]) == [16, None, 16]


def test_tuning_takes_the_better_model(spark):
    df = rows(spark, list(range(60)), [k % 7 for k in range(60)]).withColumn("target_fuel", F.col("fuel_level_l") * 2)
    config, model = forecast.tuned(df, df, ["fuel_level_l", "current"], [{"trees": 1, "depth": 1}, {"trees": 5, "depth": 4}])
    assert config == {"trees": 5, "depth": 4}
    top = forecast.importances(model, ["fuel_level_l", "current"], spark).first()
    assert top.feature == "fuel_level_l" and top.importance > 0.5


def test_json_and_projected_reads(spark, tmp_path):
    df = rows(spark, [1, 2])
    tables.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
