from helpers import column, telemetry
from pyspark.sql import functions as F

from genpulse.operators import compose, impute, integrity, rules, timeline


def some_rows(spark):
    return telemetry(spark, [("G", 60 * k, 100.0 - k, 40.0 if k % 3 else None, 50.0, "running" if k % 4 else None) for k in range(40)] + [("H", 90 * k, None, 0.0, 12.0, "stopped") for k in range(20)])


def test_stages_work_on_any_table_and_alike_in_segments(spark):
    df = some_rows(spark).withColumn("mine", F.col("row_id") * 2)
    for stage in (compose.stated, compose.checked, compose.healthy, compose.anomalous, compose.fused):
        whole, parts = stage(df), stage(df, segment=600.0)
        assert "mine" in whole.columns and sorted(whole.columns) == sorted(parts.columns)
        names = sorted(whole.columns)
        assert sorted(map(str, whole.select(*names).collect())) == sorted(map(str, parts.select(*names).collect()))


def test_a_chain_of_stages(spark):
    out = compose.run(some_rows(spark), [compose.completed, rules.sensor_health, rules.with_anomaly_columns])
    assert out.where("overall_sensor_health IS NULL").count() == 0 and set(rules.ANOMALY_COLUMNS) <= set(out.columns)
    assert out.select("battery_low").distinct().collect()[0][0] is False


def test_features_hold_the_required_frames(spark):
    made = {r.feature: r.present for r in integrity.required_features(compose.features(some_rows(spark))).collect()}
    assert all(made[f"{s}_{how}_{m}min"] for s in ("fuel", "current", "battery") for how in ("mean", "std") for m in (5, 15, 30, 60))
    assert made["running_probability_mean_60min"] and made["telemetry_quality_mean_5min"]


def test_model_rows_have_targets_and_splits(spark):
    rows = compose.model_rows(some_rows(spark), hours=0.02, tolerance_minutes=5, segment=600.0)
    assert {r.split for r in rows.select("split").distinct().collect()} == {"train", "validation", "test"}
    assert rows.where("target_fuel IS NULL").count() == 0 and rows.where("generator_id = 'H'").count() == 0


def test_timelines_of_generators_at_their_own_cadence_and_of_sites(spark):
    df = telemetry(spark, [("A", 0, 1, 1, 1, "x"), ("A", 120, 1, 1, 1, "x"), ("B", 0, 1, 1, 1, "x"), ("B", 90, 1, 1, 1, "x")])
    steps = spark.createDataFrame([("A", 60), ("B", 30)], "generator_id string, interval int")
    for segment in (None, 60.0):
        grid = timeline.regular(df, steps, segment)
        assert {(r.generator_id, r.n) for r in grid.groupBy("generator_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {("A", 3), ("B", 4)}
        assert grid.where("site_name IS NULL").count() == 0
    moved = df.withColumn("site_name", F.when(F.col("row_id") == 3, "T").otherwise("S"))
    sites = timeline.regular(moved, 30, by=("site_name", "generator_id"))
    assert {(r.site_name, r.generator_id, r["count"]) for r in sites.groupBy("site_name", "generator_id").count().collect()} == {("S", "A", 5), ("S", "B", 1), ("T", "B", 1)}


def test_votes_and_the_older_status(spark):
    df = some_rows(spark).withColumn("fuel_delta", F.lit(-1.0))
    votes = rules.sensor_votes(df).orderBy("row_id").first()
    assert (votes.current_vote, votes.battery_vote, votes.fuel_vote, votes.battery_running_weight) == ("Unknown", "Running", "Running", 0.3)
    done = impute.completed_status(df.withColumn("estimated_status", F.lit("Idle")))
    assert column(done, "status")[:2] == ["Idle", "running"] and column(done, "status_imputed")[:2] == [True, False]
