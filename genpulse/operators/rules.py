"""Rule engines on single rows: validation, state, health, anomalies, imputation confidence.

Every rule is a Column expression; null readings make a flag false, never null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import segments
from ..functions.selection import percentiles
from ..functions.series import KEY, bands, change, clipped, flag, micros, rolling_rows, seconds_since_last, series
from .timeline import duplicate_marks

# Messages of the rules, in the order in which they are listed.
VALIDATION = {
    "fuel_invalid": (20, "Invalid fuel level"),
    "fuel_outlier": (15, "Fuel spike detected"),
    "current_invalid": (20, "Invalid current"),
    "current_outlier": (15, "Current spike detected"),
    "battery_invalid": (15, "Invalid battery voltage"),
    "battery_current_mismatch": (5, "Current load detected but battery charging signal missing"),
    "state_sensor_mismatch": (10, "Estimated state conflicts with sensor behavior"),
    "timestamp_duplicate": (10, "Duplicate telemetry"),
    "timestamp_gap": (15, "Telemetry delay detected"),
}
MAINTENANCE = [
    (90, "None", "Sensors operating normally", "No action required"),
    (75, "Low", "Minor sensor degradation", "Monitor during next inspection"),
    (50, "Medium", "Sensor quality degrading", "Inspect affected sensor"),
    (25, "High", "Multiple sensor issues detected", "Maintenance recommended"),
    (None, "Critical", "Sensor reliability very poor", "Immediate maintenance required"),
]
ANOMALIES = {
    "fuel_theft": ("Fuel theft suspected", "Inspect fuel tank"),
    "refueling": ("Refueling event", "Verify refill"),
    "fuel_stuck": ("Fuel sensor stuck", "Inspect fuel sensor"),
    "current_spike": ("Current spike", "Inspect electrical load"),
    "current_zero_running": ("Zero current while running", "Inspect current sensor"),
    "battery_low": ("Low battery", "Check battery"),
    "battery_spike": ("Battery voltage spike", "Inspect charging system"),
    "battery_unstable": ("Battery unstable", "Inspect battery"),
    "state_anomaly": ("Generator state conflict", "Verify generator state"),
    "telemetry_anomaly": ("Telemetry issue", "Inspect communication"),
}
HEALTH_ISSUES = {
    "fuel_invalid": (30, "Invalid fuel value"),
    "fuel_outlier": (15, "Fuel outlier"),
    "current_invalid": (25, "Invalid current"),
    "current_outlier": (10, "Current outlier"),
    "battery_invalid": (20, "Invalid battery voltage"),
    "battery_current_mismatch": (15, "Battery/current mismatch"),
    "state_sensor_mismatch": (15, "Status conflicts with sensors"),
    "fuel_imputed": (5, "Fuel imputed"),
    "current_imputed": (5, "Current imputed"),
    "battery_imputed": (5, "Battery imputed"),
    "status_imputed": (5, "Status imputed"),
}
LEVELS = [(90, "Very High"), (75, "High"), (50, "Medium"), (25, "Low")]


#: What to do at each level of sensor health.
ADVICE = {
    "Excellent": "No action required",
    "Good": "Continue monitoring",
    "Fair": "Inspect during next maintenance",
    "Poor": "Schedule sensor inspection",
    "Critical": "Immediate maintenance required",
}


DELTAS = {"fuel_delta": "fuel_level_l", "current_delta": "current", "voltage_delta": "battery_voltage"}


def with_deltas(df: DataFrame, segment: float | None = None) -> DataFrame:
    """df with fuel_delta, current_delta, voltage_delta, time_delta_sec and consumption rates.
    segment: seconds of a series that one task takes; None: a generator in one task."""
    if segment is None:
        out = df.withColumns({name: change(c) for name, c in DELTAS.items()} | {"time_delta_sec": seconds_since_last()})
    else:
        before = {c: f"_before_{c}" for c in (*DELTAS.values(), "timestamp")}
        out = segments.scan(df, {b: segments.lag(c) for c, b in before.items()}, segment)
        out = out.withColumns({name: F.col(c) - F.col(before[c]) for name, c in DELTAS.items()} | {"time_delta_sec": (micros() - micros(before["timestamp"])) / 1e6}).drop(*before.values())
    per_second = F.try_divide(-F.col("fuel_delta"), "time_delta_sec")
    return out.withColumns({"fuel_rate_lps": per_second, "fuel_rate_lph": per_second * 3600})


def _text(value: Column, unit: str, what: str, says: str) -> Column:
    return F.concat(F.lit(f"{what} "), F.format_string("%.2f", value), F.lit(f"{unit} {says}"))


def _votes() -> dict[str, tuple[float, Column, Column]]:
    """Weight, vote and strength of each sensor. Needs fuel_delta."""
    c, b, d = F.col("current"), F.col("battery_voltage"), F.col("fuel_delta")
    return {
        "current": (0.5, F.when(c.isNull(), "Unknown").when(c >= 30, "Running").otherwise("Stopped"), F.when(c >= 150, 1.0).when(c >= 80, 0.9).when(c >= 30, 0.7).otherwise(0.6)),
        "battery": (0.3, F.when(flag(b >= 48), "Running").otherwise("Unknown"), F.lit(1.0)),
        "fuel": (0.2, F.when(d.isNull(), "Unknown").when(d < -0.02, "Running").otherwise("Stopped"), F.when(d < -0.02, 1.0).otherwise(0.4)),
    }


def sensor_votes(df: DataFrame) -> DataFrame:
    """df with the bundle of votes that estimated_state() counts: for each sensor its vote, and the
    weight of a vote for running, weight times strength, 0 for any other."""
    votes = _votes()
    return df.withColumns({f"{n}_vote": v for n, (_, v, _) in votes.items()} | {f"{n}_running_weight": F.when(v == "Running", s * w).otherwise(0.0) for n, (w, v, s) in votes.items()})


def estimated_state(df: DataFrame) -> DataFrame:
    """State by votes of current, battery and fuel change: running_probability, estimated_status,
    estimated_confidence, confidence_level, status_conflict, estimation_reason. Needs fuel_delta."""
    c, b, d = F.col("current"), F.col("battery_voltage"), F.col("fuel_delta")
    votes = _votes()
    total = lambda cond, value=lambda w, s: w: sum(F.when(cond(v), value(w, s)).otherwise(0.0) for w, v, s in votes.values())
    number = lambda state: sum(F.when(v == state, 1).otherwise(0) for _, v, _ in votes.values())
    known = total(lambda v: v != "Unknown")
    score = total(lambda v: v == "Running", lambda w, s: s * w)
    out = df.withColumns({"_known": known, "_running": number("Running"), "_stopped": number("Stopped"), "_score": score})
    p = F.bround(F.when(F.col("_known") == 0, 0.5).otherwise(F.try_divide("_score", "_known")), 3)
    out = out.withColumn("running_probability", p)
    p, load = F.col("running_probability"), F.coalesce(c, F.lit(0.0))
    state = (
        F.when((p >= 0.75) & (load >= 150), "Running (High Load)")
        .when((p >= 0.75) & (load >= 80), "Running (Medium Load)")
        .when(p >= 0.75, "Running (Low Load)")
        .when((p >= 0.55) & (load >= 30), "Running (Low Load)")
        .when(p >= 0.55, "Idle")
        .otherwise("Unknown")
    )
    voted = F.col("_running") + F.col("_stopped")
    agreement = F.try_divide(F.greatest("_running", "_stopped"), voted)
    confidence = F.when(voted == 0, 0.0).otherwise(F.bround(F.least(F.lit(100.0), agreement * 60 + F.abs(p - 0.5) * 2 * 40), 2))
    out = out.withColumns({"estimated_status": state, "estimated_confidence": confidence})
    reasons = F.concat_ws(
        ". ",
        F.when(c >= 150, _text(c, "A", "Current", "indicates high load")).when(c >= 80, _text(c, "A", "Current", "indicates medium load")).when(c >= 30, _text(c, "A", "Current", "indicates low load")).when(c.isNotNull(), _text(c, "A", "Current", "below running threshold")),
        F.when(b >= 48, _text(b, "V", "Battery", "indicates charging")),
        F.when(d < -0.02, "Fuel is decreasing").when(d.isNotNull(), "Fuel is steady"),
    )
    running = F.contains("estimated_status", F.lit("Running"))
    return out.withColumns(
        {
            "confidence_level": bands(F.col("estimated_confidence"), LEVELS, "Very Low"),
            "status_conflict": F.when(F.col("status").isNull(), False).otherwise((F.lower(F.trim("status")) == "running") != running),
            "estimation_reason": F.when(reasons == "", "No telemetry evidence available.").otherwise(F.concat(reasons, F.lit("."))),
        }
    ).drop("_known", "_running", "_stopped", "_score")


def learned_thresholds(df: DataFrame, least: int = 10) -> DataFrame:
    """low, medium and high current of each generator: quartiles of what flows while it runs."""
    flowing = F.when(F.col("current") > 1, F.col("current"))
    counts = df.groupBy(KEY).agg(F.count(flowing).alias("n"))
    quartiles = percentiles(df, flowing, [0.25, 0.5, 0.75], [KEY]).withColumnRenamed(KEY, "_of")
    per = counts.join(quartiles, F.col(KEY).eqNullSafe(F.col("_of")), "left")
    pick = lambda k, default: F.when(F.col("n") >= least, F.col("q")[k]).otherwise(F.lit(default))
    return per.select(KEY, pick(0, 20.0).alias("low"), pick(1, 60.0).alias("medium"), pick(2, 120.0).alias("high"))


def fused_state(df: DataFrame) -> DataFrame:
    """State by weighted evidence against each generator's learned thresholds: state_probability,
    state, state_confidence. Needs fuel_delta and fuel_rate_lps. The thresholds are one row a generator."""
    t = learned_thresholds(df)
    out = df.join(t, KEY, "left").withColumns({k: F.coalesce(k, F.lit(v)) for k, v in (("low", 20.0), ("medium", 60.0), ("high", 120.0))})
    c, status = F.col("current"), F.lower(F.trim("status"))
    trend = lambda x: F.when(x > 0.05, 1.0).when(x < -0.05, 0.2).otherwise(0.0)
    evidence = [
        (45.0, c.isNotNull(), F.when(c <= 1, 0.0).when(c < F.col("low"), 0.55).when(c < F.col("medium"), 0.75).otherwise(1.0)),
        (25.0, F.col("fuel_rate_lps").isNotNull(), trend(F.col("fuel_rate_lps"))),
        (15.0, F.col("fuel_delta").isNotNull(), trend(-F.col("fuel_delta"))),
        (10.0, F.col("battery_voltage").isNotNull(), F.when(F.col("battery_voltage") >= 24, 1.0).when(F.col("battery_voltage") > 0, 0.5).otherwise(0.0)),
        (5.0, flag(status.isin("running", "stopped")), F.when(status == "running", 1.0).otherwise(0.0)),
    ]
    add = lambda f: sum(F.when(there, f(w, s)).otherwise(0.0) for w, there, s in evidence)
    out = out.withColumns({"_w": add(lambda w, s: F.lit(w)), "_n": add(lambda w, s: F.lit(1.0)), "_s": add(lambda w, s: s), "_ss": add(lambda w, s: s * s), "_ws": add(lambda w, s: s * w)})
    p = F.when(F.col("_w") > 0, F.try_divide("_ws", "_w")).otherwise(0.0)
    out = out.withColumn("state_probability", p)
    p = F.col("state_probability")
    state = (
        F.when(p < 0.25, "Stopped").when(p < 0.5, "Idle").when(c.isNull(), "Running").when(c <= 1, "Idle")
        .when(c < F.col("low"), "Running (Low Load)").when(c < F.col("medium"), "Running (Medium Load)").otherwise("Running (High Load)")
    )
    spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide("_ss", "_n") - F.pow(F.try_divide("_s", "_n"), F.lit(2))))
    confidence = F.when(F.col("_n") == 0, 0.0).otherwise(100 * (clipped(1 - spread, 0.0, 1.0) * 0.7 + F.col("_n") / 5 * 0.3))
    return out.withColumns({"state": state, "state_confidence": confidence}).drop("_w", "_n", "_s", "_ss", "_ws", "low", "medium", "high")


def validated(df: DataFrame) -> DataFrame:
    """df with a flag for each rule of VALIDATION, telemetry_quality_score and validation_reason.
    Needs estimated_status."""
    fuel, current, battery = F.col("fuel_level_l"), F.col("current"), F.col("battery_voltage")
    running = F.contains("estimated_status", F.lit("Running"))
    df = duplicate_marks(df).withColumns({"fuel_change": change("fuel_level_l"), "current_change": change("current"), "timestamp_gap_seconds": seconds_since_last()})
    out = df.withColumns(
        {
            "fuel_invalid": flag((fuel < 0) | (fuel > 5000)),
            "fuel_outlier": flag(F.abs("fuel_change") > 50),
            "current_invalid": flag((current < 0) | (current > 500)),
            "current_outlier": flag(F.abs("current_change") > 150),
            "battery_invalid": flag((battery < 0) | (battery > 70)),
            "battery_current_mismatch": flag((current > 20) & (battery < 10)),
            "state_sensor_mismatch": flag((running & (current <= 5)) | (F.col("estimated_status").isin("Stopped", "Idle") & (current > 30))),
            "timestamp_gap": flag(F.col("timestamp_gap_seconds") > 180),
        }
    )
    lost = sum(F.col(name).cast("int") * points for name, (points, _) in VALIDATION.items())
    says = F.concat_ws("; ", *[F.when(F.col(name), text) for name, (_, text) in VALIDATION.items()])
    return out.withColumns({"telemetry_quality_score": clipped(100.0 - lost), "validation_reason": F.when(says == "", "Telemetry healthy").otherwise(says)})


def sensor_health(df: DataFrame, fuel_capacity: float = 2000.0, current_limit: float = 400.0, battery_limit: float = 60.0) -> DataFrame:
    """Health of each sensor, their mean, and what to do. Needs flags of validated() and imputed()."""
    outside = lambda c, high: flag((F.col(c) < 0) | (F.col(c) > high)).cast("int")
    on = lambda c: flag(F.col(c)).cast("int")
    scores = {
        "fuel_sensor_health": clipped(100.0 - 60 * outside("fuel_level_l", fuel_capacity) - 20 * on("fuel_outlier") - 10 * on("fuel_imputed")),
        "current_sensor_health": clipped(100.0 - 60 * outside("current", current_limit) - 20 * on("current_outlier") - 10 * on("current_imputed")),
        "battery_sensor_health": clipped(100.0 - 60 * outside("battery_voltage", battery_limit) - 10 * on("battery_imputed") - 15 * on("battery_current_mismatch")),
        "status_sensor_health": clipped(100.0 - 30 * on("status_conflict") - 15 * on("status_imputed")),
    }
    out = df.withColumns(scores).withColumn("overall_sensor_health", F.bround(sum(F.col(c) for c in scores) / 4, 2))
    health = F.col("overall_sensor_health")
    level = lambda k: bands(health, [(row[0], row[k]) for row in MAINTENANCE[:-1]], MAINTENANCE[-1][k])
    return out.withColumns({"maintenance_priority": level(1), "maintenance_reason": level(2), "recommended_action": level(3)})


def sensor_score(df: DataFrame, drift: float = 8.0) -> DataFrame:
    """One score a row from all its issues, with drift from an hourly mean, category and reason."""
    frame = series().rowsBetween(-59, 0)
    mean = F.when(F.count("fuel_level_l").over(frame) >= 20, F.avg("fuel_level_l").over(frame))
    out = df.withColumn("sensor_drift", flag(F.round(F.abs(F.col("fuel_level_l") - mean), 9) > drift))
    confidence = F.coalesce("imputation_confidence", F.lit(100.0))
    lost = sum(flag(F.col(name)).cast("int") * points for name, (points, _) in HEALTH_ISSUES.items())
    lost = lost + F.when(confidence < 30, 20).when(confidence < 60, 10).when(confidence < 80, 5).otherwise(0) + 10 * F.col("sensor_drift").cast("int")
    says = F.concat_ws(
        "; ",
        *[F.when(flag(F.col(name)), text) for name, (_, text) in HEALTH_ISSUES.items()],
        F.when(confidence < 30, "Very low imputation confidence").when(confidence < 60, "Low imputation confidence").when(confidence < 80, "Moderate imputation confidence"),
        F.when(F.col("sensor_drift"), "Sensor drift detected"),
    )
    out = out.withColumn("sensor_health_score", F.greatest(F.lit(0.0), 100.0 - lost))
    category = bands(F.col("sensor_health_score"), [(95, "Excellent"), (85, "Good"), (70, "Fair"), (50, "Poor")], "Critical")
    return out.withColumns({"sensor_health": category, "sensor_health_reason": F.when(says == "", "Healthy telemetry").otherwise(says)})


def anomalies(df: DataFrame) -> DataFrame:
    """Anomaly flags, scores, severity, reason and action of each row. Needs fuel_delta,
    current_delta, voltage_delta, estimated_status, telemetry_quality_score and timestamp flags."""
    state = F.lower(F.coalesce("estimated_status", F.lit("")))
    running, stopped = F.contains(state, F.lit("running")), F.contains(state, F.lit("stopped"))
    c, b, d = F.col("current"), F.col("battery_voltage"), F.col("fuel_delta")
    frame = series().rowsBetween(-9, 0)
    out = df.withColumns(
        {
            "fuel_theft": flag(d < -5),
            "refueling": flag(d > 5),
            "fuel_spike": flag(F.abs(d) > 10),
            "fuel_stuck": flag((F.max("fuel_level_l").over(frame) == F.min("fuel_level_l").over(frame)) & (F.count("fuel_level_l").over(frame) == 10)),
            "current_spike": flag(F.abs("current_delta") > 50),
            "current_zero_running": flag(running & (c <= 1)),
            "battery_low": flag(b < 44),
            "battery_spike": flag(F.abs("voltage_delta") > 5),
            "battery_unstable": flag(F.round(rolling_rows("battery_voltage", 5, "std"), 9) > 2),
            "state_anomaly_reason": F.concat_ws(
                ", ",
                F.when(running & (c <= 1), "Running but zero current"),
                F.when(stopped & (c > 10), "Stopped but current detected"),
                F.when(stopped & (d < -0.2), "Fuel decreasing while stopped"),
                F.when(running & (b.isNull() | (b <= 0)), "Battery unavailable"),
            ),
        }
    )
    on = lambda name: F.col(name).cast("int")
    trouble = on("timestamp_duplicate") + on("timestamp_gap") + flag(F.col("telemetry_quality_score") < 80).cast("int")
    out = out.withColumns(
        {
            "state_anomaly": F.col("state_anomaly_reason") != "",
            "telemetry_anomaly": trouble > 0,
            "telemetry_severity": F.when(trouble == 0, "").when(trouble == 1, "Low").when(trouble == 2, "Medium").otherwise("High"),
            "fuel_anomaly_score": clipped(40.0 * on("fuel_theft") + 15 * on("refueling") + 25 * on("fuel_spike") + 20 * on("fuel_stuck")),
            "current_anomaly_score": clipped(50.0 * on("current_spike") + 50 * on("current_zero_running")),
            "battery_anomaly_score": clipped(40.0 * on("battery_low") + 30 * on("battery_spike") + 30 * on("battery_unstable")),
        }
    )
    overall = 0.35 * F.col("fuel_anomaly_score") + 0.2 * F.col("current_anomaly_score") + 0.2 * F.col("battery_anomaly_score") + 15 * on("state_anomaly") + 10 * on("telemetry_anomaly")
    out = out.withColumn("overall_anomaly_score", clipped(F.bround(overall, 2)))
    score = F.col("overall_anomaly_score")
    reason = F.concat_ws("; ", *[F.when(F.col(k), text) for k, (text, _) in ANOMALIES.items()])
    actions = F.array_compact(F.array(*[F.when(F.col(k), action) for k, (_, action) in ANOMALIES.items()]))
    return out.withColumns(
        {
            "anomaly_flag": score > 20,
            "anomaly_severity": F.when(score == 0, "None").when(score < 25, "Low").when(score < 50, "Medium").when(score < 75, "High").otherwise("Critical"),
            "anomaly_reason": F.when(reason == "", "No anomaly detected").otherwise(reason),
            "anomaly_action": F.when(F.size(actions) == 0, "No action required").otherwise(F.array_join(F.sort_array(F.array_distinct(actions)), "; ")),
        }
    )


def fused_conflict(df: DataFrame) -> DataFrame:
    """df, over fused_state(), with state_conflict: the reported status and the state disagree about
    running; and state_confidence_level."""
    reported, runs = F.lower(F.trim("status")), F.col("state").startswith("Running")
    level = bands(F.col("state_confidence"), [(95, "Very High"), (85, "High"), (70, "Medium"), (50, "Low")], "Very Low")
    return df.withColumns({"state_conflict": flag(((reported == "running") & ~runs) | ((reported == "stopped") & runs)), "state_confidence_level": level})


def state_report(df: DataFrame, state: str = "estimated_status", level: str = "confidence_level", confidence: str = "estimated_confidence") -> DataFrame:
    """Rows and mean confidence of each state and confidence level."""
    return df.groupBy(F.col(state).alias("state"), F.col(level).alias("level")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(confidence), 4).alias("mean_confidence"))


def issue_advice(df: DataFrame) -> DataFrame:
    """df, over sensor_score(), with sensor_issue_detected and maintenance_recommendation."""
    issues = ["fuel_invalid", "fuel_outlier", "current_invalid", "current_outlier", "battery_invalid", "battery_current_mismatch", "state_sensor_mismatch", "sensor_drift"]
    advice = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    found = flag(F.lit(False))
    for c in issues:
        found = found | flag(F.col(c))
    return df.withColumns({"sensor_issue_detected": found, "maintenance_recommendation": advice[F.col("sensor_health")]})


#: The columns that anomaly detection fills.
ANOMALY_COLUMNS = [
    "fuel_theft_detected", "refueling_detected", "fuel_spike_detected", "fuel_sensor_stuck", "fuel_anomaly_score",
    "current_spike_detected", "current_zero_running", "current_anomaly_score",
    "battery_low", "battery_spike", "battery_unstable", "battery_anomaly_score",
    "generator_state_anomaly", "state_anomaly_reason", "telemetry_anomaly", "telemetry_severity",
    "overall_anomaly", "anomaly_score", "anomaly_severity", "anomaly_reason", "recommended_action",
]


def with_anomaly_columns(df: DataFrame) -> DataFrame:
    """df with those of ANOMALY_COLUMNS that it lacks: texts empty, scores 0, flags false."""

    def initial(name: str) -> Column:
        if any(kind in name for kind in ("reason", "severity", "action")):
            return F.lit("")
        return F.lit(0.0) if "score" in name else F.lit(False)

    return df.withColumns({c: initial(c) for c in ANOMALY_COLUMNS if c not in df.columns})


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def share_by(df: DataFrame, column: str) -> DataFrame:
    out = counts_by(df, column)
    return out.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
