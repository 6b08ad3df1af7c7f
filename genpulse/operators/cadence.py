"""Reporting cadence and telemetry quality of generators."""

from __future__ import annotations

from statistics import median

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.selection import percentiles
from ..functions.series import KEY, bands, clipped, seconds_since_last
from ..sources.tables import SENSORS


def intervals(df: DataFrame, longest: float = 300.0) -> DataFrame:
    """Gaps between 1 and `longest` seconds: generator, gap."""
    return df.select(KEY, seconds_since_last().alias("gap")).where((F.col("gap") > 1) & (F.col("gap") <= longest))


def cadence(df: DataFrame, longest: float = 300.0, least_samples: int = 30, default: int = 60, tolerance: float = 5.0, share: float = 0.08, refine: float = 10.0, refine_share: float = 0.25) -> DataFrame:
    """Reporting interval of each generator: the commonest rounded gap, refined to the median of the
    gaps near it, with confidence, stability and the spread of its gaps. Generators with fewer than
    least_samples gaps get the default and confidence 0."""
    gaps = intervals(df, longest).withColumn("whole", F.rint("gap"))
    base = gaps.groupBy(KEY).agg(F.expr("mode(whole, true)").alias("base"))
    near = gaps.join(base, KEY)
    close = F.abs(F.col("gap") - F.col("base")) <= F.greatest(F.lit(tolerance), share * F.col("base"))
    wide = F.abs(F.col("gap") - F.col("base")) <= F.greatest(F.lit(refine), refine_share * F.col("base"))
    stats = near.groupBy(KEY).agg(
        F.first("base").alias("base"),
        F.count(F.lit(1)).alias("samples"),
        F.count_if(close).alias("cluster"),
        F.min("gap").alias("least"), F.max("gap").alias("most"), F.avg("gap").alias("mean"), F.stddev_pop("gap").alias("spread"),
    )
    # both medians at once: of all gaps, and of those near the base
    kinds = near.select(KEY, "gap", F.explode(F.when(wide, F.array(F.lit("median"), F.lit("middle"))).otherwise(F.array(F.lit("median")))).alias("kind"))
    medians = percentiles(kinds, "gap", [0.5], [KEY, "kind"]).groupBy(F.col(KEY).alias("_of"))
    medians = medians.agg(*[F.max(F.when(F.col("kind") == k, F.col("q")[0])).alias(k) for k in ("median", "middle")])
    stats = stats.join(medians, F.col(KEY).eqNullSafe(F.col("_of")), "left").drop("_of")
    all_ids = df.select(KEY).distinct()
    out = all_ids.join(stats, KEY, "left").withColumn("samples", F.coalesce("samples", F.lit(0)).cast("long"))
    enough = F.col("samples") >= least_samples
    confidence = clipped(100 * F.col("cluster") / F.col("samples") - 100 * F.col("spread") / F.col("base"))
    out = out.withColumns({"interval": F.when(enough, F.rint("middle")).otherwise(F.lit(float(default))), "confidence": F.round(F.when(enough, confidence).otherwise(0.0), 4)})
    return out.select(
        KEY, F.col("interval").cast("int").alias("interval"), "confidence", stability(F.col("confidence")).alias("stability"), "samples",
        F.coalesce("cluster", F.lit(0)).cast("long").alias("cluster"),
        *[F.round(c, 4).alias(c) for c in ("least", "median", "mean", "most", "spread")],
    )


def simple_interval(df: DataFrame, longest: float = 300.0, default: int = 60) -> DataFrame:
    """The commonest gap of whole seconds up to `longest` of each generator, at least 1; the default where there is none."""
    gaps = df.select(KEY, seconds_since_last().alias("gap")).groupBy(KEY).agg(F.mode(F.when(F.col("gap") <= longest, F.floor("gap")), True).alias("base"))
    return gaps.select(KEY, F.greatest(F.lit(1), F.coalesce("base", F.lit(default))).cast("int").alias("interval"))


def interval_diagnostics(df: DataFrame) -> DataFrame:
    """Count, mean, deviation and extremes of all gaps of each generator."""
    gaps = df.select(KEY, seconds_since_last().alias("gap"))
    out = gaps.groupBy(KEY).agg(F.count("gap").alias("n"), F.avg("gap").alias("mean"), F.stddev_samp("gap").alias("std"), F.min("gap").alias("least"), F.max("gap").alias("most"))
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "least", "most")})


def with_interval(df: DataFrame, cadences: DataFrame, default: int = 60) -> DataFrame:
    """df with reporting_interval_sec, looked up by generator. cadences has one row a generator."""
    found = cadences.select(KEY, F.col("interval").alias("_interval"))
    return df.join(found, KEY, "left").withColumn("reporting_interval_sec", F.coalesce("_interval", F.lit(default))).drop("_interval")


def compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intervals and confidences of two tables of cadences side by side, the surest first."""
    side = lambda df, s: df.select(KEY, F.col("interval").alias(f"interval_{s}"), F.col("confidence").alias(f"confidence_{s}"))
    out = side(a, "a").join(side(b, "b"), KEY, "full_outer")
    return out.withColumn("differ", ~F.col("interval_a").eqNullSafe(F.col("interval_b"))).orderBy(F.desc_nulls_last("confidence_a"), KEY)


def stability(confidence: F.Column) -> F.Column:
    return bands(confidence, [(95, "Excellent"), (85, "Good"), (70, "Moderate"), (50, "Poor")], "Unstable")


def cadence_histogram(df: DataFrame, longest: float = 300.0, cluster: float = 3.0) -> DataFrame:
    """Peak of a histogram of one-second bins, and the share of gaps within `cluster` of its middle."""
    gaps = intervals(df, longest).withColumn("bin", F.floor("gap"))
    bins = gaps.groupBy(KEY, "bin").agg(F.count(F.lit(1)).alias("n"))
    peaks = bins.groupBy(KEY).agg(F.max(F.struct("n", -F.col("bin"))).alias("top")).select(KEY, (F.lit(0.5) - F.col("top.col2")).alias("peak"))
    near = gaps.join(peaks, KEY).groupBy(KEY, "peak").agg(F.count(F.lit(1)).alias("samples"), F.count_if(F.abs(F.col("gap") - F.col("peak")) <= cluster).alias("cluster"))
    return near.withColumn("percent", F.round(100 * F.col("cluster") / F.col("samples"), 4))


def cadence_classes(cadences: DataFrame, within: float = 5.0) -> DataFrame:
    """generator, interval, class and class_interval: intervals near one another share a class.

    In the order of generators, an interval that no class has yet begins one, of all that lie within
    `within` seconds of it; the class has their rounded median. Where classes would overlap, every
    interval stays as it is. Only the different intervals are looked at one by one, which are whole
    seconds up to the longest gap, and not the generators."""
    seen = cadences.where("interval IS NOT NULL").groupBy("interval").agg(F.min(KEY).alias("first"), F.count(F.lit(1)).alias("n")).orderBy(F.asc_nulls_last("first"), "interval").collect()
    begun: list[int] = []
    for r in seen:
        if all(abs(r.interval - b) > within for b in begun):
            begun.append(r.interval)
    near = {b: [r for r in seen if abs(r.interval - b) <= within] for b in begun}
    if sum(len(rows) for rows in near.values()) > len(seen):
        near = {r.interval: [r] for r in seen}
    rows = [(r.interval, k, int(round(median([r.interval for r in of for _ in range(1 if len(of) == 1 else r.n)])))) for k, of in enumerate(near.values(), 1) for r in of]
    classes = cadences.sparkSession.createDataFrame(rows, "interval int, class int, class_interval int")
    return cadences.select(KEY, F.col("interval").cast("int").alias("interval")).join(F.broadcast(classes), "interval", "left").select(KEY, "interval", "class", "class_interval")


def telemetry_quality(df: DataFrame, cadences: DataFrame, default: int = 60) -> DataFrame:
    """Packet, interval and sensor scores of each generator, their weighted mean, grade and issues.

    cadences (generator_id, interval) has one row a generator; those it lacks take the default."""
    gaps = df.withColumn("gap", seconds_since_last())
    blank = sum(F.avg(F.col(c).isNull().cast("double")) for c in SENSORS) / len(SENSORS)
    per = gaps.groupBy(KEY).agg(F.count("gap").alias("n_gaps"), F.sum("gap").alias("span"), F.avg("gap").alias("mean_gap"), F.count(F.lit(1)).alias("actual"), blank.alias("blank"))
    per = per.join(cadences.select(KEY, "interval"), KEY, "left").withColumn("interval", F.coalesce("interval", F.lit(default)))
    expected = F.col("span") / F.col("interval")
    packet = F.when(F.col("n_gaps") == 0, 100.0).otherwise(clipped(100 - 100 * F.greatest(F.lit(0.0), expected - F.col("actual")) / expected))
    regular = F.when(F.col("n_gaps") == 0, 0.0).otherwise(clipped(100 - 100 * F.abs(F.col("mean_gap") - F.col("interval")) / F.col("interval")))
    out = per.withColumns({"packet_score": F.round(packet, 4), "interval_score": F.round(regular, 4), "sensor_score": F.round(100 - 100 * F.col("blank"), 4)})
    out = out.withColumn("quality_score", F.round(0.4 * F.col("packet_score") + 0.4 * F.col("interval_score") + 0.2 * F.col("sensor_score"), 4))
    issues = F.array_compact(F.array(*[F.when(F.col(f"{c}_score") < 75, text) for c, text in (("packet", "Packet loss"), ("interval", "Irregular interval"), ("sensor", "Missing sensors"))]))
    grade = bands(F.col("quality_score"), [(90, "Excellent"), (75, "Good"), (50, "Fair")], "Poor")
    return out.select(KEY, "packet_score", "interval_score", "sensor_score", "quality_score", grade.alias("communication_health"), F.array_join(issues, "; ").alias("issues"))
