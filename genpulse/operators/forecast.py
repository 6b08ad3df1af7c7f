"""Features, targets, splits and evaluation of fuel forecasts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import segments
from ..functions.fingerprint import differences
from ..functions.gram import correlations
from ..functions.selection import at_places, percentiles
from ..functions.series import KEY, change, flag, micros, rolling, rolling_rows, seconds_since_last
from ..sources.scratch import stored
from ..sources.tables import SENSORS

ERROR_BINS = [(10, "<=10"), (25, "10-25"), (50, "25-50"), (100, "50-100"), (250, "100-250"), (500, "250-500"), (None, ">500")]
TOLERANCES = [1, 2, 5, 10, 20, 50, 100]
IDENTITY = [KEY, "site_name", "timestamp"]
MISSING = "<MISSING>"


def calendar(df: DataFrame) -> DataFrame:
    t = F.col("timestamp")
    out = df.withColumns({"hour": F.hour(t), "minute": F.minute(t), "day": F.dayofmonth(t), "weekday": F.weekday(t), "month": F.month(t)})
    turn = 2 * 3.141592653589793
    cyclic = {"hour_sin": F.sin(turn * F.col("hour") / 24), "hour_cos": F.cos(turn * F.col("hour") / 24), "weekday_sin": F.sin(turn * F.col("weekday") / 7), "weekday_cos": F.cos(turn * F.col("weekday") / 7)}
    return out.withColumn("is_weekend", (F.col("weekday") >= 5).cast("int")).withColumns(cyclic)


def target(df: DataFrame, hours: float = 3, tolerance_minutes: float = 5, segment: float = segments.SEGMENT) -> DataFrame:
    """df with target_fuel, target_us, target_minutes and target_available: the first valid fuel
    level of the same generator at or within tolerance after `hours` later. segment: seconds of a
    series that one task joins."""
    valid = df.where("fuel_level_l >= 0").select(KEY, "timestamp", "row_id", "fuel_level_l")
    later = F.timestamp_micros(micros() + int(hours * 3600e6))
    out = segments.asof(df, valid, later, True, tolerance_minutes * 60, "fuel_level_l", "target_fuel", "target_us", segment)
    minutes = (F.col("target_us") - micros() - int(hours * 3600e6)) / 60e6
    return out.withColumns({"target_minutes": minutes, "target_available": F.col("target_fuel").isNotNull()})


def persistence(df: DataFrame, segment: float = segments.SEGMENT) -> DataFrame:
    """df with persistence: the last valid fuel level at or before a row. Of packets at one time, the largest."""
    history = df.where("fuel_level_l >= 0").groupBy(KEY, "timestamp").agg(F.max("fuel_level_l").alias("fuel_level_l"), F.max("row_id").alias("row_id"))
    return segments.asof(df, history, F.col("timestamp"), False, None, "fuel_level_l", "persistence", "persistence_us", segment)


def windowed(df: DataFrame, minutes: tuple[int, ...] = (5, 15, 30, 60), least: int = 3, more: tuple[str, ...] = (), segment: float | None = None) -> DataFrame:
    """Mean and standard deviation of each sensor over the last minutes, and means of the columns in
    more. segment: seconds of a series that one task takes; None: a generator in one task."""
    frames = {}
    for m in minutes:
        for c in SENSORS:
            short = c.split("_")[0]
            frames[f"{short}_mean_{m}min"] = segments.Frame(c, 60 * m, least, "mean")
            frames[f"{short}_std_{m}min"] = segments.Frame(c, 60 * m, least, "std")
        for c in more:
            frames[f"{c.removesuffix('_score')}_mean_{m}min"] = segments.Frame(c, 60 * m, least, "mean")
    if segment is not None:
        return segments.framed(df, frames, segment)
    return df.withColumns({name: rolling(f.column, f.seconds, f.least, f.how) for name, f in frames.items()})


def changes(df: DataFrame, rows: tuple[int, ...] = (15, 30, 60), refill: float = 50.0) -> DataFrame:
    """Changes of fuel over rows, trends (change a row), and refill and drop signals over the last."""
    out = df.withColumns({f"fuel_change_{n}": change("fuel_level_l", n) for n in rows})
    out = out.withColumns({f"fuel_trend_{n}": F.col(f"fuel_change_{n}") / n for n in rows})
    last = F.col(f"fuel_change_{rows[-1]}")
    return out.withColumns({"refill_signal": flag(last > refill).cast("int"), "drop_signal": flag(last < -refill).cast("int")})


def row_features(df: DataFrame, lags: tuple[int, ...] = (1, 5, 15), windows: tuple[int, ...] = (5, 15), segment: float | None = None) -> DataFrame:
    """Lags of each sensor, and mean, std, min and max of fuel over full windows of rows. segment:
    seconds of a series that one task takes; windows then cost the same however long they are."""
    from ..functions.series import series

    hows = ("mean", "std", "min", "max")
    if segment is not None:
        out = segments.scan(df, {f"{c}_lag_{n}": segments.lag(c, n) for c in SENSORS for n in lags}, segment)
        return segments.row_framed(out, {f"fuel_{how}_{n}rows": segments.RowFrame("fuel_level_l", n, how) for n in windows for how in hows}, segment)
    out = df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(series()) for c in SENSORS for n in lags})
    return out.withColumns({f"fuel_{how}_{n}rows": rolling_rows("fuel_level_l", n, how) for n in windows for how in hows})


def sensor_flags(df: DataFrame) -> DataFrame:
    """Missing, invalid, outlier and gap flags of the model's features, as 0 and 1."""
    out = df
    for c in SENSORS:
        out = out.withColumn(f"{c}_missing", F.col(c).isNull().cast("int"))
    return out.withColumns(
        {
            "fuel_outlier_flag": flag(F.abs(change("fuel_level_l")) > 100).cast("int"),
            "current_outlier_flag": flag(F.abs(change("current")) > 100).cast("int"),
            "voltage_outlier_flag": flag(F.abs(change("battery_voltage")) > 50).cast("int"),
            "gap_flag": flag(seconds_since_last() > 180).cast("int"),
            "battery_zero": flag(F.col("battery_voltage") <= 0).cast("int"),
            "fuel_zero_or_negative": flag(F.col("fuel_level_l") <= 0).cast("int"),
            "current_active": flag(F.col("current") > 5).cast("int"),
        }
    ).withColumn("sensor_missing_count", sum(F.col(f"{c}_missing") for c in SENSORS))


def split(df: DataFrame, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """df with split: the first rows of each generator train, the next validate, the rest test."""
    w = Window.partitionBy(KEY)
    n, k = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy("timestamp", "row_id"))
    out = df.withColumns({"_n": n, "_k": k})
    a, b = F.floor(F.col("_n") * train), F.floor(F.col("_n") * (train + validation))
    return out.withColumn("split", F.when(F.col("_k") <= a, "train").when(F.col("_k") <= b, "validation").otherwise("test")).drop("_n", "_k")


def global_split(df: DataFrame, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """df with split by place in the order of (timestamp, row_id) over all generators. The two
    bounds are exact: the time at a bound's place is selected, and then, among the rows of that time,
    the row. No task sorts the table or a part of it that grows with it."""
    known = df.where("timestamp IS NOT NULL")
    total = known.count()
    places = [p for p in (int(total * train), int(total * (train + validation))) if p]
    times = [int(t) for t in at_places(known, micros(), places)] if places else []
    before = known.agg(*[F.count_if(micros() < t) for t in times]).first() if times else []
    rows = [int(at_places(known.where(micros() == t), F.col("row_id"), [p - n])[0]) for p, t, n in zip(places, times, before)]
    among = [(micros() < t) | ((micros() == t) & (F.col("row_id") <= r)) for t, r in zip(times, rows)]
    first, second = [F.lit(False)] * (2 - len(among)) + among
    return df.withColumn("split", F.when(first, "train").when(second, "validation").otherwise("test"))


def split_order(df: DataFrame) -> DataFrame:
    """Whether each generator's training rows end before its validation rows begin, and these before its test rows."""
    edge = lambda f, s: f(F.when(F.col("split") == s, micros()))
    out = df.groupBy(KEY).agg(edge(F.max, "train").alias("a"), edge(F.min, "validation").alias("b"), edge(F.max, "validation").alias("c"), edge(F.min, "test").alias("d"))
    return out.select(KEY, F.coalesce((F.col("a") <= F.col("b")) & (F.col("c") <= F.col("d")), F.lit(True)).alias("ordered"))


def frequency_encoded(df: DataFrame, column: str) -> DataFrame:
    """df with <column>__frequency: the share of rows with the same value, nulls counted as one."""
    value = F.coalesce(column, F.lit(MISSING))
    counts = df.groupBy(value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    counts = counts.withColumn(f"{column}__frequency", F.col("_n") / F.lit(max(total, 1))).drop("_n")
    return df.join(counts, value == F.col("_v")).drop("_v")


def one_hot(df: DataFrame, column: str, most: int = 50) -> DataFrame:
    """df with a 0/1 column for each value of column; an error beyond `most` of them."""
    value = F.coalesce(column, F.lit(MISSING))
    values = sorted(r[0] for r in df.select(value).distinct().limit(most + 1).collect())
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values; encode its frequency")
    return df.withColumns({f"{column}__{v}": (value == v).cast("int") for v in values})


def encoded(df: DataFrame, columns: list[str], most: int = 50) -> DataFrame:
    out = df
    for c in columns:
        few = df.select(c).distinct().limit(most + 1).count() <= most
        out = one_hot(out, c, most) if few else frequency_encoded(out, c)
    return out


def model_features(df: DataFrame, target_column: str = "target_fuel") -> list[str]:
    """Columns that a model may see: neither identity nor derived from the target."""
    leaks = leaking(df.columns)
    return [c for c in df.columns if c not in {*IDENTITY, target_column, "split", "row_id"} and c not in leaks]


def leaking(columns: list[str]) -> list[str]:
    """Names that tell of the future: target_..., future_..., ..._future..."""
    return [c for c in columns if re.match(r"target_|future_", c) or "_future" in c]


def require_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error where a feature is absent, doubled, not numeric or infinite anywhere."""
    for c in columns:
        if df.columns.count(c) != 1 or not isinstance(df.schema[c].dataType, T.NumericType):
            raise ValueError(f"{c} is not a single numeric column")
    bad = df.agg(*[F.count_if(F.abs(F.col(c).cast("double")) == float("inf")).alias(c) for c in columns]).first()
    if any(bad):
        raise ValueError(f"infinite values: {[c for c in columns if bad[c]]}")
    return df


def with_errors(df: DataFrame, prediction: str = "prediction", truth: str = "target_fuel") -> DataFrame:
    out = df.withColumn("error", F.col(prediction) - F.col(truth))
    return out.withColumn("absolute_error", F.abs("error"))


def metrics(df: DataFrame, by: list[str] | None = None, truth: str = "target_fuel") -> DataFrame:
    """n, mae, rmse, r2, bias, median and largest error, mape over |truth| > 1e-6; over with_errors()."""
    e, y = F.col("error"), F.col(truth)
    out = df.where(e.isNotNull()).groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.avg("absolute_error").alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.sum(e * e), F.sum(y * y) - F.count(F.lit(1)) * F.avg(y) * F.avg(y))).alias("r2"),
        F.avg("error").alias("bias"), F.max("absolute_error").alias("most"), (100 * F.avg(F.when(F.abs(y) > 1e-6, F.abs(e / y)))).alias("mape"),
    )
    middle = percentiles(df.where(e.isNotNull()), "absolute_error", [0.5], by)
    middle = middle.select(*[F.col(c).alias(f"_of_{c}") for c in by or []], F.col("q")[0].alias("median"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by or []] or F.lit(True)
    out = out.join(middle, same, "left").drop(*[f"_of_{c}" for c in by or []])
    return out.withColumns({c: F.round(c, 4) for c in ("mae", "rmse", "r2", "bias", "median", "most", "mape")})


def beside_persistence(predicted: DataFrame, history: DataFrame, by: str = KEY) -> DataFrame:
    """metrics() of predictions in each group, with persistence_mae of the last valid fuel level in
    history over the rows that have one, and by how many percent the model's error is smaller there.
    predicted has row_id, and its rows are rows of history too."""
    last = persistence(history).select(F.col("row_id").alias("_row"), "persistence")
    both = predicted.join(last, F.col("row_id") == F.col("_row"), "left").drop("_row")
    off = with_errors(both)
    theirs = F.abs(F.col("persistence") - F.col("target_fuel"))
    ours = F.when(theirs.isNotNull(), F.col("absolute_error"))
    side = off.groupBy(F.col(by).alias("_of")).agg(F.avg(theirs).alias("persistence_mae"), F.avg(ours).alias("_ours"))
    side = side.withColumn("improvement", F.round(100 * F.try_divide(F.col("persistence_mae") - F.col("_ours"), "persistence_mae"), 4)).withColumn("persistence_mae", F.round("persistence_mae", 4))
    return metrics(off, [by]).join(side.drop("_ours"), F.col(by).eqNullSafe(F.col("_of")), "left").drop("_of")


def tolerance_curve(df: DataFrame) -> DataFrame:
    """Percent of errors within each tolerance, in one pass."""
    one = df.where("error IS NOT NULL").agg(*[(100 * F.avg((F.col("absolute_error") <= t).cast("double"))).alias(str(t)) for t in TOLERANCES])
    return one.unpivot([], [f"`{t}`" for t in TOLERANCES], "tolerance", "percent").withColumn("percent", F.round("percent", 4))


def error_percentiles(df: DataFrame) -> DataFrame:
    marks = [0.5, 0.75, 0.9, 0.95, 0.99, 0.999]
    q = percentiles(df, "absolute_error", marks)
    return q.select(F.posexplode("q").alias("k", "value")).select(F.element_at(F.array(*map(F.lit, marks)), F.col("k") + 1).alias("mark"), F.round("value", 4).alias("value"))


def error_by_range(df: DataFrame, truth: str = "target_fuel") -> DataFrame:
    """Count and mean absolute error in bins of the true value; bins without rows stay."""
    y = F.col(truth)
    label = F.when(y.isNull(), None)
    for bound, name in ERROR_BINS:
        label = label.when(y <= bound, name) if bound is not None else label.otherwise(name)
    found = df.where("error IS NOT NULL").groupBy(label.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("absolute_error"), 4).alias("mae"))
    bins = df.sparkSession.createDataFrame([(name,) for _, name in ERROR_BINS], "bin string")
    return bins.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mae")


def worst(df: DataFrame, n: int = 20) -> DataFrame:
    """The n rows of largest absolute error."""
    return df.where("error IS NOT NULL").orderBy(F.desc("absolute_error"), "row_id").limit(n)


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many rows only a and only b have, counting repeats: equal tables give zeros. Tables are
    compared by fingerprints of ranges, and row by row only where these differ."""
    rows = differences(a, b)
    more = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0))
    return rows.agg(more("n_a", "n_b").alias("only_a"), more("n_b", "n_a").alias("only_b"))


def target_changes(a: DataFrame, b: DataFrame, column: str = "target_fuel", keys: tuple[str, ...] = (KEY, "timestamp", "row_id")) -> DataFrame:
    """Rows in one table only and in both, and how targets changed between them. Rows of equal keys,
    null or not, meet one to one in the order of their targets, however often a key occurs."""
    side = lambda df, first: df.select(*keys, F.lit(first).alias("_first"), F.col(column).alias("_value"))
    order = Window.partitionBy(*keys).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    both = side(a, True).unionByName(side(b, False))
    both = both.withColumn("_k", F.when(F.col("_first"), F.count_if("_first").over(order)).otherwise(F.count_if(~F.col("_first")).over(order)))
    of = lambda first, how, value: how(F.when(F.col("_first") == first, value))
    met = both.groupBy(*keys, "_k").agg(of(True, F.count, F.lit(1)).alias("_a"), of(False, F.count, F.lit(1)).alias("_b"), of(True, F.max, F.col("_value")).alias("x"), of(False, F.max, F.col("_value")).alias("y"))
    here = (F.col("_a") > 0) & (F.col("_b") > 0)
    return met.agg(
        F.count_if(F.col("_b") == 0).alias("left_only"), F.count_if(F.col("_a") == 0).alias("right_only"), F.count_if(here).alias("in_both"),
        F.count_if(here & F.col("x").isNotNull() & F.col("y").isNull()).alias("valid_to_missing"), F.count_if(here & F.col("x").isNull() & F.col("y").isNotNull()).alias("missing_to_valid"),
        F.count_if(here & (F.abs(F.col("x") - F.col("y")) > 1e-6)).alias("changed"),
    )


def selected_features(df: DataFrame, columns: list[str], constant: float = 0.99, missing: float = 0.5, correlation: float = 0.95, variance: float = 0.001) -> DataFrame:
    """feature, verdict: kept, constant, missing, correlated (with a feature before it that is neither
    constant nor missing) or low_variance, the first that applies.

    The columns are stored once. Correlations of all pairs, nulls left out pair by pair, come from one
    pass. The table of features is as long as the list of columns."""
    values = stored(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "features")
    facts = values.agg(F.count(F.lit(1)), *[F.avg(F.col(c).isNull().cast("double")) for c in columns], *[F.var_samp(c) for c in columns]).first()
    n, rate, spread = facts[0], dict(zip(columns, facts[1:])), dict(zip(columns, facts[1 + len(columns) :]))
    # the commonest value of every column, from one unpivot and one shuffle
    each = values.unpivot([], columns, "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    tops = dict(each.groupBy("feature").agg(F.max("n")).collect())
    verdict = {}
    for c in columns:
        if n and tops.get(c, 0) / n >= constant:
            verdict[c] = "constant"
        elif (rate[c] or 0) > missing:
            verdict[c] = "missing"
    rest = [c for c in columns if c not in verdict]
    close = {r.b for r in correlations(values, rest).where(F.abs("correlation") > correlation).select("b").distinct().collect()}
    verdict.update(dict.fromkeys(close, "correlated"))
    verdict.update({c: "low_variance" for c in rest if c not in verdict and (spread[c] or 0) < variance})
    return df.sparkSession.createDataFrame([(c, verdict.get(c, "kept")) for c in columns], "feature string, verdict string")


def selection_report(verdicts: DataFrame) -> DataFrame:
    """stage, features, percent: how many of the features each filter took, and how many are kept."""
    stages = ["constant", "missing", "correlated", "low_variance", "kept"]
    counts = verdicts.agg(*[F.count_if(F.col("verdict") == s).alias(s) for s in stages], F.count(F.lit(1)).alias("_all"))
    long = counts.unpivot(["_all"], stages, "stage", "features")
    return long.select("stage", "features", F.round(100 * F.try_divide("features", "_all"), 4).alias("percent"))


def boosted_trees(train: DataFrame, features: list[str], label: str = "target_fuel", trees: int = 50, depth: int = 5, rate: float = 0.1, seed: int = 42):
    """A fitted pipeline of gradient-boosted trees; missing features become -1, far from any reading."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    filled = train.where(F.col(label).isNotNull()).select(label, *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in features])
    model = GBTRegressor(labelCol=label, featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), model]).fit(filled)


def predict(model, df: DataFrame, features: list[str]) -> DataFrame:
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in features})
    return model.transform(filled).drop("features")


def tuned(train: DataFrame, validation: DataFrame, features: list[str], configs: list[dict], label: str = "target_fuel"):
    """(config, model) of least mean absolute error on validation; the test rows play no part."""
    best = None
    for config in configs:
        model = boosted_trees(train, features, label, **config)
        error = predict(model, validation, features).agg(F.avg(F.abs(F.col("prediction") - F.col(label)))).first()[0]
        if best is None or (error is not None and error < best[0]):
            best = (error, config, model)
    return best[1], best[2]


def importances(model, features: list[str], spark, top: int = 20) -> DataFrame:
    scores = sorted(zip(features, model.stages[-1].featureImportances.toArray().tolist()), key=lambda x: -x[1])[:top]
    return spark.createDataFrame(scores, "feature string, importance double")
