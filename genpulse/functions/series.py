"""Windows over series of readings: one generator, ordered by time and row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY, TIME, ROW = "generator_id", "timestamp", "row_id"
#: Readings enter time frames as decimals of this many places, so that running sums lose nothing.
PLACES = 6


def series(key: str = KEY, time: str = TIME, row: str = ROW) -> WindowSpec:
    return Window.partitionBy(key).orderBy(time, row)


def micros(column: str | Column = TIME) -> Column:
    return F.unix_micros(F.col(column) if isinstance(column, str) else column)


def change(column: str, rows: int = 1) -> Column:
    """Difference to the value `rows` rows before; null if either is."""
    return F.col(column) - F.lag(column, rows).over(series())


def seconds_since_last(time: str = TIME) -> Column:
    return (micros(time) - F.lag(micros(time)).over(series())) / 1e6


def flag(condition: Column) -> Column:
    """condition, where null counts as false."""
    return F.coalesce(condition, F.lit(False))


def bands(value: Column, labels: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound that value reaches, bounds falling."""
    out = None
    for bound, label in labels:
        out = F.when(value >= bound, label) if out is None else out.when(value >= bound, label)
    return out.otherwise(otherwise)


def clipped(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def reversed_series(key: str = KEY, time: str = TIME, row: str = ROW) -> WindowSpec:
    """The mirror of series(): what comes after a row is what comes before it here, so that looking
    ahead is a running value too and takes time in proportion to the rows."""
    return Window.partitionBy(key).orderBy(F.desc(time), F.desc(row))


def so_far(order: WindowSpec) -> WindowSpec:
    return order.rowsBetween(Window.unboundedPreceding, 0)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often use mentions it."""
    return F.transform(F.array(value), use)[0]


def rolling(column: str, seconds: float, least: int = 1, how: str = "mean", by: tuple[str, ...] = (KEY,)) -> Column:
    """mean, std (sample) or sum over the rows of the last `seconds`, the bound itself excluded, up to
    the row and not to its last peer; null with fewer than `least` values.

    A frame is the difference of two running sums: all up to the row, less all up to the bound. Sums
    are decimal and exact, so a long series loses no digits. Readings are taken to PLACES places: one
    of 10**9 or more, NaN or infinity counts as missing, and one below half of the last place as 0.
    A frame's sum must stay below 10**12. by: the columns that part the rows into series."""
    # both orders begin with the same expression, so that one sort serves them, and a task holds its rows once
    upto = so_far(Window.partitionBy(*by).orderBy(F.unix_micros(TIME), ROW))
    past = Window.partitionBy(*by).orderBy(F.unix_micros(TIME)).rangeBetween(Window.unboundedPreceding, -int(seconds * 1_000_000))
    x = F.col(column).try_cast(f"decimal(15,{PLACES})")
    within = lambda f, v: f(v).over(upto) - F.coalesce(f(v).over(past), F.lit(0))
    n, total = within(F.count, x), within(F.sum, x)
    if how == "sum":
        return F.when(n >= least, total.cast("double"))
    if how == "mean":
        return bound(F.struct(n.alias("n"), total.alias("total")), lambda f: F.when((f["n"] >= least) & (f["n"] > 0), f["total"].cast("double") / f["n"]))

    def spread(f: Column) -> Column:
        few, places = f["n"].cast("decimal(10,0)"), 2 * PLACES
        squares = few * f["squares"].cast(f"decimal(27,{places})") - f["total"].cast(f"decimal(18,{PLACES})") * f["total"].cast(f"decimal(18,{PLACES})")
        return F.when((f["n"] >= least) & (f["n"] > 1), F.sqrt(squares.cast("double") / (f["n"] * (f["n"] - 1))))

    return bound(F.struct(n.alias("n"), total.alias("total"), within(F.sum, x * x).alias("squares")), spread)


def rolling_rows(column: str, rows: int, how: str = "mean") -> Column:
    """mean, std, min or max over the last `rows` rows, null unless all have a value."""
    frame = series().rowsBetween(-(rows - 1), 0)
    made = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}[how](column).over(frame)
    return F.when(F.count(column).over(frame) == rows, made)


def interpolated(column: str, limit: int) -> Column:
    """column with nulls filled in line between the nearest values by row position, at most `limit`
    rows from either; before the first and after the last value the nearest is repeated."""
    place = F.row_number().over(series())
    here = F.when(F.col(column).isNotNull(), F.struct(place.alias("n"), F.col(column).alias("x")))
    back, ahead = (F.last(here, ignorenulls=True).over(so_far(order)) for order in (series(), reversed_series()))

    around = F.struct(back.alias("back"), ahead.alias("ahead"), place.alias("place"))
    return F.when(F.col(column).isNotNull(), F.col(column)).otherwise(on_line(around, limit))


def on_line(around: Column, limit: int) -> Column:
    """The value at `place` between the known rows (n, x) `back` and `ahead`, any of them null, where
    it is at most `limit` rows from either; around: a struct of the three."""

    def filled(row: Column) -> Column:
        back, ahead, place = row["back"], row["ahead"], row["place"]
        near_back, near_ahead = place - back["n"] <= limit, ahead["n"] - place <= limit
        line = back["x"] + (ahead["x"] - back["x"]) * (place - back["n"]) / (ahead["n"] - back["n"])
        return (
            F.when(back.isNotNull() & ahead.isNotNull(), F.when(near_back | near_ahead, line))
            .when(back.isNotNull(), F.when(near_back, back["x"]))
            .when(ahead.isNotNull(), F.when(near_ahead, ahead["x"]))
        )

    return bound(around, filled)


def cumulative(column: str) -> Column:
    """Running sum; null where the value is, and carried on after."""
    return F.when(F.col(column).isNotNull(), F.sum(column).over(series().rowsBetween(Window.unboundedPreceding, 0)))


def filled_both_ways(column: str) -> Column:
    """Last value before, or else the next one after."""
    return F.coalesce(*[F.last(column, ignorenulls=True).over(so_far(order)) for order in (series(), reversed_series())])


def asof(probes: DataFrame, builds: DataFrame, probe_time: Column, forward: bool, tolerance_seconds: float | None, value: str, as_value: str, as_time: str) -> DataFrame:
    """probes with the value and time of the nearest build row of their generator at or after
    (forward) or at or before probe_time. Of build rows at one time, forward takes the first and
    backward the last. Both sides pass through one window over their union: one shuffle by
    generator, and no pairs.
    """
    sides = probes.withColumn("_probe", F.struct(*probes.columns)).select(F.col(KEY), micros(probe_time).alias("_t"), F.lit(None).cast("struct<t:bigint,v:double>").alias("_hit"), "_probe", F.lit(None).cast("bigint").alias("_row"))
    found = builds.select(F.col(KEY), micros().alias("_t"), F.struct(micros().alias("t"), F.col(value).cast("double").alias("v")).alias("_hit"), F.lit(None).cast(sides.schema["_probe"].dataType).alias("_probe"), F.col(ROW).cast("bigint").alias("_row"))
    is_probe = F.col("_probe").isNotNull()
    if forward:
        order = Window.partitionBy(KEY).orderBy(F.desc("_t"), is_probe, F.desc("_row"))
    else:
        order = Window.partitionBy(KEY).orderBy("_t", is_probe, "_row")
    hit = F.last("_hit", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = sides.unionByName(found).withColumn("_hit", hit).where(is_probe)
    if tolerance_seconds is not None:
        out = out.withColumn("_hit", F.when(F.abs(F.col("_hit.t") - F.col("_t")) <= int(tolerance_seconds * 1e6), F.col("_hit")))
    return out.select("_probe.*", F.col("_hit.v").alias(as_value), F.col("_hit.t").alias(as_time))
