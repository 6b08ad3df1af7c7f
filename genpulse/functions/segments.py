"""Series in segments of time, so that one generator's series runs in many tasks.

A series is cut into segments of equal length in time. Windows run inside segments; what a segment
must know of the others is a carry of bounded size: its last values, its sums, its first and last
known readings. A table of carries has one row for each generator and segment. A prefix pass over
it gives each segment what comes before and after it, and a join on (generator, segment), which
keeps the rows where they are, brings that to the rows for one fix-up.

Time frames need rows and not carries: each row is copied to the segments in which frames still
reach it, at most one where segments are longer than the frames.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .series import KEY, ROW, TIME, micros, on_line, rolling, so_far

#: Seconds of a segment: a week.
SEGMENT = 7 * 86_400.0
#: Names of a row's series, segment, place in its segment (from 1) and number of rows there; of the rows before a segment.
_K, _S, _P, _N, _OFFSET = "_series", "_segment", "_place", "_rows", "_offset"


@dataclass
class Step:
    """A value over a series: columns within a segment, aggregates of a segment, carries made of
    those of other segments, and the value from all of these."""

    value: Column
    local: dict[str, Column] = field(default_factory=dict)
    summary: dict[str, Column] = field(default_factory=dict)
    carried: dict[str, Column] = field(default_factory=dict)


Maker = Callable[[str], Step]


def _within(reverse: bool = False) -> WindowSpec:
    order = [F.desc(TIME), F.desc(ROW)] if reverse else [F.asc(TIME), F.asc(ROW)]
    return Window.partitionBy(_K, _S).orderBy(*order)


def _segments(after: bool = False) -> WindowSpec:
    """The segments before (after) one, up to its neighbour."""
    order = Window.partitionBy(_K).orderBy(F.desc(_S) if after else F.asc(_S))
    return order.rowsBetween(Window.unboundedPreceding, -1)


def lag(column: str, rows: int = 1) -> Maker:
    """The value `rows` rows before."""

    def made(name: str) -> Step:
        tail, recent, here = f"{name}_tail", f"{name}_recent", f"{name}_here"
        last = F.collect_list(F.when(F.col(_N) - F.col(_P) < rows, F.struct(F.col(_P).alias("p"), F.col(column).alias("x"))))
        # every segment has a row, so the last rows lie in as many segments
        before = F.collect_list(tail).over(Window.partitionBy(_K).orderBy(_S).rowsBetween(-rows, -1))
        return Step(
            F.when(F.col(_P) > rows, F.col(here)).otherwise(F.get(recent, rows - F.col(_P))["x"]),
            {here: F.lag(column, rows).over(_within())},
            {tail: F.sort_array(last, asc=False)},
            {recent: F.slice(F.flatten(F.reverse(before)), 1, rows)},
        )

    return made


def total(column: str) -> Maker:
    """Running sum; null where the value is, and carried on after."""

    def made(name: str) -> Step:
        here, whole, before = f"{name}_here", f"{name}_whole", f"{name}_before"
        value = F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0))
        return Step(F.when(F.col(column).isNotNull(), value), {here: F.sum(column).over(so_far(_within()))}, {whole: F.sum(column)}, {before: F.sum(whole).over(_segments())})

    return made


def place() -> Maker:
    """The row's number in its series, from 1."""
    return lambda name: Step(F.col(_OFFSET) + F.col(_P))


def last_known(column: str) -> Maker:
    """The value, or the last one before."""

    def made(name: str) -> Step:
        here, last, before = f"{name}_here", f"{name}_last", f"{name}_before"
        known = F.when(F.col(column).isNotNull(), F.col(_P))
        return Step(F.coalesce(here, before), {here: F.last(column, True).over(so_far(_within()))}, {last: F.max_by(column, known)}, {before: F.last(last, True).over(_segments())})

    return made


def next_known(column: str) -> Maker:
    """The value, or the next one after."""

    def made(name: str) -> Step:
        here, first, after = f"{name}_here", f"{name}_first", f"{name}_after"
        known = F.when(F.col(column).isNotNull(), F.col(_P))
        return Step(F.coalesce(here, after), {here: F.last(column, True).over(so_far(_within(True)))}, {first: F.min_by(column, known)}, {after: F.last(first, True).over(_segments(True))})

    return made


def either_known(column: str) -> Maker:
    """The last value before, or else the next one after."""

    def made(name: str) -> Step:
        a, b = last_known(column)(f"{name}_a"), next_known(column)(f"{name}_b")
        return Step(F.coalesce(a.value, b.value), a.local | b.local, a.summary | b.summary, a.carried | b.carried)

    return made


def line(column: str, limit: int) -> Maker:
    """The value, or one in line between the nearest values by row position, at most `limit` rows
    from either; before the first and after the last value the nearest is repeated."""

    def made(name: str) -> Step:
        known = F.when(F.col(column).isNotNull(), F.struct(F.col(_P).cast("long").alias("n"), F.col(column).alias("x")))
        in_series = lambda c: F.when(F.col(c).isNotNull(), F.struct((F.col(_OFFSET) + F.col(c)["n"]).alias("n"), F.col(c)["x"].alias("x")))
        back, ahead, first, last, before, after = (f"{name}_{k}" for k in ("back", "ahead", "first", "last", "before", "after"))
        around = F.struct(F.coalesce(in_series(back), before).alias("back"), F.coalesce(in_series(ahead), after).alias("ahead"), (F.col(_OFFSET) + F.col(_P)).alias("place"))
        return Step(
            F.when(F.col(column).isNotNull(), F.col(column)).otherwise(on_line(around, limit)),
            {back: F.last(known, True).over(so_far(_within())), ahead: F.last(known, True).over(so_far(_within(True)))},
            {first: F.min(known), last: F.max(known)},
            {before: F.last(in_series(last), True).over(_segments()), after: F.last(in_series(first), True).over(_segments(True))},
        )

    return made


def _placed(df: DataFrame, seconds: float) -> DataFrame:
    # rows without a time are a segment of their own before all others, as they sort first
    segment = F.coalesce(F.floor(micros() / int(seconds * 1_000_000)), F.lit(-(1 << 62)))
    return df.withColumns({_K: F.coalesce(F.concat(F.lit("="), F.col(KEY).cast("string")), F.lit("")), _S: segment})


def scan(df: DataFrame, steps: dict[str, Maker], seconds: float = SEGMENT) -> DataFrame:
    """df with a column for each step. Steps read columns of df. Rows are ordered by (timestamp,
    row_id) in each generator; rows of one timestamp are in one segment."""
    if not steps:
        return df
    made = {name: maker(f"_{k}") for k, (name, maker) in enumerate(steps.items())}
    every = lambda part: {c: x for step in made.values() for c, x in getattr(step, part).items()}
    rows = _placed(df, seconds).withColumns({_P: F.row_number().over(_within()), _N: F.count(F.lit(1)).over(Window.partitionBy(_K, _S))})
    sums = rows.groupBy(_K, _S).agg(F.count(F.lit(1)).alias("_count"), *[x.alias(c) for c, x in every("summary").items()])
    carries = sums.withColumn(_OFFSET, F.coalesce(F.sum("_count").over(_segments()), F.lit(0))).withColumns(every("carried"))
    carries = carries.select(_K, _S, _OFFSET, *every("carried"))
    local = rows.withColumns(every("local")) if every("local") else rows
    out = local.join(carries, [_K, _S])
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in made], *[step.value.alias(name) for name, step in made.items()])


@dataclass(frozen=True)
class Frame:
    """mean, std or sum of a column over the last `seconds`, as rolling() has it."""

    column: str
    seconds: float
    least: int = 1
    how: str = "mean"


def framed(df: DataFrame, frames: dict[str, Frame], seconds: float = SEGMENT) -> DataFrame:
    """df with a column for each frame: rolling() over segments, with the rows before each that its frames reach."""
    width, reach = int(seconds * 1_000_000), int(max(f.seconds for f in frames.values()) * 1_000_000)
    last = F.floor((micros() + (reach - 1)) / width)
    rows = _placed(df, seconds).withColumn("_own", F.col(_S))
    rows = rows.withColumn(_S, F.explode(F.when(F.col(TIME).isNotNull(), F.sequence(F.col("_own"), last)).otherwise(F.array("_own"))))
    out = rows.withColumns({name: rolling(f.column, f.seconds, f.least, f.how, by=(_K, _S)) for name, f in frames.items()})
    return out.where(F.col(_S) == F.col("_own")).drop(_K, _S, "_own")


@dataclass(frozen=True)
class RowFrame:
    """mean, std, min or max of a column over the last `rows` rows, null unless all have a value."""

    column: str
    rows: int
    how: str = "mean"


def _state(column: str, order: WindowSpec) -> Column:
    """What a run of rows tells of a column: number, mean, sum of squares about it, extremes."""
    over = so_far(order)
    x = F.col(column)
    return F.struct(F.count(x).over(over).alias("n"), F.avg(x).over(over).alias("mean"), (F.var_pop(x).over(over) * F.count(x).over(over)).alias("m2"), F.min(x).over(over).alias("min"), F.max(x).over(over).alias("max"))


def row_framed(df: DataFrame, frames: dict[str, RowFrame], seconds: float = SEGMENT) -> DataFrame:
    """df with a column for each frame, at the same cost for frames of any length.

    A series is cut into blocks as long as a frame. A frame is the end of one block and the beginning
    of the next, so it is made of two states: what the block before tells from some row to its end, and
    what a row's own block tells up to it. Both run over single blocks, and each block is brought to the
    next one's task for one look back."""
    out = df
    for rows in sorted({f.rows for f in frames.values()}):
        some = {name: f for name, f in frames.items() if f.rows == rows}
        columns = sorted({f.column for f in some.values()})
        placed = _placed(scan(out, {_P: place()}, seconds), seconds).withColumn(_S, F.floor((F.col(_P) - 1) / rows))
        upto, onto = (Window.partitionBy(_K, _S).orderBy(o(_P)) for o in (F.asc, F.desc))
        placed = placed.withColumns({f"_upto_{k}": _state(c, upto) for k, c in enumerate(columns)} | {f"_from_{k}": _state(c, onto) for k, c in enumerate(columns)})
        both = placed.withColumn("_own", F.col(_S)).withColumn(_S, F.explode(F.array(F.col(_S), F.col(_S) + 1)))
        back = Window.partitionBy(_K, _S).orderBy(_P)
        both = both.withColumns({f"_from_{k}": F.lag(f"_from_{k}", rows - 1).over(back) for k in range(len(columns))} if rows > 1 else {}).where(F.col(_S) == F.col("_own"))
        made = {name: _of_frame(f, columns.index(f.column)) for name, f in some.items()}
        out = both.select(*[F.col(f"`{c}`") for c in out.columns if c not in made], *[x.alias(name) for name, x in made.items()])
    return out.select(*[F.col(f"`{c}`") for c in [*[c for c in df.columns if c not in frames], *frames]])


def _of_frame(f: RowFrame, k: int) -> Column:
    a, b = F.col(f"_from_{k}"), F.col(f"_upto_{k}")
    whole = F.col(_P) % f.rows == 0  # the frame is the row's own block
    n = F.when(whole, b["n"]).otherwise(a["n"] + b["n"])
    if f.how in ("min", "max"):
        value = F.when(whole, b[f.how]).otherwise((F.least if f.how == "min" else F.greatest)(a[f.how], b[f.how]))
    elif f.how == "mean":
        value = F.when(whole, b["mean"]).otherwise((a["n"] * a["mean"] + b["n"] * b["mean"]) / n)
    else:
        apart = a["mean"] - b["mean"]
        squares = F.when(whole, b["m2"]).otherwise(a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n)
        value = F.sqrt(F.try_divide(squares, n - 1))
    return F.when((F.col(_P) >= f.rows) & (n == f.rows), value)


def asof(probes: DataFrame, builds: DataFrame, probe_time: Column, forward: bool, tolerance_seconds: float | None, value: str, as_value: str, as_time: str, seconds: float = SEGMENT) -> DataFrame:
    """probes with the value and time of the nearest build row of their generator at or after
    (forward) or at or before probe_time. Of build rows at one time, forward takes the first and
    backward the last.

    Both sides are dealt by generator and segment of time. Where a segment has no build row on the
    right side of a probe, that of the nearest segment that has one is carried to it."""
    width = int(seconds * 1_000_000)
    dealt = [F.coalesce(F.concat(F.lit("="), F.col(KEY).cast("string")), F.lit("")).alias(_K), F.coalesce(F.floor(F.col("_t") / width), F.lit(-(1 << 62))).alias(_S)]
    nothing = F.lit(None)
    rows = probes.withColumn("_probe", F.struct(*[F.col(f"`{c}`") for c in probes.columns])).withColumn("_t", micros(probe_time))
    sides = rows.select(*dealt, "_t", nothing.cast("struct<t:bigint,r:bigint,v:double>").alias("_hit"), "_probe")
    hit = F.struct(micros().alias("t"), F.col(ROW).cast("bigint").alias("r"), F.col(value).cast("double").alias("v"))
    found = builds.where(F.col(TIME).isNotNull()).withColumns({"_t": micros(), "_hit": hit})
    both = sides.unionByName(found.select(*dealt, "_t", "_hit", nothing.cast(sides.schema["_probe"].dataType).alias("_probe")))
    edge = (F.min if forward else F.max)(F.when(F.col("_hit").isNotNull(), F.struct("_hit.t", "_hit.r", "_hit.v"))).alias("_edge")
    carries = both.groupBy(_K, _S).agg(edge).withColumn("_carried", F.last("_edge", True).over(_segments(forward))).select(_K, _S, "_carried")
    is_probe = F.col("_probe").isNotNull()
    order = [F.desc("_t"), is_probe, F.desc("_hit.r")] if forward else [F.asc("_t"), is_probe, F.asc("_hit.r")]
    near = F.last("_hit", True).over(so_far(Window.partitionBy(_K, _S).orderBy(*order)))
    out = both.withColumn("_near", near).where(is_probe).join(carries, [_K, _S]).withColumn("_hit", F.when(F.col("_t").isNotNull(), F.coalesce("_near", "_carried")))
    if tolerance_seconds is not None:
        out = out.withColumn("_hit", F.when(F.abs(F.col("_hit.t") - F.col("_t")) <= int(tolerance_seconds * 1e6), F.col("_hit")))
    return out.select("_probe.*", F.col("_hit.v").alias(as_value), F.col("_hit.t").alias(as_time))
