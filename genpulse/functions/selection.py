"""Exact order statistics of groups of any size, without holding or sorting a group.

The wanted ranks of a group begin in one region, the range of its values. A round cuts each region
that is still large into BUCKETS ranges of equal width, and counts the rows of each with their
least and greatest value: partial counts in each task, so a round shuffles at most that many rows
for each region and task. The counts say which range holds a rank, and that is its next region.
The bucket of a value never falls as the value rises, also after rounding, so counts are exact; the
least and greatest value of a region are in different buckets, so every round gets on. The first
round cuts by logarithm, which leaves few rounds whatever the range of a double.

A region of one value, however often it occurs, is settled. Regions of few rows are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Ranges that a region is cut into; rows of a region that is gathered.
BUCKETS, SMALL = 4096, 1 << 16
#: Regions that may be broadcast; more meet the rows by a shuffle.
BROADCAST = 10_000
_INFINITE = float("inf")


def _finite(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != _INFINITE), x)


def _spread(x: Column) -> Column:
    """A value that rises with x, about in proportion to the logarithm of its size."""
    return F.signum(x) * F.log1p(F.abs(x))


def _met(values: DataFrame, regions: DataFrame, by: list[str]) -> DataFrame:
    """Rows with the region that they lie in; the regions of a group do not overlap."""
    few = regions.limit(BROADCAST + 1).count() <= BROADCAST
    renamed = regions.select(*[F.col(c).alias(f"_of_{c}") for c in by], *[c for c in regions.columns if c not in by])
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + [F.col("_x") >= F.col("_lo"), F.col("_x") <= F.col("_hi")]
    return values.join(F.broadcast(renamed) if few else renamed, same).drop(*[f"_of_{c}" for c in by])


def _bucket(first: bool) -> Column:
    scaled = (lambda c: _spread(F.col(c))) if first else F.col
    lo, hi = scaled("_from"), scaled("_to")
    inside = F.least(F.lit(BUCKETS - 1.0), F.floor((scaled("_x") - lo) / (hi - lo) * BUCKETS).cast("double"))
    inside = F.when(lo < hi, F.greatest(F.lit(0.0), inside)).otherwise(0.0)
    return F.when(F.isnan("_x"), BUCKETS + 1.0).when(F.col("_x") == _INFINITE, float(BUCKETS)).when(F.col("_x") == -_INFINITE, -1.0).otherwise(inside)


def order_statistics(values: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """(by, rank, x) for wanted (by, rank): the value of each 0-based rank of the doubles x of each
    group of values (by, x), which holds no null and has more rows than the rank."""
    values = values.select(*by, F.col("x").alias("_x"))
    ends = values.groupBy(*by).agg(
        F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_size"), F.min(_finite(F.col("_x"))).alias("_from"), F.max(_finite(F.col("_x"))).alias("_to")
    )
    ends = ends.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    state = wanted.join(ends, same).select(*by, "rank", "_lo", "_hi", "_from", "_to", "_size", F.lit(0).cast("long").alias("_below"))
    state, first = stored(state, "ranks"), True
    large = (F.col("_lo") < F.col("_hi")) & (F.col("_size") > SMALL)
    while state.where(large).limit(1).count():
        regions = state.where(large).select(*by, "_lo", "_hi", "_from", "_to", "_below").distinct()
        rows = _met(values, regions, by).withColumn("_bucket", _bucket(first))
        counts = rows.groupBy(*by, "_below", "_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("least"), F.max("_x").alias("most"))
        upto = Window.partitionBy(*by, "_below").orderBy("_bucket")
        counts = counts.withColumn("before", F.col("_below") + F.sum("n").over(upto) - F.col("n")).drop("_bucket")
        counts = counts.withColumnsRenamed({c: f"_of_{c}" for c in by} | {"_below": "_was"})
        here = [*same, F.col("_below") == F.col("_was"), F.col("rank") >= F.col("before"), F.col("rank") < F.col("before") + F.col("n")]
        moved = state.where(large).join(counts, here).select(*by, "rank", F.col("least").alias("_lo"), F.col("most").alias("_hi"), F.col("least").alias("_from"), F.col("most").alias("_to"), F.col("n").alias("_size"), F.col("before").alias("_below"))
        state, first = stored(state.where(~large).unionByName(moved), "ranks"), False
    one = F.col("_lo") < F.col("_hi")
    settled = state.where(~one).select(*by, "rank", F.col("_lo").alias("x"))
    few = state.where(one)
    gathered = _met(values, few.select(*by, "_lo", "_hi", "_below").distinct(), by).groupBy(*by, "_below").agg(F.sort_array(F.collect_list("_x")).alias("_all"))
    gathered = gathered.withColumnsRenamed({c: f"_of_{c}" for c in by} | {"_below": "_was"})
    found = few.join(gathered, [*same, F.col("_below") == F.col("_was")]).select(*by, "rank", F.element_at("_all", (F.col("rank") - F.col("_below") + 1).cast("int")).alias("x"))
    return settled.unionByName(found)


def percentiles(df: DataFrame, value: str | Column, marks: list[float], by: list[str] | None = None) -> DataFrame:
    """(by, q) with the exact percentiles of value at marks (0 to 1) of each group, in line between
    neighbouring ranks as percentile() has it. Nulls are left out, and groups without values too;
    NaN is the greatest value. Where no group has more than SMALL rows, percentile() holds them as they are."""
    groups = by or ["_all_rows"]
    x = F.col(value) if isinstance(value, str) else value
    rows = df.select(*(by or [F.lit(0).alias("_all_rows")]), x.cast("double").alias("x"))
    rows, at = rows.where("x IS NOT NULL"), F.array(*[F.lit(float(m)) for m in marks])
    if (rows.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0) <= SMALL:
        held = rows.groupBy(*groups).agg(F.percentile("x", at).alias("q"))
        return held if by else held.drop("_all_rows")
    values = stored(rows, "values")
    sizes = values.groupBy(*groups).agg((F.count(F.lit(1)) - 1).alias("_last"))
    places = sizes.select(*groups, F.posexplode(F.transform(at, lambda m: m * F.col("_last"))).alias("_k", "_at"))
    places = stored(places, "places")
    ranks = places.select(*groups, F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("rank")).distinct()
    found = stored(order_statistics(values, ranks, groups), "order-statistics")
    side = lambda s: found.select(*[F.col(c).alias(f"{s}_{c}") for c in groups], F.col("rank").alias(f"{s}_rank"), F.col("x").alias(f"{s}_x"))
    equal = lambda s, rank: [F.col(c).eqNullSafe(F.col(f"{s}_{c}")) for c in groups] + [rank == F.col(f"{s}_rank")]
    both = places.join(side("a"), equal("a", F.floor("_at"))).join(side("b"), equal("b", F.ceil("_at")))
    weight = F.col("_at") - F.floor("_at")
    q = F.when((F.col("a_x") == F.col("b_x")) | (weight == 0), F.col("a_x")).otherwise((F.ceil("_at") - F.col("_at")) * F.col("a_x") + weight * F.col("b_x"))
    listed = both.groupBy(*groups).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", q.alias("q")))), lambda s: s["q"]).alias("q"))
    return listed if by else listed.drop("_all_rows")


def at_places(df: DataFrame, value: Column, places: list[int]) -> list[float]:
    """The values at 1-based places in the order of value, nulls left out: one for each place."""
    values = stored(df.select(F.lit(0).alias("g"), value.cast("double").alias("x")).where("x IS NOT NULL"), "values")
    wanted = df.sparkSession.createDataFrame([(0, p - 1) for p in sorted(set(places))], "g int, rank long")
    found = {r.rank + 1: r.x for r in order_statistics(values, wanted, ["g"]).collect()}
    return [found[p] for p in places]
