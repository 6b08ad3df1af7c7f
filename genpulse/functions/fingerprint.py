"""Fingerprints of tables that do not depend on the order of rows.

A row is two 64-bit hashes; a range of rows, those whose hash falls on one number, is the sums of
both and the number of rows. Sums of parts add up, so tasks sum what they read, and two tables meet
as one row for each range. Equal sums mean equal multisets of rows but for a chance of about 2**-64
for each range, and only the rows of ranges that differ are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges of a table's rows.
RANGES = 4096


def _hash(columns: list[str], seed: int) -> Column:
    # a null is hashed as a value of its own: by itself it would leave the hash as it was
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def _range(columns: list[str], ranges: int) -> Column:
    return F.pmod(_hash(columns, 1), F.lit(ranges)).cast("int")


def fingerprint(df: DataFrame, columns: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """(range, n, sum_1, sum_2) of the ranges that have rows."""
    columns = columns or df.columns
    whole = lambda seed: F.sum(_hash(columns, seed).cast("decimal(20,0)"))
    return df.groupBy(_range(columns, ranges).alias("range")).agg(F.count(F.lit(1)).alias("n"), whole(2).alias("sum_1"), whole(3).alias("sum_2"))


def differing_ranges(a: DataFrame, b: DataFrame, ranges: int = RANGES) -> list[int]:
    """Ranges in which the tables hold different rows, by the columns of a: at most `ranges` numbers."""
    columns = a.columns
    left, right = (fingerprint(df.select(*[f"`{c}`" for c in columns]), columns, ranges).select("range", F.struct("n", "sum_1", "sum_2").alias(name)) for df, name in ((a, "of_a"), (b, "of_b")))
    both = left.join(right, "range", "full_outer").where(~F.col("of_a").eqNullSafe(F.col("of_b")))
    return sorted(r.range for r in both.select("range").collect())


def differences(a: DataFrame, b: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The rows, with n_a and n_b, that do not occur equally often in both tables; none where the
    tables are equal. Only rows of ranges that differ are shuffled."""
    columns = [f"`{c}`" for c in a.columns]
    changed = differing_ranges(a, b, ranges)
    here = _range(a.columns, ranges).isin(changed) if changed else F.lit(False)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = a.select(*columns).where(here).withColumns({"n_a": one, "n_b": none}).unionAll(b.select(*columns).where(here).withColumns({"n_a": none, "n_b": one}))
    return rows.groupBy(*columns).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b")).where("n_a <> n_b")
