"""Correlations of all pairs of many columns, nulls left out pair by pair, from one pass.

Each task adds up five products of matrices over its rows: with X the values (0 where null) and M
which values are there, M'M counts the rows of a pair, X'M and (X^2)'M are the sums of one column
where the other is there, and X'X the sums of products. Tasks hand on a row for each pair, and pairs
are summed by a partial aggregate. So 200 columns take 19,900 rows of a task, and no plan of 19,900
expressions. Columns are centred first, so that large means cost no digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = "n double, sx double, sy double, sxx double, syy double, sxy double"


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, correlation) of each two of the columns, a before b in their order: over the rows
    where both have a finite value; null where these are fewer than two or do not vary. A pair without rows is left out."""
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "a string, b string, n long, correlation double")
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    values = df.select(*[finite(F.col(c).cast("double")).alias(f"c{k}") for k, c in enumerate(columns)])
    means = values.agg(*[F.coalesce(F.avg(f"c{k}"), F.lit(0.0)) for k in range(len(columns))]).first()
    centre, (i, j) = np.array(list(means), dtype=np.float64), np.triu_indices(len(columns), 1)

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, len(i)))
        for frame in frames:
            x = frame.to_numpy(dtype=np.float64, na_value=np.nan) - centre
            m = (~np.isnan(x)).astype(np.float64)
            x = np.where(m > 0, x, 0.0)
            one, square = x.T @ m, (x * x).T @ m
            for part, whole in zip(sums, (m.T @ m, one, one.T, square, square.T, x.T @ x)):
                part += whole[i, j]
        if sums.any():
            yield pd.DataFrame({"i": i, "j": j} | dict(zip(("n", "sx", "sy", "sxx", "syy", "sxy"), sums)))

    parts = values.mapInPandas(summed, f"i int, j int, {_SUMS}").groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    spread = F.expr("(n * sxx - sx * sx) * (n * syy - sy * sy)")
    value = F.when((F.col("n") > 1) & F.expr("n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0"), F.expr("n * sxy - sx * sy") / F.sqrt(spread))
    names = F.array(*[F.lit(c) for c in columns])
    return parts.where("n > 0").select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), F.col("n").cast("long").alias("n"), value.alias("correlation"))
