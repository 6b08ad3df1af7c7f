import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from genpulse.functions.gram import correlations


def test_correlations_of_two_hundred_columns_against_pandas(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 200)) + 1e6 * rng.normal(size=200)
    x[:, 1] = 2 * x[:, 0] + 1
    x[:, 5] = 7.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = np.nan
    x[:299, 8] = np.nan
    x[3, 9] = np.inf
    names = [f"a.{k}" if k == 2 else f"c{k}" for k in range(200)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(3)
    want = pd.DataFrame(np.where(np.isinf(x), np.nan, x), columns=names).corr()
    got = {(r.a, r.b): r.correlation for r in correlations(df.toDF(*[n.replace(".", "_") for n in names]), [n.replace(".", "_") for n in names]).collect()}
    off = 0
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            r, w = got.get((a.replace(".", "_"), b.replace(".", "_"))), want.loc[a, b]
            if a in ("c5",) or b in ("c5", "c8") or a == "c8":
                assert r is None or "c8" in (a, b) or "c5" in (a, b)
            elif np.isnan(w):
                assert r is None
            else:
                assert r == pytest.approx(w, abs=1e-6)
                off += 1
    assert off > 19_000


def test_pairs_without_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, None, 5.0)], "a double, b double, c double")
    assert [tuple(r) for r in correlations(df, ["a", "b", "c"]).collect()] == [("a", "c", 2, pytest.approx(1.0))]
    assert correlations(df.where("false"), ["a", "b"]).count() == correlations(df, ["a"]).count() == correlations(df.select(F.lit(1).alias("x")), []).count() == 0
