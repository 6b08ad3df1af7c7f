import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from genpulse.operators import boosting as gb
from genpulse.operators import forecast

NAMES = ["a", "b", "c"]


def some_rows(spark, n=2000, seed=0):
    """y rises with a where a is known, and where it is missing it is high; c says nothing."""
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(4, size=n).astype(float), rng.normal(size=n)
    y = np.where(a > 0.3, 10.0, 0.0) + 3 * b + rng.normal(scale=0.1, size=n)
    lost = rng.random(n) < 0.2
    y = np.where(lost, 20.0 + 3 * b, y)
    rows = [(k, None if lost[k] else float(a[k]), float(b[k]), float(c[k]), float(y[k])) for k in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


def fitted(df, validation=None, **settings):
    return gb.fit(df, NAMES, "y", gb.Settings(**{"trees": 40, "rate": 0.3, "depth": 3, "rows": 1.0, "columns": 1.0} | settings), validation, ("id",))


def error(model, df):
    return model.predict(df).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]


def test_splits_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        nodes, columns, bins, n = 3, 4, 6, 120
        x, node, g = rng.integers(bins, size=(n, columns)), rng.integers(nodes, size=n), rng.normal(size=n)
        sums, counts = np.zeros((nodes, columns, bins)), np.zeros((nodes, columns, bins))
        for k in range(columns):
            np.add.at(sums, (node, k, x[:, k]), g)
            np.add.at(counts, (node, k, x[:, k]), 1)
        gain, feature, cut, missing_left = gb.best_splits(sums, counts, 5, 1.0)
        for m in range(nodes):
            score = lambda rows: g[rows].sum() ** 2 / (rows.sum() + 1.0)
            here, best = node == m, 0.0
            for k in range(columns):
                for b in range(bins - 1):
                    for lost in (False, True):
                        left = here & (((x[:, k] <= b) & (x[:, k] < bins - 1)) | ((x[:, k] == bins - 1) & lost))
                        if left.sum() >= 5 and (here & ~left).sum() >= 5:
                            best = max(best, score(left) + score(here & ~left) - score(here))
            assert gain[m] == pytest.approx(best)
            if best:
                left = here & np.where(x[:, feature[m]] == bins - 1, missing_left[m], x[:, feature[m]] <= cut[m])
                assert score(left) + score(here & ~left) - score(here) == pytest.approx(best)


def test_missing_values_find_their_side(spark):
    df = some_rows(spark)
    model = fitted(df)
    assert error(model, df) < 0.3
    assert {r.feature for r in model.importances(spark, 2).collect()} == {"a", "b"}
    alone = gb.fit(df.select("id", "a", "y"), ["a"], "y", gb.Settings(trees=1, depth=1, rate=1.0, rows=1.0, columns=1.0), None, ("id",))
    low, high, lost = alone.values(np.array([[-1.0], [1.0], [np.nan]]))
    assert bool(alone.trees[0].missing_left[0]) == (abs(lost - low) < abs(lost - high)) and lost > alone.base


def test_equal_rows_give_equal_models_in_one_task_and_in_several(spark, monkeypatch):
    df = some_rows(spark, 1500)
    one = fitted(df, rows=0.7, columns=0.7)
    again = fitted(df.repartition(5), rows=0.7, columns=0.7)
    x = np.random.default_rng(5).normal(size=(200, 3))
    np.testing.assert_array_equal(one.values(x), again.values(x))
    monkeypatch.setattr(gb, "TASK_ROWS", 400)
    assert gb.prepared(df, None, NAMES, "y", ["id"]).tasks == 4
    np.testing.assert_allclose(one.values(x), fitted(df, rows=0.7, columns=0.7).values(x), rtol=1e-9)


def test_training_stops_after_the_least_validation_error(spark):
    df, held = some_rows(spark, 600), some_rows(spark, 300, 9)
    long, short = fitted(df, held, trees=150, depth=6), fitted(df, held, trees=150, depth=6, patience=5)
    least = min(long.errors, key=lambda e: (e[2], e[0]))
    assert len(long.trees) == 150 and len(short.trees) <= least[0] + 1 and short.errors[-1][2] == min(e[2] for e in short.errors)
    assert error(short, held) == pytest.approx(short.errors[-1][2])
    name, model, report = gb.tuned(df, held, NAMES, {"flat": gb.Settings(20, 0.3, 1), "deep": gb.Settings(20, 0.3, 4)}, "y", 5, ("id",))
    assert name == "deep" and {r[0] for r in report} == {"flat", "deep"} and error(model, held) == pytest.approx(dict((r[0], r[3]) for r in report)["deep"])


def test_no_worse_than_the_librarys_trees(spark):
    df, held = some_rows(spark, 1500), some_rows(spark, 500, 9)
    theirs = forecast.boosted_trees(df, NAMES, "y", trees=15, depth=4)
    ours = fitted(df, trees=15, depth=4, rate=0.3)
    off = forecast.predict(theirs, held, NAMES).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error(ours, held) <= off


def test_the_references_size_in_a_tests_time(spark):
    df, began = some_rows(spark, 20_000), time.perf_counter()
    model = gb.fit(df, NAMES, "y", gb.Settings(), None, ("id",))
    assert len(model.trees) == 500 and time.perf_counter() - began < 240
    assert error(model, df) < 0.2


def test_odd_tables(spark):
    df = some_rows(spark, 50)
    none = fitted(df.where("false"))
    assert none.trees == [] and none.predict(df).count() == 50
    odd = df.withColumns({"a": F.lit(None).cast("double"), "b": F.lit(float("nan")), "c": F.lit(1.0), "y": F.when(F.col("id") > 3, F.col("y"))})
    model = fitted(odd, trees=2)
    assert model.values(np.array([[np.nan] * 3]))[0] == pytest.approx(odd.agg(F.avg("y")).first()[0])


def one_row_at_a_time(model, row):
    """The sum of the leaves that a row comes to, node by node."""
    out = model.base
    for t in model.trees:
        at = 0
        while t.feature[at] >= 0:
            v = row[t.feature[at]]
            left = t.missing_left[at] if np.isnan(v) else v <= t.threshold[at]
            at = (t.left if left else t.right)[at]
        out += t.value[at]
    return out


def test_predictions_equal_walks_of_single_rows(spark, monkeypatch):
    monkeypatch.setattr(gb, "BLOCK", 64)
    model = fitted(some_rows(spark), trees=12, depth=5, rows=0.7, columns=0.7)
    assert any(np.isinf(t.threshold).any() for t in model.trees) or any(t.missing_left.any() for t in model.trees)
    x = np.random.default_rng(3).normal(size=(300, 3))
    x[np.random.default_rng(4).random(x.shape) < 0.3] = np.nan
    np.testing.assert_allclose(model.values(x), [one_row_at_a_time(model, row) for row in x], rtol=1e-12)
    assert gb.Model(NAMES, 2.0, []).values(x).tolist() == [2.0] * 300


@pytest.mark.parametrize("features", [3, 4])
def test_histograms_by_pairs_and_singly_equal_sums(monkeypatch, features):
    monkeypatch.setattr(gb, "BLOCK", 32)
    rng = np.random.default_rng(features)
    cuts = [np.arange(1.0, 2 + k) for k in range(features)]
    frame = pd.DataFrame({f"f{k}": rng.choice([np.nan, 0.5, 1.5, 2.5, 9.0], 200) for k in range(features)} | {"label": rng.normal(size=200), "key": np.arange(200), "held_out": rng.random(200) < 0.2})
    part = gb._Part(iter([frame[:90], frame[90:]]), cuts, None)
    at, chosen, columns = rng.integers(9, size=200).astype(np.int32), part.sampled(1, 0.8), np.array([0, 2])
    assert 0 < chosen.sum() < (~part.held).sum() and not chosen[part.held].any()
    for slots in (2, 8):
        place = np.where(np.arange(9) < slots, np.arange(9), -1).astype(np.int32)
        found = part.histograms(at, place, slots, part.y, chosen, columns)
        wanted = np.zeros_like(found)
        for k in np.flatnonzero(chosen & (at < slots)):
            for j, c in enumerate(columns):
                wanted[:, at[k], j, part.x[c, k]] += part.y[k], 1
        np.testing.assert_allclose(found, wanted, atol=1e-12)


def test_predictions_are_made_once_and_rows_hold_only_features(spark):
    from genpulse.plans import mechanisms

    rows = mechanisms.model_rows(spark, "/root/testdata/sf0.001")
    model = gb.fit(rows.where("split = 'train'"), mechanisms.FEATURES, settings=gb.Settings(trees=2))
    made = mechanisms.predicted(rows, model)
    assert "Python" not in made._jdf.queryExecution().toString() and made.where("prediction IS NULL").count() == 0
    assert made.count() == rows.where("split = 'test'").count()
