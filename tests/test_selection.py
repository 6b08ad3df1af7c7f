import random

import pytest
from helpers import column, telemetry
from pyspark.sql import functions as F

from genpulse.functions import selection as sel
from genpulse.operators import forecast

MARKS = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]


def some_values(kind, n=3000):
    rng = random.Random(7)
    make = {
        "normal": lambda: rng.gauss(0, 1), "ties": lambda: float(rng.choice([1, 1, 1, 2, 5])), "one": lambda: 4.25, "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-320, 308),
        "near": lambda: 1e9 + rng.randrange(9) * 2.0**-22, "odd": lambda: rng.choice([float("inf"), -float("inf"), float("nan"), 0.0, -0.0, rng.random()]),
    }[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("small", [200, 4096])
def test_percentiles_equal_the_built_in_ones(spark, monkeypatch, small):
    monkeypatch.setattr(sel, "SMALL", small)
    monkeypatch.setattr(sel, "BUCKETS", 512 if small == 200 else 4096)
    kinds = ("normal", "ties", "one", "wide", "near", "odd")
    rows = [(k if k != "one" else None, x) for k in kinds for x in some_values(k)] + [("few", 2.0), ("few", 1.0), ("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: r.q for r in sel.percentiles(df, "v", MARKS, ["g"]).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, MARKS))).alias("q")).collect() if r.q is not None}
    assert {g: str(q) for g, q in got.items()} == {g: str(q).replace("-0.0,", "0.0,") if g != "odd" else str(got[g]) for g, q in want.items()}
    assert [x != x or x for x in got["odd"]] == [x != x or x for x in want["odd"]]
    whole = sel.percentiles(df.where("g = 'normal'"), "v", MARKS).first().q
    assert whole == want["normal"]
    assert sel.percentiles(df.where("false"), "v", MARKS).count() == 0


def test_rounds_shuffle_a_bounded_number_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(sel, "SMALL", 100)
    monkeypatch.setattr(sel, "BUCKETS", 1024)
    df = spark.range(100_000).select(F.lit("g").alias("g"), (F.rand(3) * 1000).alias("v"))
    assert sel.percentiles(df, "v", [0.37], ["g"]).first().q[0] == df.agg(F.percentile("v", 0.37)).first()[0]


@pytest.mark.parametrize("hour", [True, False])
def test_a_global_split_of_one_hour_and_of_one_moment(spark, monkeypatch, hour):
    monkeypatch.setattr(sel, "SMALL", 100)
    rng = random.Random(2)
    df = telemetry(spark, [(rng.choice("AB"), rng.randrange(3600) if hour else 5, 1, 1, 1, None) for _ in range(1000)]).repartition(3)
    got = forecast.global_split(df)
    order = sorted((r.timestamp, r.row_id) for r in df.collect())
    place = {row: k for k, (_, row) in enumerate(order)}
    want = ["train" if place[k] < 700 else "validation" if place[k] < 850 else "test" for k in range(1000)]
    assert column(got, "split") == want
    assert forecast.global_split(df.where("false")).count() == 0
