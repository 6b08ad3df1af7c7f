import numpy as np
import pytest
from helpers import same_as_duckdb
from pyspark.sql import functions as F

from genpulse.llm import hard_negatives as hn
from genpulse.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, score long, x string, cell int"


def brute(rows, anchors):
    kept = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is not None and label is not None and vector is not None and all(v is not None and np.isfinite(v) for v in vector):
            kept[vec_id] = (label, [int(np.floor(256 * float(np.float32(v)))) for v in vector])
    out = []
    for a in (a for a in kept if a % anchors == 0):
        scored = [(-sum(p * q for p, q in zip(kept[a][1], x)), i, label) for i, (label, x) in kept.items() if i != a]
        for s, p, _ in sorted(x for x in scored if x[2] == kept[a][0])[:5]:
            inside = sorted(x for x in scored if x[2] != kept[a][0] and 30 * -s <= 100 * -x[0] <= 90 * -s)
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(inside[:10], 1)]
    return sorted(out)


def table(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def some_rows(seed, n, dim, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[:copies] = x[0]
    labels = rng.integers(3, size=n)
    return [(int(i), x[i].tolist(), int(labels[i]), 1, "x", 2) for i in range(n)]


@pytest.mark.parametrize("n,dim,copies", [(300, 16, 0), (240, 7, 90), (9, 3, 0)])
def test_negatives_against_brute_force(spark, monkeypatch, n, dim, copies):
    for name, value in {"ROW_BLOCK": 50, "ANCHOR_BLOCK": 4, "ROWS": 16, "ANCHORS": 3}.items():
        monkeypatch.setattr(hn, name, value)
    rows = some_rows(n, n, dim, copies)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert table(hn.hard_negatives(df, F.col("vec_id") % 10 == 0, sample=32)) == brute(rows, 10)


def test_odd_rows_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROW_BLOCK", 20)
    nan, inf = float("nan"), float("inf")
    rows = some_rows(1, 60, 4)
    odd = [(70, None, 1), (80, [1.0, None, 1.0, 1.0], 1), (90, [nan] * 4, 1), (100, [1.0, -inf, 0.0, 0.0], 1), (110, [1.0] * 4, None), (None, [1.0] * 4, 1), (120, [3e38] * 4, 1)]
    df = spark.createDataFrame(rows + [(*r, 1, "x", 2) for r in odd], SCHEMA)
    assert table(hn.hard_negatives(df, F.col("vec_id") % 10 == 0)) == brute(rows, 10)
    assert hn.hard_negatives(df.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_shorter_vectors_and_repeated_anchors(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0], 2), (3, [], 2), (4, [0.5, 0.5], 2)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    assert table(hn.hard_negatives(df, F.col("vec_id") == 0)) == [(0, 1, 1, 2, 131072, 65536), (0, 1, 2, 4, 131072, 65536)]


def test_bounds_hold_whatever_the_centres_and_narrow_the_search():
    rng = np.random.default_rng(3)
    x, a = (rng.normal(size=(n, 64)) * 60 for n in (2000, 20))
    x, a = np.floor(x).astype(np.int64), np.floor(a).astype(np.int64)
    exact = a @ x.T
    for sample in (x[:1500], x[:3], np.zeros((1, 64), np.int64)):
        book = hn.Codebook(sample)
        least, most = book.bounds(a, *book.encode(x))
        assert (least <= exact).all() and (exact <= most).all()
    book = hn.Codebook(x[:1500])
    least, most = book.bounds(a, *book.encode(x))
    left = [len(hn.Top(5).wanted(low, high)) for low, high in zip(least, most)]
    assert np.mean(left) < 200


def test_query_matches_its_sql(spark):
    same_as_duckdb(spark, "/root/testdata/sf0.001", queries.QUERIES["op11_quantised_negatives"], queries.ORACLES["op11_quantised_negatives"])
