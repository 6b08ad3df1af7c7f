import pytest
from pyspark.sql import functions as F

from genpulse.functions import fingerprint as fp
from genpulse.operators import dashboard, forecast, states
from genpulse.plans import catalog

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect()))


def test_states_of_appends_equal_a_full_recomputation(spark, tmp_path):
    scored = catalog.healthy(spark, SF)
    table, store = str(tmp_path / "scored"), states.DashboardStore(spark, str(tmp_path / "store"))
    for part, files in (("row_id % 4 = 1", 1), ("row_id % 4 <> 1", 2)):
        scored.where(part).repartition(files).write.mode("append").parquet(table)
        assert store.append(table) == files and store.append(table) == 0
        whole = spark.read.parquet(table)
        same(states.fleet(store.states()), dashboard.fleet(whole))
        same(states.health_histogram(store.states()), dashboard.health_histogram(whole))
        same(states.fuel_page(store.states()), dashboard.fuel_page(whole))
    assert store.taken().count() == 3


def test_an_append_that_broke_off_counts_for_nothing(spark, tmp_path):
    scored = catalog.healthy(spark, SF)
    table, store = str(tmp_path / "scored"), states.DashboardStore(spark, str(tmp_path / "store"))
    scored.write.parquet(table)
    # states were written, but not the list of their files
    states.states(scored).withColumn("batch", F.lit("lost")).write.parquet(str(tmp_path / "store" / "states"))
    store.append(table)
    same(states.fleet(store.states()), dashboard.fleet(scored))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).selectExpr("id", "if(id % 7 = 0, NULL, cast(id % 90 AS double)) AS x", "if(id % 5 = 0, NULL, concat('t', id % 13)) AS `a b`").repartition(3)


def test_equal_tables_settle_by_their_fingerprints(spark, rows):
    assert fp.differing_ranges(rows, rows.orderBy(F.desc("id"))) == []
    assert fp.differences(rows, rows).count() == 0
    assert tuple(forecast.multiset_difference(rows.drop("id"), rows.drop("id")).first()) == (0, 0)


def test_one_changed_row_is_found_and_its_range_alone_compared(spark, rows):
    changed = rows.withColumn("x", F.when(F.col("id") == 4321, -1.0).otherwise(F.col("x")))
    assert 1 <= len(fp.differing_ranges(rows, changed)) <= 2
    assert {(r.id, r.x, r.n_a, r.n_b) for r in fp.differences(rows, changed).collect()} == {(4321, 4321 % 90, 1, 0), (4321, -1.0, 0, 1)}


def test_repeats_and_nulls_in_other_columns_count(spark):
    schema = "p string, q string"
    a, b = spark.createDataFrame([("v", None), ("w", "w"), ("w", "w")], schema), spark.createDataFrame([(None, "v"), ("w", "w")], schema)
    assert {(r.p, r.q, r.n_a, r.n_b) for r in fp.differences(a, b).collect()} == {("v", None, 1, 0), (None, "v", 0, 1), ("w", "w", 2, 1)}
    assert tuple(forecast.multiset_difference(a, b).first()) == (2, 1)
