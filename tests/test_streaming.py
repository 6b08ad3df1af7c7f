from helpers import telemetry

from genpulse.streaming import events


def run(spark, made, name, mode="append"):
    q = made.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streams(spark, tmp_path):
    rows = [("G", t, 1.0, None, None, None) for t in (0, 60, 60, 400, 7200)]
    path = str(tmp_path / "in")
    telemetry(spark, rows).write.parquet(path)
    stream = lambda: spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    assert run(spark, events.without_repeats(stream()), "once").count() == 4
    counts = {r.start.minute: r.n for r in run(spark, events.packet_counts(stream()), "counts").where("hour(start) = 0").collect()}
    assert counts == {0: 3, 5: 1}
    assert [r.n for r in run(spark, events.sessions(stream()), "sessions").where("hour(start) = 0").orderBy("start").collect()] == [3, 1]


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_gaps_are_told_while_open_and_equal_the_batch_after_a_restart(spark, tmp_path):
    from genpulse.operators import profile
    from genpulse.streaming import gaps

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    minute = lambda g, *ms: [(g, 60 * m, 1.0, None, None, None) for m in ms]
    # readings out of order within the watermark's delay, also from file to file
    first = minute("A", 0, 2, 1, 30, 5) + minute("B", 0, 1, 2, 3)
    second = minute("A", 31, 29, 60, 61) + minute("B", 90, 60)
    third = minute("A", 120, 121, 1) + minute("B", 119, 120, 130) + minute("C", 129, 500)

    def grown(rows):
        telemetry(spark, rows).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(telemetry(spark, rows).schema).parquet(path)
        told = gaps.watched_gaps(stream, 4, "5 minutes", {"B": 20})
        q = told.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(180)
        return {(r.generator_id, r.kind, r.gap_start_us // 60_000_000 % 1440, r.gap_minutes) for r in spark.read.parquet(out).collect()}

    assert grown(first) == {("A", "open", 5, None), ("B", "open", 3, None)}
    assert grown(second) >= {("A", "ended", 5, 24.0), ("A", "ended", 31, 29.0), ("A", "open", 61, None), ("B", "ended", 3, 57.0), ("B", "open", 60, None)}
    told = grown(third)
    rows = telemetry(spark, first + second + [r for r in third if r[:2] != ("A", 60)])  # behind the watermark by then
    want = {(r.generator_id, r.gap_minutes) for g, m in (("A", 4), ("B", 20)) for r in profile.gap_events(rows.where(f"generator_id = '{g}'"), m).collect()}
    assert {(g, m) for g, kind, _, m in told if kind == "ended" and g != "C"} == want
    assert ("C", "ended", 129, 371.0) not in told  # the watermark has not passed its end
