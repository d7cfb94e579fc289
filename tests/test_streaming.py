import pytest
from pyspark.sql import functions as F

from tests.helpers import START, period
from wattline.streaming import features, ingest, runner

READING = "region_id long, settlement_period timestamp, carbon_intensity long, wind double, solar double"


@pytest.fixture
def paths(tmp_path):
    return lambda name: str(tmp_path / name)


def test_malformed_messages_go_to_the_dead_letter_table(spark, paths):
    schema = "id long, ts timestamp"
    handle = ingest.dead_letter_handler(schema, ["id"], paths("good"), paths("dead"))

    def send(*texts):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(paths("topic"))
        stream = runner.file_stream(spark, paths("topic"), "value string", "text")
        runner.run_batches(stream, handle, paths("checkpoint"))

    send('{"id": 1, "ts": "2024-01-01T00:00:00Z"}', "{broken", '{"ts": "2024-01-01T00:00:00Z"}')
    send('{"id": 2}', '{"id": "x"}')
    assert sorted(r["id"] for r in runner.read_batches(spark, paths("good")).collect()) == [1, 2]
    assert sorted(r["raw"] for r in runner.read_batches(spark, paths("dead")).collect()) == sorted(
        ["{broken", '{"ts": "2024-01-01T00:00:00Z"}', '{"id": "x"}']
    )


def test_dedupe_and_late_rows_across_restarts(spark, paths):
    schema = "id long, ts timestamp"

    def send(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(paths("in"))
        stream = ingest.dedupe(runner.file_stream(spark, paths("in"), schema), ["id"], "ts", "1 hour")
        runner.run_batches(stream, runner.batch_writer(paths("out")), paths("checkpoint"))

    send((1, period(0)), (1, period(0)), (2, period(10)))
    send((2, period(11)), (3, period(12)))
    send((4, period(0)))  # long behind the watermark
    assert sorted(r["id"] for r in runner.read_batches(spark, paths("out")).collect()) == [1, 2, 3]


def test_tumbling_updates_replace_earlier_results(spark, paths):
    schema = "k long, ts timestamp, v long"

    def send(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(paths("in"))
        sums = ingest.tumbling(runner.file_stream(spark, paths("in"), schema), "ts", {"v": F.sum("v")}, ["k"])
        return runner.run_batches(sums, runner.batch_writer(paths("out")), paths("checkpoint"), "update", progress_path=paths("log"))

    send((1, period(0), 1), (1, period(1), 5))
    send((1, period(0), 2))
    got = runner.read_latest(spark, paths("out"), ["k", "settlement_period"]).orderBy("settlement_period").collect()
    assert [r["v"] for r in got] == [3, 5]
    assert [r["input_rows"] for r in runner.progress(spark, paths("log")).filter("input_rows > 0").orderBy("batch_id").collect()] == [2, 1]


def test_progress_of_every_batch_is_kept(spark, paths, monkeypatch):
    monkeypatch.setattr(runner, "EVENTS", 4)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    spark.range(110).repartitionByRange(11, "id").write.parquet(paths("in"))
    stream = runner.file_stream(spark, paths("in"), "id long", files_per_batch=1)
    query = runner.run_batches(stream, runner.batch_writer(paths("out")), paths("checkpoint"), progress_path=paths("log"))
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    kept = runner.progress(spark, paths("log")).filter("input_rows > 0").collect()
    assert len(query.recentProgress) <= 3 and sorted(r["batch_id"] for r in kept) == list(range(11))
    assert sum(r["input_rows"] for r in kept) == 110 and all(r["took_ms"] >= 0 for r in kept)


def readings(spark, ids):
    return spark.createDataFrame([(r, period(i), (i * 7 + r) % 90, float(i % 11), float(i % 5)) for r, i in ids], READING)


def test_online_features_equal_the_batch_result(spark, paths):
    """A gap, a late reading, a correction and a second region, over several micro-batches."""
    handle = features.feature_handler(spark, paths("store"), paths("features"), ["region_id"])

    def send(df):
        df.coalesce(1).write.mode("append").parquet(paths("in"))
        stream = runner.file_stream(spark, paths("in"), READING)
        runner.run_batches(stream, handle, paths("checkpoint"))

    send(readings(spark, [(1, i) for i in range(500) if i not in (40, 41)]))
    send(readings(spark, [(1, i) for i in range(2000, 2100)] + [(2, i) for i in range(2050, 2100)]))
    send(readings(spark, [(1, 40)]))
    fix = readings(spark, [(1, 2090)]).withColumn("carbon_intensity", F.lit(500).cast("long"))
    send(fix)
    everything = readings(
        spark, [(1, i) for i in range(500) if i not in (41, 2090)] + [(1, i) for i in range(2000, 2100) if i != 2090]
        + [(2, i) for i in range(2050, 2100)]
    ).unionByName(fix)
    expected = features.online_features(everything, ["region_id"])
    got = runner.read_latest(spark, paths("features"), ["region_id", "settlement_period"])
    keys = ["region_id", "settlement_period"]
    columns = [*keys, "carbon_intensity", "lag_1", "lag_336", "wind_7d_avg", "carbon_24h_avg", "hour_of_day"]
    a, b = (x.select(columns).orderBy(*keys).toPandas() for x in (got, expected))
    assert len(a) == len(b) == 500 - 1 + 100 + 50
    for c in columns:
        assert a[c].equals(b[c]) or ((a[c] - b[c]).abs().max() < 1e-9 and (a[c].isna() == b[c].isna()).all()), c


def test_replayed_batch_changes_nothing(spark, paths):
    handle = runner.batch_writer(paths("out"))
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    for _ in range(2):
        handle(df, 0)
    assert runner.read_batches(spark, paths("out")).count() == 1
    assert runner.read_batches(spark, paths("nothing")) is None


def test_schedules_follow_new_sessions(spark, paths):
    forecast = spark.createDataFrame([(1, period(i), float(c), 10.0) for i, c in enumerate([9, 1])],
                                     "region_id long, slot timestamp, carbon_intensity double, price double")
    schema = "session_id string, region_id long, arrival_time timestamp, departure_time timestamp, energy_kwh double"
    spark.createDataFrame([("a", 1, START, period(2), 1.0)], schema).write.parquet(paths("in"))
    handle = features.schedule_handler(paths("out"), lambda: forecast, 2.0)
    runner.run_batches(runner.file_stream(spark, paths("in"), schema), handle, paths("checkpoint"))
    assert runner.read_latest(spark, paths("out"), ["session_id"]).first()["carbon_saving_g"] == pytest.approx(8.0)
