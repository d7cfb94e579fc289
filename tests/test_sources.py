import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import START, UTC, period
from wattline.functions import reference
from wattline.sources import files, payloads, ranges, tables


def text(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def test_intensity_payload(spark):
    entries = [
        {"from": f"2024-01-01T0{i // 2}:{'30' if i % 2 else '00'}Z", "intensity": {"forecast": 212 + i, "actual": a, "index": "moderate"}}
        for i, a in enumerate([210, 205, None])
    ]
    got = payloads.flatten_intensity(text(spark, {"data": entries}, {"data": []}, {}, "not json")).orderBy("settlement_period").collect()
    assert [(r["intensity_actual"], r["intensity_forecast"]) for r in got] == [(210, 212), (205, 213), (None, 214)]
    assert got[1]["settlement_period"].timestamp() == period(1).timestamp()
    assert payloads.flatten_intensity(text(spark)).schema["intensity_actual"].dataType.simpleString() == "int"


def test_regional_payload(spark):
    region = {"regionid": 3, "dnoregion": "D", "shortname": "S", "intensity": {"forecast": 99, "actual": 1, "index": "low"},
              "generationmix": [{"fuel": "wind", "perc": 10}, {"fuel": "wind", "perc": 12.5}]}
    doc = {"data": [{"from": "2024-01-01T00:00Z", "to": "2024-01-01T00:30Z", "regions": [region, {"regionid": 4}]}]}
    got = payloads.flatten_regional_intensity(text(spark, doc)).orderBy("region_id").collect()
    assert (got[0]["carbon_intensity"], got[0]["intensity_index"], got[0]["region_name"]) == (99, "low", "S")
    assert got[1]["carbon_intensity"] is None
    mix = payloads.flatten_regional_mix(text(spark, doc)).orderBy("region_id").collect()
    assert mix[0]["wind"] == 12.5 and mix[0]["gas"] is None and mix[1]["wind"] is None


def test_mix_payload(spark):
    doc = {"data": [{"from": "2024-01-01T00:00Z", "generationmix": [{"fuel": "gas", "perc": "n/a"}, {"fuel": "solar", "perc": "3.5"},
                                                                    {"fuel": "tidal", "perc": 9}]}]}
    got = payloads.flatten_generation_mix(text(spark, doc)).first()
    assert got["gas"] is None and got["solar"] == 3.5 and "tidal" not in got.asDict()


def test_weather_payload(spark):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [5.1, 4.8], "wind_speed_10m": [12.3]}}
    df = text(spark, doc).withColumn("city", F.lit("London"))
    got = payloads.flatten_weather(df, ["city"]).orderBy("timestamp").collect()
    assert [(r["temperature"], r["wind_speed"], r["radiation"]) for r in got] == [(5.1, 12.3, None), (4.8, None, None)]


def test_session_csv(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(
        "sessionID,stationID,connectionTime,disconnectTime,kWhDelivered,extra\n"
        '1,a,"Wed, 25 Apr 2018 11:08:39 GMT","Wed, 25 Apr 2018 12:08:39 GMT",5.5,x\n'
        "2,b,2018-04-25T11:00:00Z,2018-04-25 13:00:00,6,x\n"
        "3,c,2018-04-25T15:00:00Z,2018-04-25T13:00:00Z,7,x\n"
    )
    got = files.load_sessions(spark, str(path)).orderBy("session_id").collect()
    assert [r["session_id"] for r in got] == ["1", "2"] and got[0]["energy_kwh"] == 5.5
    assert got[0]["arrival_time"].timestamp() == dt.datetime(2018, 4, 25, 11, 8, 39, tzinfo=UTC).timestamp()
    path.write_text("sessionID,stationID\n1,a\n")
    with pytest.raises(ValueError, match="arrival_time"):
        files.load_sessions(spark, str(path))


def test_metrics_csv(spark, tmp_path):
    df = spark.createDataFrame([("R", 1, 0.5, 2.0, 1.0)], files.METRICS_SCHEMA)
    files.write_metrics(df, str(tmp_path / "m"))
    assert files.read_metrics(spark, str(tmp_path / "m")).collect() == df.collect()


def held(spark, lo, hi):
    return spark.createDataFrame([(lo,), (hi,)], "settlement_period timestamp")


def day(m, d=1):
    return dt.datetime(2024, m, d, tzinfo=UTC)


def spans(df):
    return sorted((r[0].timestamp(), r[1].timestamp()) for r in df.collect())


def test_missing_ranges(spark, tmp_path):
    feb = held(spark, day(2), day(2, 29))
    assert spans(ranges.missing_ranges(feb, day(1), day(3, 31))) == [
        (day(1).timestamp(), day(2).timestamp()), (day(2, 29).timestamp(), day(3, 31).timestamp())]
    assert ranges.missing_ranges(feb, day(2), day(2, 20)).count() == 0
    whole = [(day(1).timestamp(), day(3).timestamp())]
    assert spans(ranges.missing_ranges(feb.limit(0), day(1), day(3))) == whole
    assert spans(ranges.missing_ranges_in_file(spark, str(tmp_path / "absent"), day(1), day(3))) == whole


def test_chunks(spark):
    df = spark.createDataFrame([(day(1), dt.datetime(2024, 1, 30, 12, tzinfo=UTC))], "lo timestamp, hi timestamp")
    forward = spans(ranges.forward_chunks(df, "lo", "hi", 14))
    assert len(forward) == 3 and forward[-1] == (day(1, 29).timestamp(), dt.datetime(2024, 1, 30, 12, tzinfo=UTC).timestamp())
    backward = spans(ranges.backward_chunks(df, "lo", "hi", 7))
    assert len(backward) == 5
    assert backward[0][0] == dt.datetime(2024, 1, 1, 12, tzinfo=UTC).timestamp()  # half a day is left out
    assert ranges.forward_chunks(df, "hi", "lo", 7).count() == 0


KEYED = "k long, v long, seq int"


def test_three_write_rules(spark):
    target = spark.createDataFrame([(1, 10, 0), (None, 5, 0)], KEYED)
    batch = spark.createDataFrame([(1, 11, 1), (2, 20, 1), (2, 21, 2), (None, 6, 1)], KEYED)
    order = [F.col("seq")]

    def content(df):
        return {r["k"]: r["v"] for r in df.collect()}

    assert content(tables.insert_or_ignore(target, batch, ["k"], order)) == {1: 10, 2: 20, None: 5}
    assert content(tables.merge_insert_only(None, batch, ["k"], order)) == {1: 11, 2: 20, None: 6}
    assert content(tables.append_keep_last(target, batch, ["k"], order)) == {1: 11, 2: 21, None: 6}
    assert tables.append_keep_last(target, batch, ["absent"], order).count() == 6


def test_append_keep_last_on_paths(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "settlement_period timestamp, v int"
    for lo, hi, v in ((0, 10, 1), (10, 20, 1), (15, 25, 99)):
        df = spark.createDataFrame([(period(i), v) for i in range(lo, hi)], schema)
        tables.append_keep_last_path(spark, path, df, ["settlement_period"], [F.col("v")])
    got = {r["settlement_period"].timestamp(): r["v"] for r in tables.read_version(spark, path).collect()}
    assert len(got) == 25 and got[period(15).timestamp()] == 99 and got[period(14).timestamp()] == 1


def test_merge_into_path_reads_only_the_time_range(spark, tmp_path):
    path, schema = str(tmp_path / "m"), "k int, t timestamp"
    one = spark.createDataFrame([(1, period(0)), (1, period(1)), (1, period(1))], schema)
    two = spark.createDataFrame([(1, period(1)), (1, period(2)), (1, None)], schema)
    for _ in range(2):
        tables.merge_into_path(spark, path, one, ["k", "t"], [F.col("t")], "t")
        tables.merge_into_path(spark, path, two, ["k", "t"], [F.col("t")], "t")
    assert spark.read.parquet(path).count() == 4


def test_snapshots_truncate_and_log(spark, tmp_path):
    base = str(tmp_path / "f")
    with pytest.raises(FileNotFoundError):
        tables.load_latest_snapshot(spark, base)
    for d, v in ((dt.date(2024, 2, 1), 2), (dt.date(2024, 1, 9), 1)):
        tables.write_snapshot(spark.createDataFrame([(v, True)], "v int, b boolean"), base, d)
    latest = tables.load_latest_snapshot(spark, base)
    assert latest.first()["v"] == 2 and dict(latest.dtypes)["b"] == "boolean"
    path = f"{base}/run_date=2024-02-01"
    tables.truncate_layer(spark, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["v", "b"]
    tables.append_run_log(spark, str(tmp_path / "runs"), {"alpha": 0.5}, {"loss": 1.5})
    assert spark.read.parquet(str(tmp_path / "runs")).first()["metrics"]["loss"] == 1.5


def test_a_number_too_large_gives_null_not_an_error(spark):
    text = '{"data":[{"from":"2024-01-01T00:00Z","intensity":{"actual":99999999999,"forecast":5}}]}'
    row = payloads.flatten_intensity(spark.createDataFrame([(text,)], "value string")).first()
    assert (row.intensity_actual, row.intensity_forecast) == (None, 5)


def test_session_files_with_other_column_orders(spark, tmp_path):
    names = list(files.SESSION_COLUMNS)
    values = dict(zip(names, ["s1", "st1", "2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z", "2.5"]))
    for i, order in enumerate([names, names[::-1], names[2:] + names[:2]]):
        (tmp_path / f"{i}.csv").write_text(",".join(order) + "\n" + ",".join(values[c] for c in order) + "\n")
    rows = files.load_sessions(spark, str(tmp_path)).collect()
    assert [(r.session_id, r.station_id, r.energy_kwh) for r in rows] == [("s1", "st1", 2.5)] * 3


def test_broken_range_file_holds_nothing(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    got = ranges.missing_ranges_in_file(spark, str(tmp_path / "bad.parquet"), start, end)
    assert got.count() == 1
    held = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 12))], "k int, settlement_period timestamp")
    series = spark.createDataFrame([(1,), (2,)], "k int")
    assert ranges.missing_ranges(held, start, end, keys=["k"], series=series).where("k = 2").count() == 1


def test_latest_snapshot_is_a_complete_one(spark, tmp_path):
    base = str(tmp_path / "snaps")
    tables.write_snapshot(spark.range(3), base, dt.date(2024, 1, 1))
    (tmp_path / "snaps" / "run_date=2024-01-02" / "_temporary").mkdir(parents=True)
    assert tables.load_latest_snapshot(spark, base).count() == 3


def test_holidays_of_any_year(spark):
    got = {r[0] for r in reference.holiday_dimension(spark).collect()}
    assert {dt.date(1969, 12, 25), dt.date(2150, 1, 1), dt.date(2150, 12, 25)} <= got


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path, schema = str(tmp_path / "days"), "k long, t timestamp, v long"
    day = dt.timedelta(days=1)

    def put(*rows):
        df = spark.createDataFrame(rows, schema)
        return tables.append_keep_last_days(spark, path, df, ["k", "t"], [F.col("v")], "t")

    def files(name):
        return sorted(str(p) for p in (tmp_path / "days" / f"day={name}").rglob("*.parquet"))

    assert tables.read_days(spark, path) is None and put() == []
    assert put((1, START, 1), (1, START, 2), (2, START + day, 5), (3, None, 7)) == ["2024-01-01", "2024-01-02", "none"]
    untouched = files("2024-01-01")
    assert put((2, START + day, 6), (9, START + day, 1)) == ["2024-01-02"]
    assert files("2024-01-01") == untouched
    # Only the days of a batch are read.
    read = tables.read_days(spark, path, ["2024-01-02"]).inputFiles()
    assert read and all("day=2024-01-02/version=000002" in f for f in read)
    # What a broken run left, and a day without a whole version, is not read.
    spark.createDataFrame([(5, START, 5)], schema).write.parquet(f"{path}/_staging-x/_day=2024-01-01")
    (tmp_path / "days" / "day=2024-01-09").mkdir()
    got = sorted((r["k"], r["v"]) for r in tables.read_days(spark, path).collect())
    assert got == [(1, 2), (2, 6), (3, 7), (9, 1)]
    put((2, START + day, 0))
    assert [r["v"] for r in tables.read_days(spark, path).filter("k = 2").collect()] == [0]
    assert len(list((tmp_path / "days" / "day=2024-01-02").iterdir())) == 2
    with pytest.raises(ValueError, match="several days"):
        tables.append_keep_last_days(spark, path, spark.createDataFrame([(1, START, 1)], schema), ["k"], [F.col("v")], "t")
