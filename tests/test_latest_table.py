import datetime as dt

from gaugeflow.sources.files import finished_folders
from gaugeflow.streaming import latest as L
from gaugeflow.streaming.start import finish

SCHEMA = "window_start timestamp, sensor_id string, avg_value double"
START = dt.datetime(2024, 1, 1)


def _rows(spark, *rows):
    return spark.createDataFrame([(START + dt.timedelta(minutes=m), s, float(v)) for m, s, v in rows], SCHEMA)


def _table(spark, path):
    rows = L.latest_table(spark, path, _rows(spark).schema).collect()
    return {r.sensor_id: r.avg_value for r in rows}


def test_batches_merge_and_come_again(spark, tmp_path):
    path = str(tmp_path / "table")
    assert _table(spark, path) == {}
    L.merge_latest(_rows(spark), "sensor_id", path)
    assert finished_folders(spark, f"{path}/manifest", L.VERSION) == []
    first = _rows(spark, (1, "a", 1), (5, "a", 2), (3, "b", 3), (4, None, 4))
    L.merge_latest(first, "sensor_id", path)
    assert _table(spark, path) == {"a": 2, "b": 3, None: 4}
    # an older row of a, a newer one of b, and a new sensor
    second = _rows(spark, (4, "a", 9), (6, "b", 5), (0, "c", 6))
    L.merge_latest(second, "sensor_id", path)
    want = {"a": 2, "b": 5, None: 4, "c": 6}
    assert _table(spark, path) == want
    L.merge_latest(second, "sensor_id", path)
    L.merge_latest(first, "sensor_id", path)
    assert _table(spark, path) == want


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "table")
    L.merge_latest(_rows(spark, *[(0, f"s{i}", i) for i in range(200)]), "sensor_id", path, buckets=8)
    L.merge_latest(_rows(spark, (1, "s7", 70)), "sensor_id", path, buckets=8)
    buckets = [p.name for p in (tmp_path / "table" / "data" / "_version=000000000002").iterdir() if p.is_dir()]
    assert len(buckets) == 1
    assert sorted(L._places(spark, path).values()).count("000000000001") == 7
    got = _table(spark, path)
    assert len(got) == 200 and got["s7"] == 70 and got["s8"] == 8


def test_a_failed_attempt_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "table")
    L.merge_latest(_rows(spark, (1, "a", 1)), "sensor_id", path)
    # files of a next version, without its manifest
    bucket = next(iter(L._places(spark, path)))
    _rows(spark, (9, "a", 99)).write.parquet(f"{path}/data/_version=000000000002/_bucket={bucket}")
    assert _table(spark, path) == {"a": 1}
    L.merge_latest(_rows(spark, (2, "a", 2)), "sensor_id", path)
    assert _table(spark, path) == {"a": 2}
    assert L.drop_replaced(spark, path) == ["000000000001"]
    assert L.drop_replaced(spark, path) == [] and _table(spark, path) == {"a": 2}


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("source", "table", "checkpoint"))
    for part in ([(1, "a", 1), (1, "b", 1)], [(3, "a", 3)], [(2, "a", 2), (2, "b", 2)]):
        _rows(spark, *part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        finish(L.latest_table_job(stream, "sensor_id", path, checkpoint, interval=None), 120)
    assert _table(spark, path) == {"a": 3, "b": 2}
    assert len(finished_folders(spark, f"{path}/manifest", L.VERSION)) == 3
