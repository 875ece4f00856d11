import json

import pytest
from data import envelope, event, events
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gaugeflow import schema as S
from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.operators.windows import window_aggregates
from gaugeflow.session import materialize, scratch
from gaugeflow.sources import archive, results
from gaugeflow.sources.events import file_events, jsonl_events, kafka_events
from gaugeflow.sources.metadata import load_metadata


def test_metadata_file(spark, tmp_path):
    path = tmp_path / "metadata.json"
    path.write_text(json.dumps({
        "sensors": {"a": {"group": "g", "warning_threshold": 5.0}, "b": {"description": "x"}},
        "default_thresholds": {"t": {"warning": 1.0}}}))
    data = load_metadata(spark, str(path))
    assert {r.sensor_id: (r.group, r.warning_threshold) for r in data.sensors.rows.collect()} == {
        "a": ("g", 5.0), "b": (None, None)}
    assert [(r.sensor_type, r.warning, r.critical) for r in data.thresholds.rows.collect()] == [
        ("t", 1.0, None)]
    assert data.sensors.small


def test_metadata_defaults(spark, tmp_path):
    data = load_metadata(spark, str(tmp_path / "none.json"))
    assert data.sensors.rows.count() == 0
    assert {tuple(r) for r in data.thresholds.rows.collect()} == set(S.DEFAULT_THRESHOLDS)
    path = tmp_path / "half.json"
    path.write_text('{"sensors": {}}')
    assert load_metadata(spark, str(path)).thresholds.rows.count() == 0


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(AnalysisException):
        kafka_events(spark, "nowhere:9092", [S.AGGREGATES_TOPIC, S.ALERTS_TOPIC])


def test_lines_as_written(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    good = {"sensor_id": "a", "timestamp": "2024-01-01T00:00:05+00:00", "type": "t",
            "value": 1.5, "unit": "°C", "location": "l", "nr": 7}
    path.write_text(json.dumps(good, ensure_ascii=False) + "\n{bad\n", encoding="utf-8")
    rows = parse_events(jsonl_events(spark, str(path))).collect()
    assert sorted(str(r.reject_reason) for r in rows) == ["None", "bad_json"]
    numbered = accepted(parse_events(jsonl_events(spark, str(path), seq_field="nr"))).first()
    assert (numbered.seq, numbered.unit) == (7, "°C")


def test_published_events_come_back(spark, tmp_path):
    rows = events(spark, [event("a", 0, 1, 2.5), event("b", 1, 2, 3.5)]).withColumn(
        "unit", F.lit("°C"))
    records = results.publish_events(rows.drop("partition", "event_time_text"), S.EVENTS_TOPIC)
    assert {r.key for r in records.collect()} == {"a", "b"}
    results.write_records(records, str(tmp_path / "topic"))
    back = file_events(spark, str(tmp_path / "topic"))
    parsed = accepted(parse_events(back)).orderBy("sensor_id").collect()
    assert [(r.sensor_id, r.value, r.event_time.second) for r in parsed] == [
        ("a", 2.5, 1), ("b", 3.5, 2)]


def test_results_by_topic(spark):
    aggs = window_aggregates(events(spark, [event("a", 0, 1, 2.5)]))
    records = results.to_records(aggs, S.AGGREGATES_TOPIC).unionByName(
        results.to_records(spark.range(3), S.ALERTS_TOPIC))
    parts = results.split_by_topic(records, [S.AGGREGATES_TOPIC, S.ALERTS_TOPIC])
    assert parts[S.ALERTS_TOPIC].count() == 3
    back = results.from_records(parts[S.AGGREGATES_TOPIC], S.AGGREGATE)
    assert back.collect() == aggs.select(*back.columns).collect()


def test_history_reads_only_its_dates(spark, tmp_path):
    rows = events(spark, [event("a", d, d * 86_400, 1) for d in range(5)])
    path = str(tmp_path / "aggregates")
    results.write_results(window_aggregates(rows), path)
    some = results.history(spark, path, "2024-01-02", "2024-01-03")
    assert some.count() == 2
    assert "PartitionFilters: [isnotnull(event_date" in some._jdf.queryExecution().toString()


LINES = ['{"sensor_id":"a","unit":"°C","other":[1, 2]}', "{bad", '{"x":1}   ']


def test_archive_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    odd = ['{"a":\n1}', "{broken\r\n\n", "\u001e", "\u001eabc", "", "\r", "é\n日"]
    archive.archive_batch(envelope(spark, LINES + odd + [None]), path, rows_per_file=4)
    rows = archive.read_archive(spark, path).collect()
    assert sorted(map(repr, (r.value for r in rows))) == sorted(map(repr, LINES + odd + [None]))
    assert all(len(r.year) == 4 and len(r.hour) == 2 for r in rows)
    status = archive.archive_status(spark, path).first()
    assert status.events_archived == 11 and status.objects_written >= 3
    assert status.last_object_key.endswith(".txt")
    hours = archive.read_archive_hours(spark, path)
    assert hours.filter(F.col("month") == rows[0].month).count() == 11
    per_object = archive.count_objects(spark, path)
    assert max(r.events for r in per_object.collect()) <= 4
    counted = spark.createDataFrame(per_object.collect(), per_object.schema)
    archive.archive_batch(envelope(spark, LINES), path)
    assert archive.archive_status(spark, path, counted).first().events_archived == 14
    assert "binaryFile" in archive.archive_objects(spark, path)._jdf.queryExecution().toString()


def test_scratch_folders_go(spark):
    with scratch(spark):
        kept = materialize(spark.range(5), "numbers")
        folder = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert kept.count() == 5
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)


def test_a_stream_keeps_its_folder(spark, tmp_path):
    (tmp_path / "raw" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError):
        archive.archive_batch(envelope(spark, LINES), str(tmp_path / "raw"))
    with pytest.raises(ValueError):
        results.write_results(spark.range(1), str(tmp_path / "raw"), "id")


def test_broken_records_are_kept_apart(spark):
    good = '{"sensor_id":"a","value":1.5}'
    records = envelope(spark, [good, "not json", "[1]", "", None, "1", '{"value":"x"}'])
    assert [r.sensor_id for r in results.from_records(records, S.ALERT).collect()] == ["a"]
    bad = [r.value for r in results.rejected_records(records, S.ALERT).orderBy("offset").collect()]
    assert bad == ["not json", "[1]", "", None, "1", '{"value":"x"}']
    plan = results.from_records(records, S.ALERT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_the_newest_rows_come_from_the_newest_dates(spark, tmp_path):
    rows = events(spark, [event("a", d * 10 + i, d * 86_400 + i * 60, 1) for d in range(8) for i in range(3)])
    path = str(tmp_path / "aggregates")
    results.write_results(window_aggregates(rows), path)
    for limit in (1, 3, 4, 20, 100):
        got = results.stored_latest(spark, path, limit, ["window_start"])
        assert got.count() == min(limit, 24)
        assert got.collect() == sorted(got.collect(), key=lambda r: r.window_start)
    few = results.stored_latest(spark, path, 2, ["window_start"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in few
    assert results.newest_dates(spark, path, 2).count() == 6


def test_lines_without_a_time_get_numbers_of_their_own(spark, tmp_path):
    texts = ["{broken", "{broken", "[1]", "", '{"sensor_id":"a","event_time":"bad"}',
             '{"sensor_id":"a","event_time":"2024-01-01T00:00:01Z"}']
    for name in ("x", "y"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(texts) + "\n")
    numbers = [sorted(r.offset for r in jsonl_events(spark, str(tmp_path)).collect()) for _ in range(2)]
    assert numbers[0] == numbers[1] and len(numbers[0]) == 12
    assert sum(n < 0 for n in numbers[0]) == 10 and len({n for n in numbers[0] if n < 0}) == 10


def test_archive_of_another_program(spark, tmp_path):
    folder = tmp_path / "raw" / "2024" / "01" / "31" / "05"
    folder.mkdir(parents=True)
    (folder / "1706677200000-0123abcd.jsonl").write_text("\n".join(LINES) + "\n", "utf-8")
    rows = archive.read_archive(spark, str(tmp_path / "raw")).collect()
    assert {(r.year, r.month, r.day, r.hour) for r in rows} == {("2024", "01", "31", "05")}
    status = archive.archive_status(spark, str(tmp_path / "raw")).first()
    assert (status.objects_written, status.events_archived) == (1, 3)


def test_equal_lines_are_numbered_by_several_tasks(spark, tmp_path, monkeypatch):
    from gaugeflow.sources import events

    monkeypatch.setattr(events, "EQUAL_LINES", 50, raising=False)
    lines = ["", "broken", '{"sensor_id": "s"}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines * 1001) + "\n")
    (tmp_path / "b.jsonl").write_text("\n".join(lines) + "\n")
    rows = jsonl_events(spark, str(tmp_path))
    numbers = [r.offset for r in rows.collect()]
    assert len(numbers) == len(set(numbers)) == 3 * 1002 and max(numbers) < 0
    places = sorted((-n) & 0xFFFFFFFF for n in numbers)
    assert places == sorted([*list(range(1, 1002)) * 3, 1, 1, 1])
    assert {(r.value, r.key) for r in rows.collect()} == {("", None), ("broken", None), (lines[2], "s")}
    tasks = rows.where("value = 'broken'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 1002
