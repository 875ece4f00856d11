import json
import os
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from data import at, event, events, metadata
from model import alerts_of

from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.operators.alerts import sustained_alerts
from gaugeflow.operators.windows import window_aggregates
from gaugeflow.jobs import main
from gaugeflow.schema import AGGREGATES_TOPIC, ALERT, ALERTS_TOPIC
from gaugeflow.sources import archive
from gaugeflow.sources.events import file_events
from gaugeflow.streaming.aggregates import aggregate_job, stream_aggregates
from gaugeflow.streaming.alerts import (
    BLOCK_ROW, SustainedAlerts, alert_job, reduce_blocks, stream_alerts)
from gaugeflow.streaming.progress import ProgressCounters
from gaugeflow.streaming.results import publish_job, result_tables_job
from gaugeflow.streaming.start import finish


def write_batch(folder, number, rows):
    """One file per micro-batch, in the broker's columns."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = []
    for sensor, seq, time, value, kind, place, text, partition in rows:
        value = json.dumps({"sensor_id": sensor, "event_time": text, "sensor_type": kind,
                            "value": value, "unit": "u", "location": place})
        lines.append(json.dumps({"value": value, "topic": "sensor-events", "partition": partition,
                                 "offset": seq, "timestamp": at(9999).isoformat()}))
    file = folder / f"{number:04d}.json"
    file.write_text("\n".join(lines) + "\n")
    os.utime(file, (1_700_000_000 + number,) * 2)  # the source takes files by their time


def source(spark, folder):
    return file_events(spark, str(folder), stream=True, max_files_per_trigger=1)


def stored_events(spark, folder):
    return accepted(parse_events(file_events(spark, str(folder))))


LATENESS = [[(5, 1), (50, 3)], [(74.999, 9)], [(58, 5), (75, 9)], [(59, 7), (61, 9)],
            [(30, 99), (200, 9)]]


def test_windows_and_late_readings(spark, tmp_path):
    seq = 0
    for number, batch in enumerate(LATENESS):
        rows = [event("a", seq + i, t, v) for i, (t, v) in enumerate(batch)]
        seq += len(rows)
        write_batch(tmp_path / "in", number, rows)
    counters = ProgressCounters()
    spark.streams.addListener(counters)
    query = aggregate_job(source(spark, tmp_path / "in"), str(tmp_path / "out"),
                          str(tmp_path / "check"), interval=None, state_partitions=2)
    finish(query, 300)
    dropped = sum(int(s["numRowsDroppedByWatermark"])
                  for p in query.recentProgress for s in p["stateOperators"])
    spark.streams.removeListener(counters)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start_label, r.event_count, r.avg_value) for r in got] == [
        ("00:00", 4, 4.0), ("00:01", 3, 9.0)]
    assert dropped == 1
    assert sum(counters.late_dropped.values()) in (0, 1)  # the listener runs behind


def readings(seed, n=240):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        sensor = "hot" if rng.random() < 0.4 else f"s{rng.randrange(3)}"
        seconds = round(max(0, seq * 3 + rng.uniform(-30, 30)), 3)
        rows.append(event(sensor, seq, seconds, 90 if rng.random() < 0.75 else 10))
    return rows


def plain(rows):
    return [(r[0], r[1], int(r[2].timestamp() * 1000), r[3] >= 60) for r in rows]


@pytest.mark.parametrize("batches,block,buckets", [(1, 1 << 16, 256), (2, 16, 1), (6, 5, 3)])
def test_alert_stream_equals_stored_events(spark, tmp_path, batches, block, buckets):
    rows = readings(batches)
    size = -(-len(rows) // batches)
    for number in range(batches):
        write_batch(tmp_path / "in", number, rows[number * size:(number + 1) * size])
    finish(alert_job(source(spark, tmp_path / "in"), metadata(spark), str(tmp_path / "out"),
                     str(tmp_path / "check"), interval=None, state_partitions=2, block=block,
                     buckets=buckets), 300)
    got = spark.read.schema(ALERT).parquet(str(tmp_path / "out"))
    want = alerts_of(plain(rows))
    assert {(r.sensor_id, r.seq): r.consecutive_breaches for r in got.collect()} == want
    stored = sustained_alerts(stored_events(spark, tmp_path / "in"), metadata(spark))
    key = lambda r: r.seq
    assert sorted(map(tuple, got.collect()), key=lambda t: t[-2]) == [
        tuple(r) for r in sorted(stored.collect(), key=key)]


def test_a_hot_sensor_sends_one_row_per_block(spark):
    """A sensor that never stops: its state sees blocks, and only times that rise."""
    rows = [event("hot", i, i * 0.5 if i % 3 else 0, 90) for i in range(900)]
    slim = events(spark, rows).select(
        "sensor_id", "seq", F.unix_millis("event_time").alias("event_ms"),
        F.lit(True).alias("breach"), F.lit("{}").alias("reading"))
    got = reduce_blocks(slim, 3, 100, 8).collect()
    assert len(got) == 9 and len({r.bucket for r in got}) == 1
    assert all(r.tail_run == 100 and r.tail_open for r in got)
    assert all(len(r.seqs) <= 70 for r in got)  # a third of the readings is older than a sure one
    assert sum(len(r.seqs) for r in got) < 640


def test_python_reduces_one_slot_of_blocks_at_a_time(spark, capsys):
    rows = [event("hot", i, i * 0.5, 90) for i in range(900)]
    slim = events(spark, rows).select(
        "sensor_id", "seq", F.unix_millis("event_time").alias("event_ms"),
        F.lit(True).alias("breach"), F.lit("{}").alias("reading"))
    blocks = reduce_blocks(slim, 3, 100, 8, partitions=1)
    blocks.explain()
    assert "FlatMapGroupsInArrow" in capsys.readouterr().out  # sorted by Spark, not held whole
    assert blocks.count() == 9


class _Sensors:
    """The state of a call without a stream."""

    def __init__(self):
        self.kept = {}
        self.getValue, self.removeKey = self.kept.get, self.kept.pop
        self.updateValue = self.kept.__setitem__

    def getMapState(self, *_):
        return self


def test_a_hot_sensors_blocks_wait_outside_of_memory():
    """Blocks come out of order, a few at a time; all of them hold 60 MB, the call a fraction."""
    size, blocks = 10_000, 30

    def block(number):
        seqs = np.arange(number * size, (number + 1) * size)
        return pd.DataFrame([(0, "hot", number, size, True, seqs, 1_000_000 + seqs * 1_000,
                              np.arange(1, size + 1), np.ones(size, bool),
                              np.array([f"{s:0150d}" for s in seqs], object))], columns=BLOCK_ROW.names)

    state, processor = _Sensors(), SustainedAlerts(3, 500_000, None)
    processor.init(state)
    tracemalloc.start()
    try:
        got = pd.concat(processor.handleInputRows((0,), (block(n * 7 % blocks) for n in range(blocks)), None))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got["seq"].tolist() == list(range(2, size * blocks, 501))
    assert (got["consecutive_breaches"] == got["seq"] + 1).all()
    assert (got["reading"].astype(int) == got["seq"]).all()
    assert state.kept == {("hot",): (size * blocks, 1_000_000 + int(got["seq"].iloc[-1]) * 1_000)}
    assert peak < 35e6


def test_restart_keeps_state(spark, tmp_path):
    rows = readings(11)
    for number in range(4):
        write_batch(tmp_path / "in", number, rows[number * 60:(number + 1) * 60])
        if number % 2:
            finish(alert_job(source(spark, tmp_path / "in"), metadata(spark),
                             str(tmp_path / "out"), str(tmp_path / "check"), interval=None,
                             state_partitions=2), 300)
    got = spark.read.schema(ALERT).parquet(str(tmp_path / "out")).collect()
    assert {(r.sensor_id, r.seq): r.consecutive_breaches for r in got} == alerts_of(plain(rows))
    assert len(got) == len({(r.sensor_id, r.seq) for r in got})


def test_window_stream_equals_stored_events(spark, tmp_path):
    rows = readings(21) + [event("end", 240, 100_000, 1)]
    for number in range(3):
        write_batch(tmp_path / "in", number, rows[number * 81:(number + 1) * 81])
    finish(aggregate_job(source(spark, tmp_path / "in"), str(tmp_path / "out"),
                         str(tmp_path / "check"), interval=None, state_partitions=2), 300)
    got = spark.read.parquet(str(tmp_path / "out"))
    # disorder stays below the watermark's tolerance between batches, so nothing is dropped
    stored = window_aggregates(stored_events(spark, tmp_path / "in")).filter("sensor_id <> 'end'")
    columns = stored.columns
    assert sorted(map(str, got.select(columns).collect())) == sorted(
        map(str, stored.select(columns).collect()))


def test_archive_stream_after_restart(spark, tmp_path):
    for number in range(2):
        write_batch(tmp_path / "in", number, [event("a", number, 1, 1)])
        finish(archive.archive_job(source(spark, tmp_path / "in"), str(tmp_path / "raw"),
                                   str(tmp_path / "check"), interval=None), 300)
    want = sorted(r.value for r in file_events(spark, str(tmp_path / "in")).collect())
    got = sorted(r.value for r in archive.read_archive(spark, str(tmp_path / "raw")).collect())
    assert got == want and len(got) == 2


def test_results_through_topics(spark, tmp_path):
    rows = [event("a", i, t, 90) for i, t in enumerate([1, 2, 3, 500])]
    write_batch(tmp_path / "in", 0, rows)
    events_stream = accepted(parse_events(source(spark, tmp_path / "in")))
    out = tmp_path / "records"
    finish(publish_job(stream_aggregates(events_stream), AGGREGATES_TOPIC, str(out / "one"),
                       str(tmp_path / "c1"), None, 2), 300)
    finish(publish_job(stream_alerts(events_stream, metadata(spark)), ALERTS_TOPIC,
                       str(out / "two"), str(tmp_path / "c2"), None, 2), 300)
    records = file_events(spark, str(out / "*"), stream=True)
    for query in result_tables_job(records, str(tmp_path / "tables"), str(tmp_path / "c3"), None):
        finish(query, 300)
    aggs = spark.read.parquet(str(tmp_path / "tables" / AGGREGATES_TOPIC)).collect()
    alerts = spark.read.parquet(str(tmp_path / "tables" / ALERTS_TOPIC)).collect()
    assert [(r.window_start_label, r.event_count) for r in aggs] == [("00:00", 3)]
    assert [(r.seq, r.consecutive_breaches) for r in alerts] == [(2, 3), (3, 4)]
    assert (tmp_path / "tables" / ALERTS_TOPIC / "event_date=2024-01-01").is_dir()


def test_job_from_the_command_line(spark, tmp_path):
    write_batch(tmp_path / "in", 0, [event("a", i, t, 90) for i, t in enumerate([1, 2, 3])])
    common = ["--files", str(tmp_path / "in"), "--out", str(tmp_path / "out"),
              "--checkpoint", str(tmp_path / "check"), "--metadata", str(tmp_path / "none.json"),
              "--once"]
    for job in ("aggregates", "alerts", "archive", "publish-alerts"):
        main([job, *common, "--state-partitions", "2"])
    (tmp_path / "out" / "publish-alerts" / "broken.json").write_text(
        json.dumps({"value": "[1]", "topic": ALERTS_TOPIC}) + "\n")
    records = tmp_path / "records"
    records.mkdir()
    for file in (tmp_path / "out" / "publish-alerts").glob("*.json"):
        (records / file.name).write_text(file.read_text())
    main(["tables", "--files", str(records), *common[2:]])
    tables = tmp_path / "out" / "tables"
    assert spark.read.parquet(str(tables / ALERTS_TOPIC)).count() == 1
    assert spark.read.json(str(tables / f"{ALERTS_TOPIC}-rejected")).first()["value"] == "[1]"
    assert spark.read.parquet(str(tmp_path / "out" / "alerts")).count() == 1
    assert archive.archive_status(spark, str(tmp_path / "out" / "archive")).first()[
        "events_archived"] == 3
