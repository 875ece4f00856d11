import random
from datetime import timedelta

from pyspark.sql import functions as F

from data import EVENTS, at, event, events, metadata
from gaugeflow.operators.alerts import lasting_breaches
from gaugeflow.streaming.durations import stream_lasting_breaches
from gaugeflow.streaming.start import finish, start_files


def rule(rows, seconds, until=None):
    """(sensor, run_seq) of the runs that last, by a plain loop over arrivals."""
    found = set()
    for sensor in {r[0] for r in rows}:
        run = None
        for _, seq, time, value, *_ in sorted((r for r in rows if r[0] == sensor), key=lambda r: r[1]):
            breach = value >= 60
            if run:
                run = (run[0], run[1], max(run[2], time))
            elif breach:
                run = (seq, time, time)
            if run and run[2] - run[1] >= timedelta(seconds=seconds):
                found.add((sensor, run[0]))
            run = run if breach else None
        if run and until and until - run[1] >= timedelta(seconds=seconds):
            found.add((sensor, run[0]))
    return found


def streamed(spark, tmp_path, batches, seconds, **options):
    """The stream is stopped after every batch and goes on from its checkpoint."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(source)
        result = stream_lasting_breaches(spark.readStream.schema(EVENTS).parquet(source),
                                         metadata(spark), seconds, buckets=2, **options)
        finish(start_files(result, out, str(tmp_path / "checkpoint"), None, state_partitions=2), 300)
    return spark.read.schema(result.schema).parquet(out)


def pairs(df):
    rows = [(r.sensor_id, r.run_seq) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def arrivals(seed, count):
    rng = random.Random(seed)
    rows, clock = [], 0
    for seq in range(count):
        clock += rng.choice([0, 1, 3, 8])
        rows.append(event(rng.choice("abcd"), seq, clock, rng.choice([50, 60, 61, 75])))
    return rows


def test_stored_events_follow_the_rule(spark):
    for seed in range(3):
        rows = arrivals(seed, 200)
        for moved in (rows, [(r[0], r[1] * 37 % 211, *r[2:]) for r in rows]):
            until = at(rows[-1][2].timestamp() - at(0).timestamp() - 15)
            for block in (3, 1000):
                got = lasting_breaches(events(spark, moved), metadata(spark), 20,
                                       F.lit(until).cast("timestamp"), block)
                assert pairs(got) == rule(moved, 20, until)
    assert pairs(lasting_breaches(events(spark, rows), metadata(spark), 20)) == rule(rows, 20)
    assert lasting_breaches(events(spark, []), metadata(spark), 20).count() == 0


def test_a_timer_needs_no_further_reading(spark, tmp_path):
    batches = [[event("quiet", 0, 0, 70), event("short", 1, 1, 70), event("short", 2, 5, 10),
                event("held", 3, 2, 70)],
               [event("other", 4, 80, 10), event("held", 5, 70, 10)],  # the watermark passes 60 s
               [event("quiet", 6, 90, 10), event("other", 7, 95, 70), event("other", 8, 160, 70)]]
    got = streamed(spark, tmp_path, batches[:2], 60)
    row = {r.sensor_id: r for r in got.collect()}
    assert set(row) == {"quiet", "held"}
    quiet = row["quiet"]
    assert (quiet.run_seq, quiet.value, quiet.threshold, quiet.sensor_type) == (0, 70, 60, "temperature")
    assert quiet.due_time == at(60).replace(tzinfo=None) and quiet.run_since == at(0).replace(tzinfo=None)
    # after a restart nothing is told twice, and a reading settles a run before its timer
    assert pairs(streamed(spark, tmp_path, batches[2:], 60)) == {("quiet", 0), ("held", 3), ("other", 7)}


def test_a_stream_equals_the_stored_events(spark, tmp_path):
    rows = arrivals(7, 240)
    until = rows[-1][2] - timedelta(seconds=15)
    got = streamed(spark, tmp_path, [rows[:90], rows[90:150], rows[150:]], 20, block=16)
    want = lasting_breaches(events(spark, rows), metadata(spark), 20, F.lit(until).cast("timestamp"))
    assert pairs(got) == pairs(want) == rule(rows, 20, until)
    key = lambda r: (r.sensor_id, r.run_seq)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
