import random
import time

import numpy as np
import pytest
from data import at, event, events, metadata, ms
from hypothesis import given, settings, strategies as st
from model import alerts_of, runs_of

from gaugeflow.operators.alerts import duration_alerts, sustained_alerts
from gaugeflow.operators.cooldown import (
    _outcome, _Outcomes, _Steps, compositions, order_blocks, pick_alerts, suppress)
from gaugeflow.operators.enrich import mark_breaches
from gaugeflow.operators.runs import breach_runs

CASE = [(0, 61), (1, 60), (2, 75), (20, 62), (32, 62), (33, 62), (34, 10), (35, 90), (36, 90),
        (37, 90), (64, 90)]


def test_hand_written_case(spark):
    rows = [event("a", i, t, v) for i, (t, v) in enumerate(CASE)]
    got = sustained_alerts(events(spark, rows), metadata(spark)).orderBy("seq").collect()
    assert [(r.event_time, r.severity, r.consecutive_breaches, r.threshold) for r in got] == [
        (at(2).replace(tzinfo=None), "critical", 3, 60.0),
        (at(33).replace(tzinfo=None), "warning", 6, 60.0),
        (at(64).replace(tzinfo=None), "critical", 4, 60.0)]
    assert got[0].timestamp == at(2).isoformat()


def random_readings(seed, n=400, sensors=4, disorder=20, step=8, hot=0.5):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        sensor = "hot" if rng.random() < hot else f"s{rng.randrange(sensors)}"
        value = 90 if rng.random() < 0.8 else 10
        seconds = max(0, seq * step / 4 + rng.uniform(-disorder, disorder))
        rows.append(event(sensor, seq, round(seconds, 3), value))
    return rows


def plain(rows):
    return [(r[0], r[1], int(r[2].timestamp() * 1000), r[3] >= 60) for r in rows]


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 20])
def test_runs_across_blocks(spark, block):
    rows = random_readings(1)
    marked = mark_breaches(events(spark, rows), metadata(spark))
    got = {(r.sensor_id, r.seq): (r.consecutive_breaches, r.run_seq)
           for r in breach_runs(marked, 1, block).collect()}
    assert got == runs_of(plain(rows))
    since = {r.run_seq: r.run_since for r in breach_runs(marked, 1, block).collect()}
    times = {r[1]: r[2].replace(tzinfo=None) for r in rows}
    assert all(times[seq] == t for seq, t in since.items())


@pytest.mark.parametrize("seed,cooldown,block,block_ms", [
    (2, 30_000, 7, 40_000), (3, 30_000, 50, 120_000), (4, 200_000, 1 << 20, 60_000),
    (5, 1_000, 16, 5_000), (6, 30_000, 1 << 20, None), (7, 0, 9, 10_000),
    (8, 30_000, 5, 30_000), (9, 30_000, 5, 7_000), (10, 5_000, 11, 60_000)])
def test_alerts_across_blocks(spark, seed, cooldown, block, block_ms):
    rows = random_readings(seed)
    got = sustained_alerts(events(spark, rows), metadata(spark), cooldown_ms=cooldown,
                           block=block, block_ms=block_ms).collect()
    want = alerts_of(plain(rows), cooldown_ms=cooldown)
    assert {(r.sensor_id, r.seq): r.consecutive_breaches for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("seed,cooldown,block_ms,fanout", [
    (11, 30_000, 7_000, 2), (12, 5_000, 3_000, 3), (13, 60_000, 20_000, 2), (14, 1_000, 500, 4)])
def test_alerts_through_rounds_of_composition(spark, seed, cooldown, block_ms, fanout):
    """Several sensors with pauses and readings out of order, over many small blocks."""
    rng = random.Random(seed)
    times = [max(0, int(seq * 900 + rng.uniform(-20_000, 20_000) + (seq // 90) * 70_000))
             for seq in range(500)]
    rows = [(rng.choice("aab"), seq, t) for seq, t in enumerate(times)]
    candidates = spark.createDataFrame(rows, "sensor_id string, seq long, event_ms long")
    got = suppress(candidates, cooldown, block_ms, fanout).collect()
    want = alerts_of([(*r, True) for r in rows], min_consecutive=1, cooldown_ms=cooldown)
    assert sorted((r.sensor_id, r.seq) for r in got) == sorted(want)


def test_one_sensor_that_never_stops(spark):
    rows = [event("hot", i, i * 0.5, 90) for i in range(3000)]
    got = sustained_alerts(events(spark, rows), metadata(spark), block=100, block_ms=60_000)
    assert {(r.sensor_id, r.seq): r.consecutive_breaches for r in got.collect()} == alerts_of(
        plain(rows))


def test_a_reading_every_millisecond(spark):
    """Blocks are composed in rounds; the last alert before each is found through all of them."""
    times = np.arange(1_000, 31_000)
    rows = spark.range(1_000, 31_000).selectExpr("'a' AS sensor_id", "id AS seq", "id AS event_ms")
    got = {r.seq for r in suppress(rows, cooldown_ms=40, block_ms=100, fanout=4).collect()}
    assert got == set(times[pick_alerts(times, 0, 40)].tolist())


def test_many_blocks_of_one_sensor_are_ordered_in_linear_time(spark):
    """Looking back and ahead from each of 80,000 blocks; one by one that is 3 billion steps."""
    rows = spark.range(80_000).selectExpr(
        "'a' AS sensor_id", "CASE WHEN id % 1000 = 0 THEN id + 1500 ELSE id END AS seq",
        "id * 10 + 100 AS event_ms", "id AS _block")
    started = time.monotonic()
    got = order_blocks(rows, 10).orderBy("_block").toPandas()
    assert time.monotonic() - started < 25
    # the first of each thousand arrives after later ones, save the last one
    assert len(got) == 80_000 - 80
    assert got["newest"].iloc[0] == 0 and (got["newest"].iloc[1:] <= got["_block"].iloc[1:] * 10 + 90).all()
    assert got["later_arrival"].iloc[:-1].notna().all() and got["later_arrival"].isna().iloc[-1]
    assert (got["later_arrival"].iloc[:-1] > got["_block"].iloc[:-1]).all()


def test_blocks_stay_whole_when_a_join_becomes_a_broadcast(spark):
    """One unbroken sensor over thousands of blocks whose order is a table small enough to send."""
    seqs = np.arange(100_000)
    times = 1_000_000 + seqs * 1_000 + seqs * 37 % 101 * 15
    rows = spark.range(0, 100_000, 1, 8).selectExpr(
        "'a' AS sensor_id", "id AS seq", "1000000 + id * 1000 + id * 37 % 101 * 15 AS event_ms")
    got = sorted(r.seq for r in suppress(rows, cooldown_ms=10_003, block_ms=40_012).collect())
    assert got == pick_alerts(times, 0, 10_003).tolist()


def test_groups_of_blocks_stay_small(spark):
    """Each level has a quarter of the last one's rows, and no group more than one cooldown's."""
    cooldown, blocks = 40, 300
    rows = spark.range(blocks * 41).selectExpr(
        "'a' AS sensor_id", "id div 41 + 7 AS _block", "(id div 41) * 100 + 99 AS newest",
        "(id div 41) * 100 + 100 + id % 41 AS entry", "(id div 41) * 100 + 182 + id % 41 * 17 % 18 AS exit")
    rows = rows.selectExpr("sensor_id", "_block", "newest", "entry",
                           "max(exit) OVER (PARTITION BY _block ORDER BY entry) AS exit")
    levels = compositions(rows, cooldown, 4)
    sizes = [level.count() for level in levels]
    assert len(levels) == 5 and all(b <= a / 4 + 2 * 41 for a, b in zip(sizes, sizes[1:]))
    for level in levels:
        assert level.groupBy("_block").count().agg({"count": "max"}).first()[0] <= cooldown + 1
    assert levels[-1].select("_block").distinct().count() <= 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=2, max_size=80), st.integers(0, 90),
       st.lists(st.integers(1, 79), max_size=4), st.integers(0, 90))
def test_composed_blocks(gaps, cooldown, cuts, back):
    """Any cut into blocks gives, composed, the last alert that follows from one before."""
    times = 10_000 + np.cumsum(np.array(gaps, dtype=np.int64))
    newest = 10_000
    parts = [p for p in np.split(times, sorted({c for c in cuts if c < len(times)})) if len(p)]
    steps = None
    for part in parts:
        block = _Outcomes("a", 0, newest, True, cooldown)
        block.add(part)
        entry, exit = block.row()[-2:]
        if steps is None:
            steps = _Steps(newest, entry, exit, cooldown)
        else:
            steps.then(entry, exit)
    last = newest - min(back, cooldown)  # no more than a cooldown before the newest candidate
    picked = pick_alerts(times, last, cooldown)
    want = int(times[picked[-1]]) if len(picked) else last
    assert int(_outcome(steps.entry, steps.exit, np.array([last]), cooldown)[0]) == want
    assert len(steps.entry) <= cooldown + 1


def test_thresholds(spark):
    own = ("own", None, None, "g", None, 20.0, None)
    bare = ("bare", "vibration", None, None, "d", None, None)
    rows = [event("own", 0, 0, 25), event("bare", 1, 0, 65), event("none", 2, 0, 999, "odd"),
            event("own", 3, 0, 75), event("own", 4, 0, float("nan"))]
    got = {r.seq: r for r in mark_breaches(events(spark, rows), metadata(spark, [own, bare])).collect()}
    assert (got[0].threshold, got[0].critical_threshold, got[0].breach) == (20, 70, True)
    assert got[1].threshold == 60  # the default of the event's type
    assert (got[2].threshold, got[2].breach) == (float("inf"), False)
    assert got[3].severity == "critical"
    assert (got[4].breach, got[4].severity) == (False, "warning")


def test_duration(spark):
    rows = [event("a", i, t, v) for i, (t, v) in enumerate(
        [(0, 90), (30, 90), (60, 90), (90, 90), (91, 1), (92, 90), (151, 90), (152, 90)])]
    for block in (1, 2, 100):
        got = duration_alerts(events(spark, rows), metadata(spark), 60, block).collect()
        assert sorted((r.seq, r.consecutive_breaches) for r in got) == [(2, 3), (7, 3)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3_000), min_size=1, max_size=60), st.integers(0, 900),
       st.integers(1, 12), st.integers(0, 4_000))
def test_outcomes_of_a_block_in_pieces(times, cooldown, size, last):
    rising = np.unique(np.maximum.accumulate(np.array(times, dtype=np.int64)))
    block = _Outcomes("a", 0, 0, True, cooldown)
    for low in range(0, len(times), size):
        block.add(np.array(times[low:low + size], dtype=np.int64))
    entry, outcome = block.row()[-2:]
    assert (np.diff(entry) > 0).all() and (np.diff(outcome) != 0).all()
    last = min(last, int(rising[0]))  # the last alert before a block is no later than its beginning
    picked = pick_alerts(rising, last, cooldown)
    at = int(np.searchsorted(entry, last + cooldown, "right"))
    assert (int(rising[picked[-1]]) if len(picked) else None) == (
        int(outcome[at]) if at < len(outcome) else None)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 200_000), max_size=60), st.integers(0, 100_000),
       st.integers(0, 60_000))
def test_pick_alerts(times, last, cooldown):
    want, now = [], last
    for i, t in enumerate(times):
        if t - now > cooldown:
            want.append(i)
            now = t
    assert pick_alerts(np.array(times, dtype=np.int64), last, cooldown).tolist() == want


def test_times_are_milliseconds():
    assert ms(1) - ms(0) == 1000
