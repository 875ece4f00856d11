"""Breaches that last, on a stream: an alert as soon as a run has lasted long enough, with or
without a further reading.

A value holds until the sensor's next reading, so a run lasts from its first reading to the
one that ends it. An open run is settled by whatever comes first: a reading that is late
enough, or an event-time timer when the watermark passes the run's due time. Both give the
same row, so results do not depend on how the stream is cut into micro-batches (readings that
arrive after the watermark has passed them may come too late to end a run). The rows equal
those of ``operators.alerts.lasting_breaches`` on the stored events.

As in ``streaming.alerts``, a micro-batch becomes one row per sensor and block of arrivals
before it reaches the state, and the state is one entry per sensor in its bucket's map; a
second map holds the sensors that fall due at a moment, so a timer reads those alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import (
    ArrayType, BooleanType, LongType, StringType, StructField, StructType)

from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.operators.alerts import LASTING, as_reading, lasting_rows
from gaugeflow.schema import WATERMARK
from gaugeflow.sources.metadata import Metadata
from gaugeflow.streaming.alerts import BUCKETS, STREAM_BLOCK, slot
from gaugeflow.streaming.start import start_files

BLOCK_ROW = StructType([
    StructField("bucket", LongType()), StructField("sensor_id", StringType()),
    StructField("block", LongType()), StructField("first_us", LongType()),
    StructField("leads", BooleanType()), StructField("seqs", ArrayType(LongType())),
    StructField("since", ArrayType(LongType())), StructField("until", ArrayType(LongType())),
    StructField("closed", ArrayType(BooleanType())), StructField("readings", ArrayType(StringType()))])
OUT = StructType([StructField("sensor_id", StringType()), StructField("run_seq", LongType()),
                  StructField("since_us", LongType()), StructField("reading", StringType())])
SENSOR = StructType([StructField("sensor_id", StringType())])
RUN = StructType([StructField("seq", LongType()), StructField("since", LongType()),
                  StructField("until", LongType()), StructField("told", BooleanType()),
                  StructField("reading", StringType())])
MOMENT = StructType([StructField("due_ms", LongType())])
SENSORS = StructType([StructField("sensors", ArrayType(StringType()))])


def reduce_runs(readings: DataFrame, min_us: int, block: int, buckets: int) -> DataFrame:
    """One row per (sensor, block): the time of its first reading, and its runs. Runs that end
    in the block too early, and do not go on from the block before, are left out."""

    def reduce(share: pa.Table) -> pa.Table:
        rows = share.sort_by(
            [("sensor_id", "ascending"), ("_block", "ascending"), ("seq", "ascending")])
        size = len(rows)
        names, blocks = rows.column("sensor_id"), rows.column("_block")
        differs = pc.or_(pc.not_equal(names.slice(1), names.slice(0, size - 1)),
                         pc.not_equal(blocks.slice(1), blocks.slice(0, size - 1))).to_numpy()
        begins, ends = np.r_[True, differs], np.r_[differs, True]
        breach, times = rows.column("breach").to_numpy(), rows.column("event_us").to_numpy()
        after = np.where(ends, times, np.r_[times[1:], times[-1:]])  # a value holds until then
        starts = np.flatnonzero(breach & (begins | ~np.r_[False, breach[:-1]]))
        heads = np.flatnonzero(begins)
        group = np.searchsorted(heads, starts, side="right") - 1
        until, last = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(starts):
            held = np.where(breach, np.maximum(times, after), np.iinfo(np.int64).min)
            until = np.maximum.reduceat(held, starts)
            last = starts + np.add.reduceat(breach & True, starts) - 1
            crossing = np.append(starts[1:], size)  # no run crosses a block
            last = np.minimum(last, crossing - 1)
        closed = ~ends[last] if len(starts) else np.zeros(0, bool)
        leads = begins[starts] if len(starts) else np.zeros(0, bool)
        kept = np.flatnonzero(leads | ~closed | (until - times[starts] >= min_us)) if len(starts) else last
        bounds = np.r_[0, np.cumsum(np.bincount(group[kept], minlength=len(heads)))].astype(np.int32)
        some = rows.take(starts[kept])

        def lists(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(bounds), values)

        first = rows.take(heads)
        return pa.table({
            "bucket": first.column("_bucket"), "sensor_id": first.column("sensor_id"),
            "block": first.column("_block"), "first_us": first.column("event_us"),
            "leads": pa.array(breach[heads]), "seqs": lists(some.column("seq").combine_chunks()),
            "since": lists(pa.array(times[starts[kept]])), "until": lists(pa.array(until[kept])),
            "closed": lists(pa.array(closed[kept])),
            "readings": lists(some.column("reading").combine_chunks())})

    spread = readings.withColumns({
        "_block": F.expr(f"seq div {block}"),
        "_bucket": F.pmod(F.xxhash64("sensor_id"), F.lit(buckets).cast("long")), "_slot": slot(block)})
    return spread.groupBy("_slot").applyInArrow(reduce, BLOCK_ROW)


class LastingBreaches(StatefulProcessor):
    """Follows the open run of every sensor of a bucket until it has lasted or ended."""

    def __init__(self, min_us: int):
        self._min = min_us

    def init(self, handle) -> None:
        self._handle = handle
        self._runs = handle.getMapState("runs", SENSOR, RUN)
        self._due = handle.getMapState("due", MOMENT, SENSORS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        blocks = pd.concat(list(rows), ignore_index=True).sort_values(["sensor_id", "block"])
        found, waiting = [], {}
        for sensor, mine in blocks.groupby("sensor_id", sort=False):
            before = self._runs.getValue((sensor,))
            run = before = tuple(before) if before else None
            for row in mine.itertuples(index=False):
                run = self._follow(row, run, sensor, found)
            if run and not run[3]:
                run = self._told(run, sensor, found)
                if not run[3] and (before is None or before[0] != run[0]):
                    due = -(-(run[1] + self._min) // 1000)
                    waiting.setdefault(due, []).append(sensor)
            if run:
                self._runs.updateValue((sensor,), run)
            elif before:
                self._runs.removeKey((sensor,))
        for due, sensors in waiting.items():
            others = self._due.getValue((due,))
            self._due.updateValue((due,), ([*(others[0] if others else []), *sensors],))
            if not others:
                self._handle.registerTimer(due)
        if found:
            yield self._rows(found)

    def _follow(self, row, run: tuple | None, sensor: str, found: list) -> tuple | None:
        """The open run after a block; runs that have lasted are added to what was found."""
        pieces = [list(piece) for piece in zip(row.seqs, row.since, row.until, row.closed, row.readings)]
        if run:  # the value held until the block's first reading
            run = (*run[:2], max(run[2], int(row.first_us)), *run[3:])
            over = not row.leads
            if row.leads:
                _, _, until, over, _ = pieces.pop(0)
                run = (*run[:2], max(run[2], int(until)), *run[3:])
            run = self._told(run, sensor, found)
            run = None if over else run
        for seq, since, until, closed, reading in pieces:
            run = self._told((int(seq), int(since), int(until), False, reading), sensor, found)
            run = None if closed else run
        return run

    def _told(self, run: tuple, sensor: str, found: list) -> tuple:
        """The run, marked if it has lasted; then it is added to what was found."""
        if run[3] or run[2] - run[1] < self._min:
            return run
        found.append((sensor, run[0], run[1], run[4]))
        return (*run[:3], True, run[4])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = int(expiredTimerInfo.getExpiryTimeInMs())
        waiting, found = self._due.getValue((due,)), []
        for sensor in waiting[0] if waiting else []:
            run = self._runs.getValue((sensor,))
            if run and not run[3] and -(-(run[1] + self._min) // 1000) == due:
                found.append((sensor, run[0], run[1], run[4]))
                self._runs.updateValue((sensor,), (*tuple(run)[:3], True, run[4]))
        if waiting:
            self._due.removeKey((due,))
        if found:
            yield self._rows(found)

    def _rows(self, found: list) -> pd.DataFrame:
        return pd.DataFrame(found, columns=OUT.names)

    def close(self) -> None:
        pass


def stream_lasting_breaches(events: DataFrame, metadata: Metadata, min_duration_s: int,
                            watermark: str = WATERMARK, block: int = STREAM_BLOCK,
                            buckets: int = BUCKETS) -> DataFrame:
    """One row per run of breaches that lasts ``min_duration_s`` of event time."""
    slim = as_reading(events.withWatermark("event_time", watermark), metadata).select(
        "sensor_id", "seq", F.unix_micros("event_time").alias("event_us"), "breach",
        F.when(F.col("breach"), F.to_json(F.struct(*LASTING))).alias("reading"))
    min_us = min_duration_s * 1_000_000
    runs = reduce_runs(slim, min_us, block, buckets).groupBy("bucket").transformWithStateInPandas(
        LastingBreaches(min_us), OUT, "Append", "EventTime")
    read = F.from_json("reading", "value double, threshold double, sensor_type string, location string")
    return lasting_rows(runs.select(
        "sensor_id", "run_seq", F.timestamp_micros("since_us").alias("run_since"), read.alias("r")
    ).select("sensor_id", "run_seq", "run_since", "r.*"), min_duration_s)


def lasting_job(envelope: DataFrame, metadata: Metadata, min_duration_s: int, path: str,
                checkpoint: str, strict: bool = False, interval: str | None = "10 seconds",
                state_partitions: int | None = None) -> StreamingQuery:
    events = accepted(parse_events(envelope, strict))
    return start_files(stream_lasting_breaches(events, metadata, min_duration_s), path, checkpoint,
                       interval, partition="event_date", state_partitions=state_partitions)
