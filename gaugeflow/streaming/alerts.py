"""Sustained-threshold alerts on a stream, with state per sensor inside buckets.

No watermark: a late reading still counts. The state of a sensor is the length
of the open run and the time of the last alert, one entry of its bucket's map: a
micro-batch reads and writes the sensors that report and no others, however many a
bucket has, while one call serves a whole bucket. Entries expire by the store's own
time-to-live, if one is set.

A micro-batch is reduced before it reaches the state. Its readings are spread by
(sensor, block of arrival numbers). A block becomes one row: the breaches that can
still become alerts, and how the open run stands at its end. Of those breaches the
ones are left out that are no later than an earlier sure one, for whether that one
alerts or is suppressed, they are suppressed. A sensor that sends a third of the
data is therefore worked on by many tasks, and its state sees one row per block. Blocks are
dealt to slots, which Spark sorts on disk if need be, and Python holds one slot at a time. The
state function takes blocks as they come, lets large ones wait in a file of its own, and
follows a sensor's blocks one after the other.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType)

from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.operators.alerts import as_reading
from gaugeflow.operators.cooldown import pick_alerts
from gaugeflow.schema import ALERT, COOLDOWN_MS, MIN_CONSECUTIVE, UNKNOWN_ID
from gaugeflow.sources.metadata import Metadata
from gaugeflow.streaming.start import start_files

# readings of a sensor that one task sorts, and states that are kept together
STREAM_BLOCK = 1 << 16
BUCKETS = 256
# groups of blocks that Python reduces one at a time
SLOTS = 4096
# possible alerts of a block that waits in memory, bytes of waiting blocks in memory, alerts put out at once
SMALL, SPOOL_BYTES, CHUNK = 64, 1 << 24, 10_000
OUT = StructType([StructField("sensor_id", StringType()), StructField("seq", LongType()),
                  StructField("consecutive_breaches", IntegerType()),
                  StructField("reading", StringType())])
READING = ("value double, threshold double, severity string, sensor_type string, "
           "location string, timestamp string, critical_threshold double, event_us bigint")
BLOCK_ROW = StructType([
    StructField("bucket", LongType()), StructField("sensor_id", StringType()),
    StructField("block", LongType()), StructField("tail_run", LongType()),
    StructField("tail_open", BooleanType()), StructField("seqs", ArrayType(LongType())),
    StructField("times", ArrayType(LongType())), StructField("runs", ArrayType(LongType())),
    StructField("opens", ArrayType(BooleanType())), StructField("readings", ArrayType(StringType()))])
SENSOR = StructType([StructField("sensor_id", StringType())])
STATE = StructType([StructField("run", LongType()), StructField("last_alert", LongType())])


def slot(block: int) -> Column:
    """The slot of a reading's block; a block is never parted."""
    return F.pmod(F.xxhash64("sensor_id", F.expr(f"seq div {block}")), F.lit(SLOTS))


def reduce_blocks(readings: DataFrame, min_consecutive: int, block: int, buckets: int,
                  partitions: int | None = None) -> DataFrame:
    """One row per (sensor, block): possible alerts and the run at the block's end.

    ``runs`` counts breaches since the block's last normal reading; ``opens`` tells
    that there was none, so an earlier run goes on. A stream cannot be sorted by
    Spark, so Python sorts the blocks of one slot at a time: of ``SLOTS`` parts of the
    micro-batch one, with never more than ``block`` readings of one sensor for one block.
    """

    def reduce(share: pa.Table) -> pa.Table:
        rows = share.sort_by(
            [("sensor_id", "ascending"), ("_block", "ascending"), ("seq", "ascending")])
        size = len(rows)
        names, blocks = rows.column("sensor_id"), rows.column("_block")
        differs = pc.or_(pc.not_equal(names.slice(1), names.slice(0, size - 1)),
                         pc.not_equal(blocks.slice(1), blocks.slice(0, size - 1))).to_numpy()
        begins, ends = np.r_[True, differs], np.r_[differs, True]
        group = np.cumsum(begins) - 1
        breach, times = rows.column("breach").to_numpy(), rows.column("event_ms").to_numpy()
        place, count = np.arange(size), np.cumsum(breach)
        begin = np.maximum.accumulate(np.where(begins, place, 0))
        normal = np.maximum.accumulate(np.where(breach, -1, place))
        is_open = normal < begin
        run = count - np.where(is_open, count[begin] - breach[begin], count[normal])
        sure = breach & (run >= min_consecutive)
        # each block's times are lifted above all earlier ones, so one running maximum serves all
        lift = group * (int(times.max()) - int(times.min()) + 2)
        lifted = times - int(times.min()) + 1 + lift
        newest = np.r_[0, np.maximum.accumulate(np.where(sure, lifted, lift))[:-1]]
        kept = np.flatnonzero((sure | (breach & is_open)) & (lifted > np.maximum(newest, lift)))
        last = np.flatnonzero(ends)
        bounds = np.r_[0, np.cumsum(np.bincount(group[kept], minlength=len(last)))].astype(np.int32)
        some = rows.take(kept)

        def lists(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(bounds), values)

        heads = rows.take(last)
        return pa.table({
            "bucket": heads.column("_bucket"), "sensor_id": heads.column("sensor_id"),
            "block": heads.column("_block"), "tail_run": pa.array(run[last]),
            "tail_open": pa.array(is_open[last]),
            "seqs": lists(some.column("seq").combine_chunks()),
            "times": lists(pa.array(times[kept])), "runs": lists(pa.array(run[kept])),
            "opens": lists(pa.array(is_open[kept])),
            "readings": lists(some.column("reading").combine_chunks())})

    spread = readings.withColumns({
        "_block": F.expr(f"seq div {block}"),
        "_bucket": F.pmod(F.xxhash64("sensor_id"), F.lit(buckets).cast("long")), "_slot": slot(block)})
    if partitions:
        spread = spread.repartition(partitions, "_slot")
    return spread.groupBy("_slot").applyInArrow(reduce, BLOCK_ROW)


class _Waiting:
    """The blocks of one call until all have come; large ones are written to ``file``."""

    def __init__(self, file):
        self._file, self._blocks = file, []

    def add(self, row: tuple) -> None:
        _, sensor, block, *rest = row
        if len(rest[2]) > SMALL:
            at = self._file.tell()
            pickle.dump(rest, self._file, pickle.HIGHEST_PROTOCOL)
            rest = at
        self._blocks.append((sensor, block, rest))

    def in_order(self) -> Iterator[tuple[str, list]]:
        for sensor, _, rest in sorted(self._blocks, key=lambda held: held[:2]):
            if isinstance(rest, int):
                self._file.seek(rest)
                rest = pickle.load(self._file)
            yield sensor, rest


class SustainedAlerts(StatefulProcessor):
    """Continues the runs and cooldowns of a bucket's sensors over micro-batches."""

    def __init__(self, min_consecutive: int, cooldown_ms: int, ttl_ms: int | None):
        self._min = min_consecutive
        self._cooldown = cooldown_ms
        self._ttl = ttl_ms

    def init(self, handle) -> None:
        self._sensors = handle.getMapState("sensors", SENSOR, STATE, self._ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        with tempfile.SpooledTemporaryFile(SPOOL_BYTES) as file:
            blocks = _Waiting(file)
            for part in rows:
                for row in part.itertuples(index=False, name=None):
                    if row[1] is not None:
                        blocks.add(row)
            found, size, here, before, carry, last = [], 0, None, None, 0, 0
            for sensor, block in blocks.in_order():
                if sensor != here:
                    self._keep(here, before, carry, last)
                    here, before = sensor, self._sensors.getValue((sensor,))
                    carry, last = before or (0, 0)
                carry, last, alerts = self._follow(block, carry, last)
                if alerts:
                    found.append((sensor, *alerts))
                    size += len(alerts[0])
                if size >= CHUNK:
                    yield self._frame(found)
                    found, size = [], 0
            self._keep(here, before, carry, last)
            if found:
                yield self._frame(found)

    def _keep(self, sensor: str | None, before, carry: int, last: int) -> None:
        # a sensor without a run and without an alert is like an unknown one
        if carry or last:
            self._sensors.updateValue((sensor,), (carry, last))
        elif before:
            self._sensors.removeKey((sensor,))

    def _follow(self, block: list, carry: int, last: int) -> tuple[int, int, tuple | None]:
        """One block: the run at its end, the time of the last alert, and its alerts."""
        tail_run, tail_open, seqs, times, runs, opens, readings = block
        # readings before the block's first normal one continue the open run
        runs = np.asarray(runs, np.int64) + np.where(np.asarray(opens, bool), carry, 0)
        due = np.flatnonzero(runs >= self._min)
        times = np.asarray(times, np.int64)[due]
        picked = pick_alerts(times, last, self._cooldown)
        alerts = None
        if len(picked):
            last = int(times[picked[-1]])
            at = due[picked]
            alerts = (np.asarray(seqs, np.int64)[at], runs[at].astype(np.int32),
                      np.asarray(readings, object)[at])
        return int(tail_run) + (carry if tail_open else 0), last, alerts

    @staticmethod
    def _frame(found: list[tuple]) -> pd.DataFrame:
        sensors, seqs, runs, readings = zip(*found)
        return pd.DataFrame({
            "sensor_id": np.repeat(np.array(sensors, object), [len(s) for s in seqs]),
            "seq": np.concatenate(seqs), "consecutive_breaches": np.concatenate(runs),
            "reading": np.concatenate(readings)})

    def close(self) -> None:
        pass


def stream_alerts(events: DataFrame, metadata: Metadata, min_consecutive: int = MIN_CONSECUTIVE,
                  cooldown_ms: int = COOLDOWN_MS, ttl_ms: int | None = None,
                  block: int = STREAM_BLOCK, buckets: int = BUCKETS,
                  partitions: int | None = None) -> DataFrame:
    """Alerts with the same rows as ``sustained_alerts`` on the stored events.

    ``buckets`` belongs to the checkpoint; a call serves one bucket, so it bounds the
    parallel work on the state. A sensor that does not report for ``ttl_ms`` is forgotten. ``partitions`` spreads a micro-batch over more, smaller tasks.
    """
    readings = as_reading(events, metadata)
    # One text column instead of eight, as each column costs every call of the state
    # function. A normal reading only ends a run, so nothing else of it is moved.
    slim = readings.select(
        "sensor_id", "seq", F.unix_millis("event_time").alias("event_ms"), "breach",
        F.when(F.col("breach"), F.to_json(F.struct(
            "value", "threshold", "severity", "sensor_type", "location", "timestamp",
            F.nullif("critical_threshold", F.lit(float("inf"))).alias("critical_threshold"),
            F.unix_micros("event_time").alias("event_us")))).alias("reading"))
    alerts = reduce_blocks(slim, min_consecutive, block, buckets, partitions).groupBy(
        "bucket").transformWithStateInPandas(
        SustainedAlerts(min_consecutive, cooldown_ms, ttl_ms), OUT, "Append",
        "None" if ttl_ms is None else "ProcessingTime")
    full = alerts.select("sensor_id", "seq", "consecutive_breaches",
                         F.from_json("reading", READING).alias("r"))
    return full.select("sensor_id", "seq", "consecutive_breaches", "r.*").withColumns({
        "sensor_type": F.coalesce("sensor_type", F.lit(UNKNOWN_ID)),
        "location": F.coalesce("location", F.lit(UNKNOWN_ID)),
        "critical_threshold": F.coalesce("critical_threshold", F.lit(float("inf"))),
        "event_time": F.timestamp_micros("event_us"),
    }).withColumn("event_date", F.to_date("event_time")).select(*ALERT.names)


def alert_job(envelope: DataFrame, metadata: Metadata, path: str, checkpoint: str,
              strict: bool = False, interval: str | None = "5 seconds",
              state_partitions: int | None = None, **rules) -> StreamingQuery:
    events = accepted(parse_events(envelope, strict))
    return start_files(stream_alerts(events, metadata, **rules), path, checkpoint, interval,
                       partition="event_date", state_partitions=state_partitions)
