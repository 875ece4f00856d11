"""Windows on a stream that store what comes too late, with timers per window.

Spark's own streaming aggregation drops readings of closed windows and only counts them.
Here one query gives both: the closed windows, and every reading whose window had already
closed when it arrived, as a row. A reading is judged by the watermark with which its
micro-batch began, which is that of all earlier batches, so the windows hold exactly what
the late table does not.

Before anything is shuffled, each Arrow batch of a task becomes one row per sensor and
window: digits of the exact sum (see ``functions.exact_sum``), extremes, counts, the last
type and location, and the readings as text, which are looked at only if they are late. A
sensor that sends a third of the data costs the state one row per batch. State is kept per
window and bucket of sensors, is read and written once per micro-batch that touches it, and
goes when the window's event-time timer fires.
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
    BinaryType, DoubleType, LongType, StringType, StructField, StructType)

from gaugeflow.functions.exact_sum import digit_names, exact_total, with_digits
from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.operators.windows import finished_windows
from gaugeflow.schema import WATERMARK, WINDOW
from gaugeflow.streaming.start import few_partitions, start_files

BUCKETS = 64
WINDOWS, LATE = "windows", "late"

# names without a leading underscore, which the state's rows would lose
SUMS = {name: name.lstrip("_") for name in digit_names("value")}
*DIGITS, BEYOND = SUMS.values()
NUMBERS = {**dict.fromkeys(DIGITS, LongType()), BEYOND: DoubleType(), "numbers": LongType(),
           "event_count": LongType(), "min_value": DoubleType(), "max_value": DoubleType()}
ATTRIBUTES = ["sensor_type", "location"]
LASTS = {name: kind for a in ATTRIBUTES for name, kind in ((f"{a}_seq", LongType()), (a, StringType()))}
KEY = {"bucket": LongType(), "window_end": LongType()}
PART = StructType([StructField(n, t) for n, t in {
    **KEY, "sensor_id": StringType(), **NUMBERS, **LASTS, "readings": StringType()}.items()])
OUT = StructType([StructField(n, t) for n, t in {
    "kind": StringType(), **{n: t for n, t in KEY.items() if n != "bucket"}, "sensor_id": StringType(),
    **NUMBERS, **{a: StringType() for a in ATTRIBUTES}, "reading": StringType()}.items()])
# a window's sensors as one Arrow stream: as a list per column, every number would be an object
HELD = ["sensor_id", *NUMBERS, *LASTS]
STATE = StructType([StructField("rows", BinaryType())])
READING = ("sensor_id string, seq bigint, event_us bigint, value double, sensor_type string, "
           "location string")
SEPARATOR = "\x1e"  # JSON writes control characters as escapes


def _summed(values: np.ndarray, missing: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums per group, and which groups have nothing to add."""
    return (np.add.reduceat(np.where(missing, 0, values), starts),
            np.logical_and.reduceat(missing, starts))


def _combined(table: pa.Table) -> pa.Table:
    """Rows of equal keys as one; the table is sorted by ``KEY`` and sensor."""
    size = len(table)
    new = np.ones(size, bool)
    new[1:] = False
    for name in (*KEY, "sensor_id"):
        column = table.column(name)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, size - 1)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    out = {name: table.column(name).take(pa.array(starts)) for name in (*KEY, "sensor_id")}
    for name, kind in NUMBERS.items():
        column = table.column(name).combine_chunks()
        missing = column.is_null().to_numpy(zero_copy_only=False)
        whole = isinstance(kind, LongType)
        values = pc.fill_null(column, 0 if whole else 0.0).to_numpy(zero_copy_only=False)
        if name in ("min_value", "max_value"):
            best, worst = (np.fmin, np.inf) if name == "min_value" else (np.fmax, -np.inf)
            total = best.reduceat(np.where(missing, worst, values), starts)
            nothing = np.logical_and.reduceat(missing, starts)
        else:
            total, nothing = _summed(values, missing, starts)
        out[name] = pa.array(total, pa.int64() if whole else pa.float64(), mask=nothing)
    for attribute in ATTRIBUTES:
        seq = table.column(f"{attribute}_seq").combine_chunks()
        known = ~seq.is_null().to_numpy(zero_copy_only=False)
        group = np.cumsum(new) - 1
        order = np.lexsort((pc.fill_null(seq, 0).to_numpy(zero_copy_only=False), known, group))
        last = pa.array(order[np.append(starts[1:], size) - 1])
        out[f"{attribute}_seq"] = seq.take(last)
        out[attribute] = table.column(attribute).take(last)
    bounds = pa.array(np.append(starts, size).astype(np.int32))
    texts = table.column("readings").combine_chunks()
    out["readings"] = pc.binary_join(pa.ListArray.from_arrays(bounds, texts), SEPARATOR)
    return pa.table(out)


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket, window and sensor of each Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).sort_by(
                [(name, "ascending") for name in (*KEY, "sensor_id")])
            yield from _combined(table).select([f.name for f in PART]).to_batches()


class ClosingWindows(StatefulProcessor):
    """Collects a window's sensors until the watermark passes its end; what comes later is late."""

    def init(self, handle) -> None:
        self._handle = handle
        self._state = handle.getValueState("window", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[1])
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                texts = [t for joined in part["readings"] for t in joined.split(SEPARATOR)]
                yield self._out(LATE, end, pd.DataFrame({"reading": texts}))
            return
        parts = [pa.Table.from_pandas(part, ARROW, preserve_index=False) for part in rows]
        if self._state.exists():
            parts.append(self._read(key))
        else:
            self._handle.registerTimer(end)
        whole = _combined(pa.concat_tables(parts).sort_by(
            [(name, "ascending") for name in (*KEY, "sensor_id")]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, HELD_ARROW) as writer:
            writer.write_table(whole.select(HELD).cast(HELD_ARROW))
        self._state.update((sink.getvalue().to_pybytes(),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self._state.exists():
            whole = self._read(key).select(HELD)
            self._state.clear()
            yield self._out(WINDOWS, int(key[1]), whole.to_pandas(types_mapper=pd.ArrowDtype))

    def _read(self, key) -> pa.Table:
        held = pa.ipc.open_stream(self._state.get()[0]).read_all()
        more = {"bucket": pa.repeat(pa.scalar(int(key[0]), pa.int64()), len(held)),
                "window_end": pa.repeat(pa.scalar(int(key[1]), pa.int64()), len(held)),
                "readings": pa.repeat(pa.scalar(""), len(held))}
        return pa.table([more[n] if n in more else held.column(n) for n in ARROW.names], ARROW)

    def _out(self, kind: str, end: int, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(kind=kind, window_end=end)
        return pd.DataFrame({f.name: rows[f.name] if f.name in rows else pd.Series(
            [None] * len(rows), dtype=object) for f in OUT})

    def close(self) -> None:
        pass


_ARROW_TYPES = {LongType(): pa.int64(), DoubleType(): pa.float64(), StringType(): pa.string()}
ARROW = pa.schema([pa.field(f.name, _ARROW_TYPES[f.dataType]) for f in PART])
HELD_ARROW = pa.schema([ARROW.field(name) for name in HELD])


def windows_and_late(events: DataFrame, size: str = WINDOW, watermark: str = WATERMARK,
                     buckets: int = BUCKETS) -> DataFrame:
    """Closed windows (``kind`` is ``windows``) and late readings (``late``) of a stream.

    ``buckets`` belongs to the checkpoint. A reading needs ``sensor_id``, ``seq``,
    ``event_time`` and ``value``; nulls in value, type and location are allowed.
    """
    end = F.unix_millis(F.window("event_time", size)["end"])
    rows = with_digits(events.withWatermark("event_time", watermark), "value").select(
        F.pmod(F.xxhash64("sensor_id"), F.lit(buckets).cast("long")).alias("bucket"),
        end.alias("window_end"), "sensor_id", *[F.col(c).alias(n) for c, n in SUMS.items()],
        F.col("value").isNotNull().cast("long").alias("numbers"), F.lit(1).cast("long").alias("event_count"),
        F.col("value").alias("min_value"), F.col("value").alias("max_value"),
        *[c for a in ATTRIBUTES for c in (
            F.when(F.col(a).isNotNull(), F.col("seq")).alias(f"{a}_seq"), F.col(a))],
        F.to_json(F.struct("sensor_id", "seq", F.unix_micros("event_time").alias("event_us"), "value",
                           "sensor_type", "location")).alias("readings"))
    return rows.mapInArrow(combine, PART).groupBy(*KEY).transformWithStateInPandas(
        ClosingWindows(), OUT, "Append", "EventTime")


def closed_windows(rows: DataFrame, size: str = WINDOW, places: int | None = 2) -> DataFrame:
    """The windows among the rows of ``windows_and_late``, as ``window_aggregates`` gives them."""
    end = F.timestamp_millis("window_end")
    windows = rows.where(F.col("kind") == WINDOWS).withColumnsRenamed({n: c for c, n in SUMS.items()})
    return finished_windows(windows.withColumns({
        "start": end - F.expr(f"INTERVAL {size}"), "end": end,
        "avg_value": exact_total("value") / F.nullif(F.col("numbers"), F.lit(0))}), places)


def late_readings(rows: DataFrame) -> DataFrame:
    """The late readings, each with the end of the window that had closed."""
    late = rows.where(F.col("kind") == LATE).select(
        F.from_json("reading", READING).alias("r"), F.timestamp_millis("window_end").alias("window_end"))
    return late.select("r.sensor_id", "r.seq", F.timestamp_micros("r.event_us").alias("event_time"),
                       "r.value", "r.sensor_type", "r.location", "window_end")


def windows_and_late_job(envelope: DataFrame, path: str, checkpoint: str, strict: bool = False,
                         interval: str | None = "10 seconds", state_partitions: int | None = None,
                         size: str = WINDOW, watermark: str = WATERMARK) -> StreamingQuery:
    """Both outputs, exactly once, in folders of one table: ``kind=windows`` and ``kind=late``."""
    return start_files(windows_and_late(accepted(parse_events(envelope, strict)), size, watermark),
                       path, checkpoint, interval, partition="kind",
                       state_partitions=state_partitions or few_partitions(envelope.sparkSession))
