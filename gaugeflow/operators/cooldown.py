"""Cooldown between alerts of one sensor, without folding a sensor in one task.

The rule is greedy: a candidate becomes an alert if its event time lies more
than the cooldown after the last alert, in arrival order. Three facts make it
parallel:

* an alert is later than every earlier candidate of its sensor, so candidates
  that arrive with an older time can be left out first;
* what remains is ordered by time, so it can be cut into blocks of time, and a
  block that begins more than a cooldown after everything before it needs
  nothing from there;
* any other block is *linked* to what precedes. The last alert before it is at
  most one cooldown older than the newest candidate before it, so only the
  candidates within one cooldown of the block's beginning can be its first
  alert. The block is described by the last alert that follows from each.

Linked blocks are described in parallel. A description is a step function from the last
alert before a block to the last one after it, and two that follow each other compose to
one of the same size. So descriptions of ``FANOUT`` neighbouring blocks are composed to one,
round by round, until a sensor has no more than ``FANOUT``; the last alert before each of
those is found, then, back through the rounds, the one before each block, and all blocks
replay their part in parallel. Blocks are read Arrow batch by Arrow batch: a replay holds
one time, a description the possible first alerts of one cooldown, however many readings
the block has, and a task composes ``FANOUT`` descriptions at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from gaugeflow.schema import COOLDOWN_MS
from gaugeflow.session import materialize

MIN_BLOCK_MS = 3_600_000
BATCH = 10_000
# neighbouring blocks, or groups of them, that one task composes
FANOUT = 32
# the entry of a description that has one outcome, whatever came before
ALWAYS = np.iinfo(np.int64).max


def pick_alerts(times: np.ndarray, last: int, cooldown: int) -> np.ndarray:
    """Positions of the alerts among candidates in arrival order."""
    picked = []
    newest = np.maximum.accumulate(times)
    at = int(np.searchsorted(newest, last + cooldown, side="right"))
    while at < len(times):
        picked.append(at)
        at = int(np.searchsorted(newest, newest[at] + cooldown, side="right"))
    return np.array(picked, dtype=np.int64)


def suppress(candidates: DataFrame, cooldown_ms: int = COOLDOWN_MS,
             block_ms: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """The candidates that become alerts. Needs ``sensor_id``, ``seq``, ``event_ms``."""
    block_ms = block_ms or max(MIN_BLOCK_MS, 4 * cooldown_ms)
    keys = ["sensor_id", "_block"]

    # Of several candidates in one millisecond only the first to arrive can alert, so a
    # block holds at most block_ms rows. The clock of a new sensor starts at zero.
    first = (candidates.filter(F.col("event_ms") > cooldown_ms)
             .groupBy("sensor_id", "event_ms").agg(F.min("seq").alias("seq"))
             .withColumn("_block", F.expr(f"event_ms div {block_ms}")))
    first = materialize(first, "cooldown")  # three of the steps below read it
    blocks = materialize(order_blocks(first, cooldown_ms), "cooldown-order")  # read twice
    rising = first.join(blocks, keys).filter(
        F.col("later_arrival").isNull() | (F.col("seq") < F.col("later_arrival")))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last alert that follows from each possible first one. Only these are held,
        and of those with the same outcome only the latest is passed on."""
        def rows():
            block = None
            for sensor, number, fresh, cols in _pieces(batches):
                if fresh:
                    if block is not None:
                        yield block.row()
                    block = _Outcomes(sensor, number, cols["newest"][0], cols["linked"][0], cooldown_ms)
                block.add(cols["event_ms"])
            if block is not None:
                yield block.row()
        return _emit(rows(), ["sensor_id", "_block", "newest", "entry", "exit"])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            last = 0
            for sensor, _, fresh, cols in _pieces(batches):
                last = int(cols["last"][0]) if fresh else last
                picked = pick_alerts(cols["event_ms"], last, cooldown_ms)
                if len(picked):
                    last = int(cols["event_ms"][picked[-1]])
                yield sensor, cols["seq"][picked]
        return _emit(rows(), ["sensor_id", "seq"])

    described = _together(
        rising.filter("describe").select(*keys, "seq", "event_ms", "newest", "linked"),
        keys, "seq").mapInArrow(describe, DESCRIBED)
    chained = last_before(materialize(described, "cooldown-blocks"), cooldown_ms, fanout)
    # an unlinked block starts anew whatever the last alert was
    last = F.when(F.col("linked"), F.col("last")).otherwise(F.col("newest"))
    chosen = _together(
        rising.join(chained, keys, "left").select(*keys, "seq", "event_ms", last.alias("last")),
        keys, "seq").mapInArrow(replay, "sensor_id string, seq long")
    return candidates.join(chosen, ["sensor_id", "seq"], "left_semi")


def _together(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Rows of equal keys in one task, sorted. They are dealt by a hash of their own: Spark drops
    a repartition by the keys of the join below it, and loses that join's partitioning where it
    turns the join into a broadcast while running."""
    return rows.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)


def order_blocks(first: DataFrame, cooldown_ms: int) -> DataFrame:
    """The blocks that can hold alerts, each with the first arrival in any later block, the
    newest time in any earlier one, and whether it is linked or described."""
    keys = ["sensor_id", "_block"]
    order = Window.partitionBy("sensor_id").orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # In falling order, as Spark adds to a frame that grows but folds one that shrinks anew
    # for every row.
    after = (Window.partitionBy("sensor_id").orderBy(F.desc("_block"))
             .rowsBetween(Window.unboundedPreceding, -1))
    blocks = first.groupBy(*keys).agg(
        F.min("seq").alias("arrival"), F.min("event_ms").alias("begin"),
        F.max("event_ms").alias("end"),
    ).withColumn("later_arrival", F.min("arrival").over(after))
    # older than something in a later block that arrived before it: never an alert
    blocks = blocks.filter(F.col("later_arrival").isNull()
                           | (F.col("arrival") < F.col("later_arrival")))
    blocks = blocks.withColumn("newest", F.coalesce(F.max("end").over(before), F.lit(0)))
    blocks = blocks.withColumn("linked", F.col("begin") - F.col("newest") <= cooldown_ms)
    return blocks.select(
        *keys, "later_arrival", "newest", "linked",
        (F.col("linked") | F.coalesce(F.lead("linked").over(order), F.lit(False)))
        .alias("describe"))


DESCRIBED = "sensor_id string, _block long, newest long, entry long, exit long"


def last_before(described: DataFrame, cooldown_ms: int, fanout: int = FANOUT) -> DataFrame:
    """The last alert before each described block: ``sensor_id``, ``_block``, ``last``.

    A sensor's first block, and any that is not linked, is described by one outcome
    (``ALWAYS``); for these ``last`` has no meaning.
    """
    levels = compositions(described, cooldown_ms, fanout)
    lasts = _walk(levels.pop().withColumns({"_group": F.lit(0).cast("long"),
                                            "start": F.lit(0).cast("long")}), cooldown_ms)
    while levels:
        starts = lasts.select("sensor_id", F.col("_block").alias("_group"),
                              F.col("last").alias("start"))
        members = levels.pop().withColumn("_group", F.expr(f"_block div {fanout}"))
        lasts = _walk(members.join(starts, ["sensor_id", "_group"]), cooldown_ms)
    return lasts


def compositions(described: DataFrame, cooldown_ms: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The descriptions of blocks, of groups of ``fanout`` blocks, of groups of those and so
    on, until a sensor spans no more than ``fanout`` (2 at least). Each level is a stored table."""
    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            here = steps = None
            for sensor, group, newest, entry, exit in _descriptions(batches):
                if (sensor, group) != here:
                    if here:
                        yield steps.row(*here)
                    here, steps = (sensor, group), _Steps(newest, entry, exit, cooldown_ms)
                else:
                    steps.then(entry, exit)
            if here:
                yield steps.row(*here)
        return _emit(rows(), ["sensor_id", "_block", "newest", "entry", "exit"])

    span = (described.groupBy("sensor_id").agg((F.max("_block") - F.min("_block")).alias("span"))
            .agg(F.max("span")).first()[0] or 0)
    levels = [described]
    while span >= fanout:
        span = -(-span // fanout)  # the most that it can be, wherever groups begin
        grouped = levels[-1].withColumn("_group", F.expr(f"_block div {fanout}"))
        levels.append(materialize(
            _together(grouped, ["sensor_id", "_group"], "_block", "entry")
            .mapInArrow(compose, DESCRIBED), "cooldown-groups"))
    return levels


def _walk(described: DataFrame, cooldown_ms: int) -> DataFrame:
    """The last alert before each member of a group, from the one before the group."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            here, last, after = None, 0, 0
            for sensor, block, fresh, cols in _pieces(batches):
                if fresh:
                    last = after
                    if (sensor, cols["_group"][0]) != here:
                        here, last = (sensor, cols["_group"][0]), int(cols["start"][0])
                    after = last
                    yield sensor, block, np.array([last])
                if after == last:
                    after = int(_outcome(cols["entry"], cols["exit"], np.array([last]), cooldown_ms)[0])
        return _emit(rows(), ["sensor_id", "_block", "last"])

    return (_together(described, ["sensor_id", "_group"], "_block", "entry")
            .mapInArrow(walk, "sensor_id string, _block long, last long"))


def _outcome(entry: np.ndarray, exit: np.ndarray, last: np.ndarray, cooldown: int) -> np.ndarray:
    """The last alert after a description, for each last alert before it: the outcome of the
    first entry beyond the cooldown, or the alert itself if there is none."""
    at = np.searchsorted(entry, last + cooldown, "right")
    return np.where(at < len(entry), np.append(exit, 0)[at], last)


class _Steps:
    """Descriptions of neighbours as one; its size stays that of one cooldown."""

    def __init__(self, newest: int, entry: np.ndarray, exit: np.ndarray, cooldown: int):
        self.newest, self.entry, self.exit, self.cooldown = newest, entry, exit, cooldown

    def then(self, entry: np.ndarray, exit: np.ndarray) -> None:
        # where the first ones raise no alert, the entries of the next decide
        later = entry > self.entry[-1]
        exits = np.append(_outcome(entry, exit, self.exit, self.cooldown), exit[later])
        entries = np.append(self.entry, entry[later])
        # the last alert before is no later than the newest candidate before
        reach = int(np.searchsorted(entries, self.newest + self.cooldown, "right")) + 1
        entries, exits = entries[:reach], exits[:reach]
        latest = np.append(exits[1:] != exits[:-1], True)
        self.entry, self.exit = entries[latest], exits[latest]

    def row(self, sensor: str, group: int) -> tuple:
        return sensor, group, self.newest, self.entry, self.exit


class _Outcomes:
    """Follows every possible first alert of a block to the last alert it leads to."""

    def __init__(self, sensor: str, block: int, newest: int, linked: bool, cooldown: int):
        self.head = (sensor, block, newest)
        self.linked, self.cooldown = linked, cooldown
        self.entries = self.at = np.zeros(0, np.int64)
        self.top, self.limit, self.complete = -1, None, False

    def add(self, arrived: np.ndarray) -> None:
        times = np.unique(np.maximum.accumulate(arrived))
        times = times[times > self.top]
        if not len(times):
            return
        self.top = int(times[-1])
        if self.limit is None:
            self.limit = int(times[0]) + self.cooldown
        if not self.complete:
            inside = int(np.searchsorted(times, self.limit, "right"))
            more = times[:inside + 1]
            self.complete = inside < len(times)
            self.entries = np.concatenate([self.entries, more])
            self.at = np.concatenate([self.at, more])
        moving = np.flatnonzero(self.at < self.top - self.cooldown)
        while len(moving):
            self.at[moving] = times[np.searchsorted(times, self.at[moving] + self.cooldown, "right")]
            moving = moving[self.at[moving] < self.top - self.cooldown]

    def row(self) -> tuple:
        if not self.linked:  # its first candidate is an alert
            return (*self.head, np.array([ALWAYS])[:len(self.at)], self.at[:1])
        latest = np.append(self.at[1:] != self.at[:-1], True) if len(self.at) else np.zeros(0, bool)
        return (*self.head, self.entries[latest], self.at[latest])


def _descriptions(batches: Iterator[pa.RecordBatch]
                  ) -> Iterator[tuple[str, int, int, np.ndarray, np.ndarray]]:
    """Whole descriptions with their group, sorted; each holds one cooldown at most."""
    held, parts = None, []

    def whole():
        return (*held, *(np.concatenate([p[c] for p in parts]) for c in ("entry", "exit")))

    for sensor, _, fresh, cols in _pieces(batches):
        if fresh and parts:
            yield whole()
            parts = []
        if fresh:
            held = (sensor, int(cols["_group"][0]), int(cols["newest"][0]))
        parts.append(cols)
    if parts:
        yield whole()


def _pieces(batches: Iterator[pa.RecordBatch]
            ) -> Iterator[tuple[str, int, bool, dict[str, np.ndarray]]]:
    """Sorted batches as pieces of one (sensor, block) each; the first piece of a block is marked."""
    here = None
    for batch in batches:
        rows = len(batch)
        if not rows:
            continue
        names, blocks = batch.column("sensor_id"), batch.column("_block")
        differs = pc.or_(pc.not_equal(names.slice(1), names.slice(0, rows - 1)),
                         pc.not_equal(blocks.slice(1), blocks.slice(0, rows - 1)))
        cuts = (np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1).tolist()
        cols = {name: batch.column(name).to_numpy(zero_copy_only=False)
                for name in batch.schema.names if name not in ("sensor_id", "_block")}
        for low, high in zip([0, *cuts], [*cuts, rows]):
            key = (names[low].as_py(), blocks[low].as_py())
            yield *key, key != here, {name: col[low:high] for name, col in cols.items()}
            here = key


def _emit(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``BATCH`` rows; single values are repeated to the row's length."""
    pending, size = [], 0
    for row in rows:
        if len(row[-1]):
            pending.append(row)
            size += len(row[-1])
        if size >= BATCH:
            yield _as_batch(pending, names)
            pending, size = [], 0
    if pending:
        yield _as_batch(pending, names)


def _as_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    lengths = [len(row[-1]) for row in rows]
    columns = []
    for i in range(len(names)):
        values = [row[i] for row in rows]
        if isinstance(values[0], np.ndarray):
            columns.append(pa.array(np.concatenate(values)))
        else:
            index = pa.array(np.repeat(np.arange(len(rows)), lengths))
            columns.append(pa.array(values).take(index))
    return pa.RecordBatch.from_arrays(columns, names=names)
