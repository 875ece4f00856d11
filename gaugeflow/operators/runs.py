"""Runs of consecutive breaches per sensor, in arrival order.

A run depends on the order of a sensor's readings, so the obvious plan sorts
each sensor in one task. Here the readings are cut into blocks of arrival
numbers instead: one task sees at most ``block`` readings of a sensor, and the
run that is open at a block's end reaches the next block as one small row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gaugeflow.schema import MIN_CONSECUTIVE
from gaugeflow.session import materialize

BLOCK = 1 << 20
START = "struct<seq:bigint,event_time:timestamp>"


def breach_runs(events: DataFrame, min_consecutive: int = MIN_CONSECUTIVE,
                block: int = BLOCK) -> DataFrame:
    """Breach rows with ``consecutive_breaches`` and the first row of their run.

    Needs ``sensor_id``, ``seq`` (unique per sensor), ``event_time``, ``breach``.
    ``run_seq``/``run_since`` identify the run and tell when it began.
    """
    keys = ["sensor_id", "_block"]
    rest = [c for c in events.columns if c not in ("sensor_id", "seq", "event_time", "breach")]
    rows = events.select(
        "sensor_id", "seq", "event_time", "breach", F.expr(f"seq div {block}").alias("_block"),
        # readings below the threshold only end a run, so nothing else of them is moved
        F.when(F.col("breach"), F.struct(*rest)).alias("_rest"))

    here = Window.partitionBy(*keys).orderBy("seq")
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    begins = F.col("breach") & F.coalesce(~F.lag("breach").over(here), F.lit(True))
    local = rows.withColumns({
        "_count": F.sum(F.col("breach").cast("long")).over(so_far),
        "_start": F.when(begins, F.struct("seq", "event_time")),
        "_last": F.lead("seq").over(here).isNull(),
    }).withColumns({
        # breaches counted up to the last normal reading; NULL before the first one
        "_before": F.max(F.when(~F.col("breach"), F.col("_count"))).over(so_far),
        "_start": F.last("_start", ignorenulls=True).over(so_far),
    }).withColumns({
        "_run": F.col("_count") - F.coalesce("_before", F.lit(0)),
        "_open": F.col("_before").isNull(),
    }).drop("_count", "_before")

    # Every reading is sorted once. What can still matter is written down: possible
    # results and the last reading of each block.
    possible = F.col("breach") & (F.col("_open") | (F.col("_run") >= min_consecutive))
    kept = materialize(local.filter(possible | F.col("_last")), "runs")
    # only readings before a block's first normal one depend on earlier blocks
    closed = kept.filter(possible & ~F.col("_open")).withColumns({
        "carry": F.lit(0).cast("long"), "carry_start": F.lit(None).cast(START)})
    opened = kept.filter(possible & F.col("_open")).join(
        _carry(kept.filter("_last")), keys, "left").withColumn(
        "carry", F.coalesce("carry", F.lit(0)))
    start = F.when(F.col("carry") > 0, F.col("carry_start")).otherwise(F.col("_start"))
    return closed.unionByName(opened).select(
        "sensor_id", "seq", "event_time", "_rest.*",
        (F.col("_run") + F.col("carry")).cast("int").alias("consecutive_breaches"),
        start["seq"].alias("run_seq"), start["event_time"].alias("run_since"),
    ).filter(F.col("consecutive_breaches") >= min_consecutive)


def _carry(blocks: DataFrame) -> DataFrame:
    """Length and start of the run that is open when a block begins, from the blocks'
    last readings."""
    order = Window.partitionBy("sensor_id").orderBy("_block")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # a block with a normal reading starts the count anew with its own tail
    counted = blocks.select(
        "sensor_id", "_block", "_run", "_open", "_start", F.sum("_run").over(so_far).alias("total"),
    ).withColumn(
        "base", F.max(F.when(~F.col("_open"), F.col("total") - F.col("_run"))).over(so_far)
    ).withColumn("length", F.col("total") - F.coalesce("base", F.lit(0)))
    fresh = (F.col("_run") > 0) & (
        ~F.col("_open") | (F.coalesce(F.lag("length").over(order), F.lit(0)) == 0))
    started = counted.withColumn("start", F.when(fresh, F.col("_start"))).withColumn(
        "start", F.last("start", ignorenulls=True).over(so_far))
    return started.select(
        "sensor_id", "_block",
        F.coalesce(F.lag("length").over(order), F.lit(0)).alias("carry"),
        F.lag("start").over(order).alias("carry_start"))
