"""Result records on topics, result tables on storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from gaugeflow.functions.display import to_json_record
from gaugeflow.sources.files import partition_values, refuse_stream_output

BROKEN = "_broken"
# the folder of rows without a date
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
# two to this power registers of a sketch of distinct sensors
SKETCH = 16


def to_records(rows: DataFrame, topic: str, key: str | None = None,
               envelope: tuple[str, ...] = ()) -> DataFrame:
    """Rows as broker records: JSON value, topic, and a key only where one is named.

    ``envelope`` names columns that go beside the value, not into it: files have no
    broker that would add an offset.
    """
    inside = [c for c in rows.columns if c not in envelope]
    return rows.select(
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
        to_json_record(*inside).alias("value"), F.lit(topic).alias("topic"), *envelope)


def publish_events(events: DataFrame, topic: str, envelope: tuple[str, ...] = ()) -> DataFrame:
    """Events keyed by sensor, so that a sensor stays in one partition and in order."""
    return to_records(events, topic, key="sensor_id", envelope=envelope)


def split_by_topic(records: DataFrame, topics: list[str]) -> dict[str, DataFrame]:
    return {topic: records.filter(F.col("topic") == topic) for topic in topics}


def _decoded(records: DataFrame, schema: StructType) -> DataFrame:
    # as a generator's output the row is decoded once, whatever is asked of it
    with_text = StructType([*schema.fields, StructField(BROKEN, StringType())])
    row = F.from_json("value", with_text, {"columnNameOfCorruptRecord": BROKEN})
    return records.select("*", F.explode_outer(F.array(row)).alias("row"))


def _is_broken() -> Column:
    return F.col("row").isNull() | F.col(f"row.{BROKEN}").isNotNull()


def from_records(records: DataFrame, schema: StructType) -> DataFrame:
    """Rows of the records that hold one; ``rejected_records`` has the others."""
    return _decoded(records, schema).filter(~_is_broken()).select("row.*").drop(BROKEN)


def rejected_records(records: DataFrame, schema: StructType) -> DataFrame:
    """Records whose value is no JSON object of the schema, as they came."""
    return _decoded(records, schema).filter(_is_broken()).drop("row")


def write_kafka(records: DataFrame, servers: str, checkpoint: str | None = None
                ) -> StreamingQuery | None:
    """Records to the broker; a stream needs a checkpoint. Needs the Kafka connector."""
    if not records.isStreaming:
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
        return None
    return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("checkpointLocation", checkpoint).start())


def write_records(records: DataFrame, path: str) -> None:
    """Records to files with the broker's columns, one folder per topic."""
    refuse_stream_output(records.sparkSession, path)
    records.write.mode("append").partitionBy("topic").json(path)


def write_results(rows: DataFrame, path: str, partition: str = "event_date",
                  mode: str = "append") -> None:
    """A result table in folders per date. Rows are first brought together by date;
    the rebalance splits a large date over several files and joins small ones. A stream's
    own folder is refused, because its readers see only what the stream wrote."""
    refuse_stream_output(rows.sparkSession, path)
    rows.hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(path)


def history(spark: SparkSession, path: str, date_from: str, date_to: str,
            partition: str = "event_date") -> DataFrame:
    """Stored results between two dates, both included; other folders are not read."""
    day = F.col(partition)
    return spark.read.parquet(path).filter(
        (day >= F.lit(date_from).cast("date")) & (day <= F.lit(date_to).cast("date")))


def stored_dates(spark: SparkSession, path: str, partition: str = "event_date") -> list[str]:
    """The dates of a stored table, oldest first, from its folder names alone."""
    return [d for d in partition_values(spark, path, partition) if d != NO_DATE]


def stored_latest(spark: SparkSession, path: str, limit: int, order: list[str],
                  partition: str = "event_date") -> DataFrame:
    """The newest rows of a stored table, oldest first, from its newest dates only.

    Only folder names are read to learn the dates. Dates are added, newest first and
    twice as many each time, until they hold enough rows; ``order`` must not go
    against the dates. Rows without a date are no newest rows.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    table, dates = spark.read.parquet(path), stored_dates(spark, path, partition)[::-1]
    take, rows = 1, table.limit(0)
    while dates:
        rows = _since(table, partition, dates[min(take, len(dates)) - 1])
        if take >= len(dates) or rows.limit(limit).count() >= limit:
            break
        take *= 2
    return rows.orderBy(*[F.desc(c) for c in order]).limit(limit).orderBy(*order)


def newest_dates(spark: SparkSession, path: str, days: int = 1,
                 partition: str = "event_date") -> DataFrame:
    """Rows of the last ``days`` dates that a stored table holds."""
    table, dates = spark.read.parquet(path), stored_dates(spark, path, partition)
    return _since(table, partition, dates[-days:][0]) if dates else table.limit(0)


def _since(table: DataFrame, partition: str, oldest: str) -> DataFrame:
    return table.filter(F.col(partition) >= F.lit(oldest).cast("date"))


def day_figures(aggs: DataFrame, alerts: DataFrame) -> DataFrame:
    """The dashboard's figures as one row per date that can be merged: sensors as a sketch,
    which is exact for some thousands of sensors and off by about 0.4 percent beyond."""
    windows = aggs.groupBy("event_date", "window_start").agg(
        F.sum("event_count").alias("events"), F.hll_sketch_agg("sensor_id", SKETCH).alias("sensors"))
    days = windows.groupBy("event_date").agg(
        F.max("window_start").alias("latest_window"), F.max_by("events", "window_start").alias("events"),
        F.hll_union_agg("sensors").alias("sensors"))
    raised = alerts.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("alerts"), F.count_if(F.col("severity") == "critical").alias("critical"))
    return days.join(raised, "event_date", "full")


def merged_figures(days: DataFrame) -> DataFrame:
    """The key figures of ``dashboard_kpis`` over all rows of ``day_figures``."""
    return days.agg(
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("active_alerts"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical_alerts"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sensors")), F.lit(0)).alias("sensor_count"),
        F.max("latest_window").alias("latest_window"),
        F.coalesce(F.max_by("events", "latest_window"), F.lit(0)).alias("events_per_min"))
