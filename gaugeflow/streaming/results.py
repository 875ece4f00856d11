"""Result streams to topics, and both result topics back into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow import schema as S
from gaugeflow.sources.results import from_records, rejected_records, to_records
from gaugeflow.streaming.start import start_files

TABLES = {S.AGGREGATES_TOPIC: S.AGGREGATE, S.ALERTS_TOPIC: S.ALERT}


def publish_job(rows: DataFrame, topic: str, path: str, checkpoint: str,
                interval: str | None = "10 seconds",
                state_partitions: int | None = None) -> StreamingQuery:
    """A result stream as JSON records in files with the broker's columns."""
    return start_files(to_records(rows, topic), path, checkpoint, interval, "json",
                       state_partitions=state_partitions)


def result_tables_job(records: DataFrame, path: str, checkpoint: str,
                      interval: str | None = "10 seconds") -> list[StreamingQuery]:
    """One stream of both result topics, kept as one table per topic and date. Records that
    hold no result are kept as they came, in a folder of their own. The tables hold
    everything; how many rows a reader sees is decided when reading."""
    queries = []
    for topic, schema in TABLES.items():
        mine = records.filter(F.col("topic") == topic)
        queries.append(start_files(from_records(mine, schema), f"{path}/{topic}",
                                   f"{checkpoint}/{topic}", interval, partition="event_date"))
        queries.append(start_files(rejected_records(mine, schema), f"{path}/{topic}-rejected",
                                   f"{checkpoint}/{topic}-rejected", interval, "json"))
    return queries
