"""Starting queries with settings that belong to one query."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

STATE_BATCH_BYTES = 1 << 24


@contextmanager
def query_conf(spark: SparkSession, **settings: str | None) -> Iterator[None]:
    """Set session options for the queries started inside; a query keeps its copy."""
    names = {k.replace("__", "."): v for k, v in settings.items() if v is not None}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def few_partitions(spark: SparkSession, per_core: int = 4) -> int:
    """State partitions for a query whose tasks hold one key at a time: every one starts a Python
    worker and opens a store in each micro-batch, so more than cores can use only cost time."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")),
               per_core * spark.sparkContext.defaultParallelism)


def start_files(rows: DataFrame, path: str, checkpoint: str, interval: str | None,
                file_format: str = "parquet", partition: str | None = None,
                state_partitions: int | None = None) -> StreamingQuery:
    """Append a stream to files, exactly once. ``interval=None`` takes what is there and stops.

    ``state_partitions`` is the number of shuffle partitions and thus of state
    stores; a checkpoint keeps the number it was created with.
    """
    writer = (rows.writeStream.outputMode("append").format(file_format)
              .option("checkpointLocation", checkpoint))
    if partition:
        writer = writer.partitionBy(partition)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    with query_conf(
            rows.sparkSession,
            spark__sql__shuffle__partitions=str(state_partitions) if state_partitions else None,
            # a state function gets rows by number and bytes, as some hold a block of readings
            spark__sql__execution__arrow__maxBytesPerBatch=str(STATE_BATCH_BYTES),
            spark__sql__streaming__stateStore__providerClass=(
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")):
        return writer.trigger(**trigger).start(path)


def finish(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query, however large its backlog is; its error, if any,
    is raised here. Tests give a limit."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} did not end in {timeout_s} s")
