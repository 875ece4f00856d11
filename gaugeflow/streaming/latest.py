"""The newest result row of each key, kept as a table by a stream.

The table lies in buckets of its key. A micro-batch is first reduced to its newest row per
key; then only the buckets that it touches are read, merged and written anew, as files of a
new version. A manifest, written last, says which version each bucket is in, so a reader sees
a micro-batch wholly or not at all, and an attempt that failed leaves files that no manifest
names. Merging keeps the newest of old and new rows and gives the same table when a
micro-batch comes again, so a retried batch does no harm. One stream at a time may write a
table. Files of replaced versions stay until ``drop_replaced`` is called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from gaugeflow.operators.serving import latest_per
from gaugeflow.sources.files import delete_folder, finished_folders, partition_values
from gaugeflow.sources.metadata import fixed_rows

# a manifest has a row for each; a table keeps the number it was made with
BUCKETS = 64
BUCKET, VERSION = "_bucket", "_version"
PLACES = StructType().add(BUCKET, StringType()).add(VERSION, StringType())


def latest_table_job(rows: DataFrame, key: str, path: str, checkpoint: str,
                     interval: str | None = "10 seconds", buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the newest row of each key of a result stream. ``interval=None`` takes what is
    there and stops."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (rows.writeStream.foreachBatch(lambda batch, _: merge_latest(batch, key, path, buckets))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def merge_latest(batch: DataFrame, key: str, path: str, buckets: int = BUCKETS) -> None:
    """Bring the rows of a batch into the table, as ``latest_per`` orders them."""
    spark = batch.sparkSession
    held = _places(spark, path)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")
    newest = latest_per(batch, key).select(*batch.columns).persist()
    try:
        # at most as many as there are buckets
        touched = {r[0] for r in newest.select(bucket).distinct().collect()}
        if not touched:
            return
        version = f"{_last(spark, path) + 1:012d}"
        old = _rows(spark, path, {b: v for b, v in held.items() if b in touched}, batch.schema)
        merged = latest_per(old.unionByName(newest), key).select(*batch.columns)
        (merged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.mode("overwrite")
         .partitionBy(BUCKET).parquet(f"{path}/data/{VERSION}={version}"))
        places = held | {b: version for b in touched}
        (fixed_rows(spark, sorted(places.items()), PLACES).coalesce(1).write.mode("overwrite")
         .json(f"{path}/manifest/{VERSION}={version}"))
    finally:
        newest.unpersist()


def latest_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest row of each key after the last whole micro-batch."""
    return _rows(spark, path, _places(spark, path), schema)


def drop_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the versions that the newest manifest does not name, and older manifests; the
    versions whose rows went. For times when no older reader and no writer is at work."""
    named = set(_places(spark, path).values())
    newest = f"{_last(spark, path):012d}"
    gone = [v for v in partition_values(spark, f"{path}/data", VERSION) if v not in named]
    for version in gone:
        delete_folder(spark, f"{path}/data/{VERSION}={version}")
    for version in partition_values(spark, f"{path}/manifest", VERSION):
        if version != newest:
            delete_folder(spark, f"{path}/manifest/{VERSION}={version}")
    return gone


def _last(spark: SparkSession, path: str) -> int:
    done = finished_folders(spark, f"{path}/manifest", VERSION)
    return int(done[-1]) if done else 0


def _places(spark: SparkSession, path: str) -> dict[str, str]:
    """Each bucket's version, by the newest finished manifest."""
    last = _last(spark, path)
    if not last:
        return {}
    rows = spark.read.schema(PLACES).json(f"{path}/manifest/{VERSION}={last:012d}").collect()
    return {r[BUCKET]: r[VERSION] for r in rows}


def _rows(spark: SparkSession, path: str, places: dict[str, str], schema: StructType) -> DataFrame:
    if not places:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields, *PLACES.fields])
    place: Column = F.concat_ws("/", BUCKET, VERSION)
    return (spark.read.schema(stored).parquet(f"{path}/data")
            .where(place.isin([f"{b}/{v}" for b, v in sorted(places.items())])).drop(BUCKET, VERSION))
