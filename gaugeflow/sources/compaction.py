"""Closed hours of the raw archive, rewritten into few files.

A stream leaves small files in every hour. ``compact_archive`` copies the hours that have
closed to a store of its own, in files of a sensible size, and then writes a manifest that
says up to which hour the store is whole. Readers follow the newest finished manifest: hours
before it come from the store, later ones from the archive, so they see a compaction wholly
or not at all, and never read a closed hour's small files again. A run that failed leaves
data without a finished manifest; readers pass it over and the next run replaces it.

The archive itself is not changed: a stream's own list names its files, and its readers
would miss them. Only one compaction of a store may run at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeflow.sources.archive import (
    FOLDERS, HOUR_FOLDER, ROWS_PER_FILE, archive_objects, from_line)
from gaugeflow.sources.files import finished_folders, partition_values

LINES = "value string, year string, month string, day string, hour string"
MANIFEST = "since string, until string, objects long, files long, events long"


def _hour() -> Column:
    """The hour of a line, from its folder columns; filters on it read matching folders only."""
    return F.concat(*[F.col(c) for c in FOLDERS])


def _object_hour() -> Column:
    return F.concat(*[F.regexp_extract("object_key", HOUR_FOLDER, i + 1)
                      for i in range(len(FOLDERS))])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    if not partition_values(spark, path, FOLDERS[0]):  # no folder columns to be read
        return spark.createDataFrame([], LINES)
    return spark.read.schema(LINES).text(path)


def newest_hour(spark: SparkSession, path: str) -> str:
    """The newest hour (yyyyMMddHH) that holds objects, from the listing; none is ''."""
    newest = archive_objects(spark, path).agg(F.max(_object_hour())).first()[0]
    return newest or ""


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """One row per finished compaction: its hours, objects before and files after, events."""
    rows = spark.createDataFrame([], f"{MANIFEST}, version string")
    versions = finished_folders(spark, f"{store}/manifest", "version")
    if versions:
        rows = spark.read.schema(f"{MANIFEST}, version string").json(f"{store}/manifest").where(
            F.col("version").isin(versions))
    return rows


def compact_archive(spark: SparkSession, path: str, store: str, until: str | None = None,
                    rows_per_file: int = ROWS_PER_FILE) -> str | None:
    """Compact the hours (yyyyMMddHH) before ``until`` that the store lacks; the version
    written, or None where nothing has closed.

    Without ``until`` all hours before the newest one are closed. That is exact for an archive
    that one stream writes: its micro-batches follow each other and each lies in one hour, so
    none adds to an hour once a later one shows. With several writers give an ``until`` that
    all of them have passed.
    """
    versions = finished_folders(spark, f"{store}/manifest", "version")
    since = _until(spark, store, versions)
    until = newest_hour(spark, path) if until is None else until
    objects = archive_objects(spark, path).where(
        (_object_hour() >= since) & (_object_hour() < until)).count()
    if not objects:
        return None
    version = f"{int(versions[-1]) + 1 if versions else 1:08d}"
    data = f"{store}/data/version={version}"
    lines = _lines(spark, path).where((_hour() >= since) & (_hour() < until))
    (lines.hint("rebalance", *FOLDERS).write.mode("overwrite")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(*FOLDERS).text(data))
    files = archive_objects(spark, data).count()
    events = _lines(spark, data).count()
    (spark.range(1).select(
        F.lit(since).alias("since"), F.lit(until).alias("until"), F.lit(objects).alias("objects"),
        F.lit(files).alias("files"), F.lit(events).alias("events"))
     .write.mode("overwrite").json(f"{store}/manifest/version={version}"))
    return version


def read_compacted_hours(spark: SparkSession, path: str, store: str) -> DataFrame:
    """All archived texts with folder columns to filter on: closed hours from the store, later
    ones from the archive."""
    versions = finished_folders(spark, f"{store}/manifest", "version")
    lines = _lines(spark, path).where(_hour() >= _until(spark, store, versions))
    if versions:
        kept = (spark.read.schema(f"{LINES}, version string").text(f"{store}/data")
                .where(F.col("version").isin(versions)).drop("version"))
        lines = kept.unionByName(lines)
    return lines.withColumn("value", from_line(F.col("value")))


def _until(spark: SparkSession, store: str, versions: list[str]) -> str:
    if not versions:
        return ""
    newest = f"{store}/manifest/version={versions[-1]}"
    return spark.read.schema(MANIFEST).json(newest).first().until
