"""The raw archive: every event text, to be had back as it was, by hour of archiving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.functions.display import archive_folder
from gaugeflow.schema import ARCHIVE_INTERVAL
from gaugeflow.sources.files import refuse_stream_output

FOLDERS = ["year", "month", "day", "hour"]
ROWS_PER_FILE = 1_000_000
# from so many new objects on, counting reads the archive instead of a list of them
MANY_OBJECTS = 1000
# a control character that no JSON text holds outside a string
MARK = "\u001e"
MAX_CHARS = 2 ** 31 - 1
# matches raw/2024/01/31/23/ and year=2024/month=01/day=31/hour=23/
HOUR_FOLDER = r"(?:year=)?(\d{4})/(?:month=)?(\d{2})/(?:day=)?(\d{2})/(?:hour=)?(\d{2})/[^/]*$"


def as_line(value: Column) -> Column:
    """A text as one line. Almost all stay as they are; a text with a line break, one that
    begins with the mark itself, and a missing one are marked and written as base64."""
    odd = value.rlike(r"[\r\n]") | value.startswith(MARK)
    coded = F.concat(F.lit(MARK), F.base64(F.encode(value, "UTF-8")))
    return F.when(value.isNull(), F.lit(MARK + MARK)).when(odd, F.regexp_replace(coded, r"\s", "")
                                                           ).otherwise(value)


def from_line(line: Column) -> Column:
    """The text of a line, as it was."""
    plain = F.decode(F.unbase64(F.substring(line, 2, MAX_CHARS)), "UTF-8")
    return (F.when(line == F.lit(MARK + MARK), F.lit(None).cast("string"))
            .when(line.startswith(MARK), plain).otherwise(line))


def archive_lines(envelope: DataFrame, at: Column | None = None) -> DataFrame:
    """Event texts as lines with their folder columns; ``at`` is a time to file them under
    other than that of archiving."""
    return envelope.select(as_line(F.col("value")).alias("value"),
                           *archive_folder(F.current_timestamp() if at is None else at))


def archive_job(envelope: DataFrame, path: str, checkpoint: str,
                interval: str | None = ARCHIVE_INTERVAL,
                rows_per_file: int = ROWS_PER_FILE, at: Column | None = None) -> StreamingQuery:
    """Append a stream to the archive, once per interval; ``None`` takes what is there
    and stops. The source's cap per trigger is the size at which a batch ends before its
    time, and no file holds more than ``rows_per_file`` events."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (archive_lines(envelope, at).writeStream.format("text").partitionBy(*FOLDERS)
            .option("maxRecordsPerFile", rows_per_file)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start(path))


def archive_batch(envelope: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE,
                  at: Column | None = None) -> None:
    """Append stored records. A stream's own folder is refused, because its readers see
    only what the stream wrote."""
    refuse_stream_output(envelope.sparkSession, path)
    (archive_lines(envelope, at).hint("rebalance", *FOLDERS).write.mode("append")
     .option("maxRecordsPerFile", rows_per_file).partitionBy(*FOLDERS).text(path))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived lines with their hour and object, whichever program wrote them."""
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .select(from_line(F.col("value")).alias("value"), F.col("_metadata.file_path").alias("object_key"),
                     F.col("_metadata.file_modification_time").alias("written_at")))
    return lines.withColumns({
        name: F.regexp_extract("object_key", HOUR_FOLDER, i + 1)
        for i, name in enumerate(FOLDERS)})


def read_archive_hours(spark: SparkSession, path: str) -> DataFrame:
    """The archive as written here, with folder columns to filter on; only matching
    folders are read."""
    schema = "value string, year string, month string, day string, hour string"
    return spark.read.schema(schema).text(path).withColumn("value", from_line(F.col("value")))


def archive_objects(spark: SparkSession, path: str) -> DataFrame:
    """Every object with its time and size, from the folder listing; no event is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.col("path").alias("object_key"), F.col("modificationTime").alias("written_at"),
        F.col("length").alias("bytes"))


def archive_status(spark: SparkSession, path: str, counted: DataFrame | None = None) -> DataFrame:
    """Objects, events and the newest object.

    ``counted`` is what ``count_objects`` stored before; only objects it lacks are read.
    """
    objects = archive_objects(spark, path)
    events = count_objects(spark, path, counted)
    rows = objects.withColumn("events", F.lit(0).cast("long")).select(
        "object_key", "written_at", "events", F.lit(1).alias("object")).unionByName(
        events.select("events", F.lit(0).alias("object")), allowMissingColumns=True)
    return rows.agg(
        F.coalesce(F.sum("object"), F.lit(0)).alias("objects_written"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events_archived"),
        F.max_by("object_key", F.struct("written_at", "object_key")).alias("last_object_key"))


def count_objects(spark: SparkSession, path: str, counted: DataFrame | None = None) -> DataFrame:
    """Events per object. Objects never change, so those in ``counted`` are not read again."""
    if counted is None:
        return _events_of(read_archive(spark, path))
    known = counted.select("object_key", "events")
    fresh = archive_objects(spark, path).join(known, "object_key", "left_anti")
    paths = [r.object_key for r in fresh.select("object_key").limit(MANY_OBJECTS).collect()]
    if not paths:
        return known
    if len(paths) < MANY_OBJECTS:
        lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("object_key"))
        return known.unionByName(_events_of(lines))
    rest = read_archive(spark, path).join(known, "object_key", "left_anti")
    return known.unionByName(_events_of(rest))


def _events_of(lines: DataFrame) -> DataFrame:
    return lines.groupBy("object_key").agg(F.count(F.lit(1)).alias("events"))
