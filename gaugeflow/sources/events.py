"""Event sources. All give the broker's columns, so the jobs do not care which it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugeflow.functions.parsing import last_of_each, parse_iso_time
from gaugeflow.schema import ENVELOPE


#: Bytes of files in a micro-batch, unless told otherwise.
BYTES_PER_TRIGGER = 4 << 30
#: Equal lines that are numbered in one row's turn.
EQUAL_LINES = 1 << 14


def kafka_events(spark: SparkSession, servers: str, topics: str | list[str],
                 starting: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """A stream of broker records; several topics are told apart by ``topic``.

    ``starting`` counts for the first start only, later ones resume from the
    checkpoint. Needs the Kafka connector on the class path.
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", names).option("startingOffsets", starting))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields]
    return reader.load().select(*columns)


def file_events(spark: SparkSession, path: str, file_format: str = "json", stream: bool = False,
                max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Broker records kept in JSON or Parquet files. A micro-batch takes files up to a number
    or, if none is given, up to a size (one file at least); the others wait."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif stream:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.schema(ENVELOPE).format(file_format).load(path)


def _decoded(lines: DataFrame) -> DataFrame:
    """The lines with their fields; a generator's output is decoded once."""
    lines = lines.select("*", F.explode_outer(F.array(F.from_json("value", "map<string,string>"))).alias("fields"))
    return lines.withColumn("fields", last_of_each(F.col("fields")))


def jsonl_events(spark: SparkSession, path: str, topic: str = "", stream: bool = False,
                 seq_field: str | None = None) -> DataFrame:
    """Plain JSON Lines files, one event per line; unreadable lines stay as they are.

    Lines carry no arrival number. ``seq_field`` names an event field that holds
    one; otherwise the time of the event in microseconds is used, which is the
    order a generator writes in. Lines without either get negative numbers that
    follow from file and text: distinct and repeatable on stored files (equal lines
    of a file are told apart by counting them); on a stream, which cannot count,
    equal lines of a file share one. The file time stands in for the broker's.
    """
    reader = spark.readStream if stream else spark.read
    lines = _decoded(reader.text(path).select(
        "value", "_metadata.file_path", "_metadata.file_modification_time"))
    field = lambda name: F.element_at("fields", F.lit(name))
    if seq_field:
        seq = field(seq_field).try_cast("long")
    else:
        seq = F.unix_micros(parse_iso_time(F.coalesce(field("event_time"), field("timestamp"))))
    text_hash = F.xxhash64("file_path", "value")
    if stream:
        other = -F.shiftrightunsigned(text_hash, 1) - 1
    else:
        # 31 bits of the hash, then the place among the lines that share them
        group = F.shiftrightunsigned(text_hash, 33)
        lines = lines.withColumn("_seq", seq).withColumn("_numbered", F.col("_seq").isNotNull())
        with_time = lines.where("_numbered").drop("_numbered")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a number given is not reduced
        # equal lines are one row with a count until they are numbered, and dealt out in parts
        equal = (lines.where("NOT _numbered").groupBy("file_path", "value", "file_modification_time")
                 .agg(F.count("*").alias("_equal")).withColumn("_group", group))
        earlier = Window.partitionBy("_group").orderBy("file_path", "value").rowsBetween(
            Window.unboundedPreceding, -1)
        part = F.explode(F.sequence(F.lit(0), F.floor((F.col("_equal") - 1) / EQUAL_LINES)))
        dealt = (equal.withColumn("_before", F.coalesce(F.sum("_equal").over(earlier), F.lit(0)))
                 .withColumn("_part", part).repartition(parts, "_group", "_part"))
        place = F.explode(F.sequence(
            F.col("_part") * EQUAL_LINES + 1, F.least((F.col("_part") + 1) * EQUAL_LINES, F.col("_equal"))))
        without = dealt.withColumn("_place", place).withColumn(
            "_seq", -(F.shiftleft(F.col("_group"), 32) + F.col("_before") + F.col("_place")))
        lines = with_time.unionByName(_decoded(without.select(
            "value", "file_path", "file_modification_time", "_seq")))
        seq, other = F.col("_seq"), F.lit(None).cast("long")
    return lines.select(
        field("sensor_id").alias("key"), "value",
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
        F.coalesce(seq, other).alias("offset"),
        F.col("file_modification_time").alias("timestamp"))
