"""The streaming jobs from the command line, for spark-submit.

    spark-submit --py-files gaugeflow.zip gaugeflow/jobs.py aggregates \\
        --servers broker:9092 --out /tables --checkpoint /checkpoints

``--files`` reads broker records from JSON files instead of the broker.
"""

from __future__ import annotations

import argparse

from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.schema import AGGREGATES_TOPIC, ALERTS_TOPIC, EVENTS_TOPIC
from gaugeflow.session import build_session, ship_code
from gaugeflow.sources.archive import archive_job
from gaugeflow.sources.events import BYTES_PER_TRIGGER, file_events, kafka_events
from gaugeflow.sources.metadata import load_metadata
from gaugeflow.streaming.aggregates import aggregate_job, stream_aggregates
from gaugeflow.streaming.alerts import alert_job, stream_alerts
from gaugeflow.streaming.durations import lasting_job
from gaugeflow.streaming.results import publish_job, result_tables_job
from gaugeflow.streaming.start import finish
from gaugeflow.streaming.windows import windows_and_late_job
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


# what one micro-batch of the broker takes unless told otherwise; the rest waits, nothing is
# dropped. Files are capped by their bytes.
RECORDS_PER_TRIGGER = 5_000_000


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["aggregates", "windows-and-late", "alerts", "lasting-alerts", "archive",
                                        "publish-aggregates", "publish-alerts", "tables"])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="addresses of the broker")
    source.add_argument("--files", help="folder of JSON files with the broker's columns")
    parser.add_argument("--topic", default=EVENTS_TOPIC)
    parser.add_argument("--starting", default="latest")
    parser.add_argument("--max-per-trigger", type=int,
                        help=f"records of the broker ({RECORDS_PER_TRIGGER}) or files "
                             f"(otherwise {BYTES_PER_TRIGGER} bytes of them) in a micro-batch")
    parser.add_argument("--state-partitions", type=int,
                        help="state stores of a new checkpoint")
    parser.add_argument("--metadata", default="metadata.json")
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--min-seconds", type=int, default=60,
                        help="how long a breach has to last (lasting-alerts)")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--once", action="store_true", help="take what is there and stop")
    return parser.parse_args(args)


def main(args: list[str] | None = None) -> None:
    opts = arguments(args)
    spark = build_session(f"sensor-{opts.job}")
    ship_code()
    topic = [AGGREGATES_TOPIC, ALERTS_TOPIC] if opts.job == "tables" else opts.topic
    if opts.servers:
        source = kafka_events(spark, opts.servers, topic, opts.starting,
                              opts.max_per_trigger or RECORDS_PER_TRIGGER)
    else:
        source = file_events(spark, opts.files, stream=True,
                             max_files_per_trigger=opts.max_per_trigger)
    for query in start(spark, opts, source):
        finish(query) if opts.once else query.awaitTermination()


def start(spark: SparkSession, opts: argparse.Namespace, source: DataFrame) -> list[StreamingQuery]:
    out, checkpoint = f"{opts.out}/{opts.job}", f"{opts.checkpoint}/{opts.job}"
    when = {"interval": None} if opts.once else {}
    kept = when | {"state_partitions": opts.state_partitions}
    if opts.job == "tables":
        return result_tables_job(source, out, checkpoint, **when)
    if opts.job == "archive":
        return [archive_job(source, out, checkpoint, **when)]
    if opts.job == "aggregates":
        return [aggregate_job(source, out, checkpoint, opts.strict, **kept)]
    if opts.job == "windows-and-late":
        return [windows_and_late_job(source, out, checkpoint, opts.strict, **kept)]
    if opts.job == "lasting-alerts":
        metadata = load_metadata(spark, opts.metadata)
        return [lasting_job(source, metadata, opts.min_seconds, out, checkpoint, opts.strict, **kept)]
    if opts.job == "alerts":
        metadata = load_metadata(spark, opts.metadata)
        return [alert_job(source, metadata, out, checkpoint, opts.strict, **kept)]
    events = accepted(parse_events(source, opts.strict))
    if opts.job == "publish-aggregates":
        return [publish_job(stream_aggregates(events), AGGREGATES_TOPIC, out, checkpoint, **kept)]
    alerts = stream_alerts(events, load_metadata(spark, opts.metadata))
    return [publish_job(alerts, ALERTS_TOPIC, out, checkpoint, **kept)]


if __name__ == "__main__":
    main()
