"""Events to closed one-minute windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.functions.parsing import accepted, parse_events
from gaugeflow.operators.windows import window_aggregates
from gaugeflow.schema import WATERMARK, WINDOW
from gaugeflow.streaming.start import start_files


def stream_aggregates(events: DataFrame, size: str = WINDOW, watermark: str = WATERMARK,
                      places: int | None = 2) -> DataFrame:
    """One row per window, when the newest event time is ``watermark`` past its end."""
    return window_aggregates(events, size, watermark, places)


def aggregate_job(envelope: DataFrame, path: str, checkpoint: str, strict: bool = False,
                  interval: str | None = "10 seconds",
                  state_partitions: int | None = None) -> StreamingQuery:
    events = accepted(parse_events(envelope, strict))
    return start_files(stream_aggregates(events), path, checkpoint, interval,
                       partition="event_date", state_partitions=state_partitions)
