"""Presentation columns: labels, one-decimal numbers, alert identity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugeflow.functions.rounding import round_exact


def clock_label(col: Column) -> Column:
    return F.date_format(col, "HH:mm")


def one_decimal(col: Column) -> Column:
    """Text with one decimal and no thousands separator, exact ties away from zero."""
    return F.format_string("%.1f", F.signum(col) * round_exact(F.abs(col), 1, ties="up"))


def alert_key(id_col: Column, sensor_id: Column, timestamp: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.concat_ws("-", sensor_id, timestamp))


def to_json_record(*cols: str) -> Column:
    """The whole row as one JSON text; microseconds and nulls are kept."""
    return F.to_json(F.struct(*cols), {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "ignoreNullFields": "false",
    })


def archive_folder(col: Column) -> list[Column]:
    """Folder columns of the raw archive, from the time of archiving."""
    return [F.date_format(col, "yyyy").alias("year"), F.date_format(col, "MM").alias("month"),
            F.date_format(col, "dd").alias("day"), F.date_format(col, "HH").alias("hour")]
