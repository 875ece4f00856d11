from datetime import date, datetime, timedelta

import pytest

from gaugeflow.operators.serving import dashboard_kpis
from gaugeflow.sources.files import partition_values
from gaugeflow.sources.results import (
    day_figures, merged_figures, newest_dates, stored_dates, stored_latest, write_results)

AGGS = "window_start timestamp, sensor_id string, event_count long, event_date date"
ALERTS = "seq long, severity string, event_date date"


def aggs(spark, days=5, sensors=40):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(days=d, minutes=m), f"s{(d * 7 + i) % (sensors + d)}", d + m + i,
             (start + timedelta(days=d)).date()) for d in range(days) for m in range(3) for i in range(sensors)]
    return spark.createDataFrame(rows, AGGS)


def alerts(spark, days=5):
    rows = [(d * 100 + i, "critical" if i % 3 else "warning", date(2024, 1, 1 + d))
            for d in range(1, days) for i in range(d * 4)]
    return spark.createDataFrame(rows, ALERTS)


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_dates_come_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "aggs")
    assert stored_dates(spark, path) == []
    write_results(aggs(spark), path)
    write_results(spark.createDataFrame([(None, "x", 1, None)], AGGS), path)
    assert stored_dates(spark, path) == [f"2024-01-0{d}" for d in range(1, 6)]
    assert len(partition_values(spark, path, "event_date")) == 6
    # a folder whose files nobody could open still shows its date
    (tmp_path / "aggs" / "event_date=2024-02-01").mkdir()
    (tmp_path / "aggs" / "event_date=2024-02-01" / "part-0.parquet").write_text("broken")
    assert stored_dates(spark, path)[-1] == "2024-02-01"


def test_newest_rows_open_their_dates_only(spark, tmp_path):
    path = str(tmp_path / "aggs")
    write_results(aggs(spark), path)
    day = newest_dates(spark, path)
    assert {r.event_date for r in day.collect()} == {date(2024, 1, 5)}
    rows = stored_latest(spark, path, 150, ["window_start", "sensor_id"])
    want = aggs(spark).orderBy("window_start", "sensor_id").collect()[-150:]
    assert [tuple(r) for r in rows.collect()] == [tuple(r) for r in want]
    for scan in [*scans(day), *scans(rows)]:
        assert "PartitionFilters: [isnotnull(event_date" in scan and ">=" in scan
    assert stored_latest(spark, path, 10_000, ["window_start", "sensor_id"]).count() == 600
    with pytest.raises(ValueError):
        stored_latest(spark, path, 0, ["window_start"])


def test_figures_of_days_merge(spark, tmp_path):
    want = dashboard_kpis(aggs(spark), alerts(spark)).first().asDict()
    days = str(tmp_path / "days")
    write_results(day_figures(aggs(spark), alerts(spark)), days)
    stored = spark.read.parquet(days)
    assert stored.count() == 5
    assert merged_figures(stored).first().asDict() == want
    # a day more is a row more
    write_results(day_figures(spark.createDataFrame(
        [(datetime(2024, 3, 1), "new", 7, date(2024, 3, 1))], AGGS), alerts(spark).limit(0)), days)
    got = merged_figures(spark.read.parquet(days)).first()
    assert (got.sensor_count, got.events_per_min) == (want["sensor_count"] + 1, 7)
    assert got.active_alerts == want["active_alerts"]
    empty = merged_figures(stored.limit(0)).first()
    assert (empty.active_alerts, empty.sensor_count, empty.latest_window) == (0, 0, None)
