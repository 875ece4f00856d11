from pyspark.sql import functions as F

from gaugeflow.sources import archive
from gaugeflow.sources.compaction import (
    compact_archive, manifest, newest_hour, read_compacted_hours)

TEXTS = ['{"a":1}', "two\r\nlines", "\u001emark", "", None, "é\n日"]


def _add(spark, path, hours, rows_per_file=1):
    rows = [(t, f"2024-01-{h // 24 + 1:02d} {h % 24:02d}:30:00") for h in hours for t in TEXTS]
    archive.archive_batch(spark.createDataFrame(rows, "value string, at string"), path,
                          rows_per_file, at=F.col("at").cast("timestamp"))


def _texts(df):
    return sorted((r.year + r.month + r.day + r.hour, repr(r.value)) for r in df.collect())



def test_closed_hours_come_from_few_files(spark, tmp_path):
    raw, store = str(tmp_path / "raw"), str(tmp_path / "store")
    _add(spark, raw, [0, 9, 9, 25])
    want = _texts(archive.read_archive_hours(spark, raw))
    assert _texts(read_compacted_hours(spark, raw, store)) == want and len(want) == 24
    assert manifest(spark, store).count() == 0 and newest_hour(spark, raw) == "2024010201"

    assert compact_archive(spark, raw, store, until="2024010109") == "00000001"
    assert _texts(read_compacted_hours(spark, raw, store)) == want
    assert compact_archive(spark, raw, store) == "00000002"
    rows = read_compacted_hours(spark, raw, store)
    assert _texts(rows) == want
    assert [(r.since, r.until, r.objects, r.files, r.events) for r in
            manifest(spark, store).orderBy("version").collect()] == [
        ("", "2024010109", 6, 1, 6), ("2024010109", "2024010201", 12, 1, 12)]

    # nothing more has closed until a later hour shows
    assert compact_archive(spark, raw, store) is None
    _add(spark, raw, [25, 26])
    want = _texts(archive.read_archive_hours(spark, raw))
    assert _texts(read_compacted_hours(spark, raw, store)) == want
    assert compact_archive(spark, raw, store) == "00000003"
    assert _texts(read_compacted_hours(spark, raw, store)) == want


def test_closed_hours_are_not_opened_in_the_archive(spark, tmp_path):
    raw, store = str(tmp_path / "raw"), str(tmp_path / "store")
    _add(spark, raw, [0, 9, 25])
    compact_archive(spark, raw, store)
    rows = read_compacted_hours(spark, raw, store).where(F.col("hour") != "00")
    read = rows.select(F.input_file_name().alias("f")).distinct().collect()
    small = [r.f for r in read if "/raw/" in r.f]
    assert len(small) == 6 and all("hour=01" in f for f in small)
    assert [("hour=09" in r.f) for r in read if "/store/" in r.f] == [True]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan


def test_a_failed_run_is_passed_over_and_replaced(spark, tmp_path):
    raw, store = str(tmp_path / "raw"), str(tmp_path / "store")
    _add(spark, raw, [0, 9])
    want = _texts(archive.read_archive_hours(spark, raw))
    # data without a manifest, and a manifest that was not finished
    archive.archive_batch(spark.createDataFrame([("left over",)], "value string"),
                          f"{store}/data/version=00000001")
    (tmp_path / "store" / "manifest" / "version=00000001").mkdir(parents=True)
    assert _texts(read_compacted_hours(spark, raw, store)) == want
    assert compact_archive(spark, raw, store) == "00000001"
    assert _texts(read_compacted_hours(spark, raw, store)) == want


def test_many_rows_of_an_hour_are_several_files(spark, tmp_path):
    raw, store = str(tmp_path / "raw"), str(tmp_path / "store")
    _add(spark, raw, [0] * 5 + [1])
    compact_archive(spark, raw, store, rows_per_file=10)
    row = manifest(spark, store).first()
    assert (row.objects, row.files, row.events) == (30, 3, 30)


def test_an_archive_without_events(spark, tmp_path):
    raw, store = tmp_path / "raw", str(tmp_path / "store")
    raw.mkdir()
    assert compact_archive(spark, str(raw), store) is None
    assert read_compacted_hours(spark, str(raw), store).count() == 0
