import math
import random

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.exact_sum import digit_sums, exact_total, with_digits
from gaugeflow.operators.windows import window_aggregates

from data import event, events


def totals(rows, partitions=1):
    return {r.k: r.total for r in with_digits(rows.repartition(partitions, "v"), "v")
            .groupBy("k").agg(*digit_sums("v")).select("k", exact_total("v").alias("total")).collect()}


def test_equals_the_correctly_rounded_sum(spark):
    rng = random.Random(5)
    groups = {}
    for k in range(300):
        scale = rng.choice([1.0, 1e-3, 1e9, 1e18, 1e-9])
        groups[k] = [rng.choice([1, 1, -1]) * round(rng.random() * 100, rng.choice([2, 17])) * scale
                     for _ in range(rng.randint(1, 40))]
    groups |= {1000: [1e16, 1.0, 1e-9], 1001: [2.0 ** 53, 1.0], 1002: [2.0 ** 53, 1.0, 2.0 ** -60],
               1003: [-2.0 ** 53, -1.0, -2.0 ** -60], 1004: [1e20, -1e20, 1e-5], 1005: [0.1] * 10,
               1006: [-0.1, 0.1], 1007: [2.0 ** 83, -1.0, 2.0 ** -80],
               1008: [2.0 ** 53, 3.0, -2.0 ** -70], 1009: [0.0]}
    flat = [(k, v) for k, vs in groups.items() for v in vs]
    rng.shuffle(flat)
    rows = spark.createDataFrame(flat, "k int, v double")
    want = {k: math.fsum(vs) for k, vs in groups.items()}
    for partitions in (1, 7, 50):
        assert totals(rows, partitions) == want


def test_odd_numbers(spark):
    flat = [(1, None), (2, None), (2, 1.5), (3, 1e30), (3, 2.5), (4, math.inf), (4, 1.0),
            (5, math.nan), (5, 1.0), (6, 1e-300)]
    got = totals(spark.createDataFrame(flat, "k int, v double"))
    assert got[1] is None and got[2] == 1.5 and got[3] == 1e30 + 2.5
    assert got[4] == math.inf and math.isnan(got[5]) and got[6] == 0


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_windows_do_not_depend_on_how_rows_are_dealt(spark, partitions):
    rng = random.Random(9)
    rows = [event(f"s{i % 5}", i, rng.random() * 600, round(rng.random() * 100, 2),
                  rng.choice(["temperature", "humidity"]), rng.choice(["a", "b"]))
            for i in range(4000)]
    sums = {}
    for r in rows:
        sums.setdefault(r[0], []).append(r[3])
    dealt = events(spark, rows).repartition(partitions, F.xxhash64("seq", F.lit(partitions)))
    got = {r.sensor_id: r.avg_value for r in window_aggregates(dealt, "1 day", places=None).collect()}
    assert got == {s: math.fsum(v) / len(v) for s, v in sums.items()}
