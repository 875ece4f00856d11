import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from gaugeflow.functions.display import one_decimal
from gaugeflow.functions.rounding import round_exact


def numbers():
    rng = random.Random(5)
    fixed = [2.675, 1.005, 0.125, 0.375, 2.5, -2.675, -0.125, 0.0, 1e17, 1e300, -1e300,
             0.005, 0.015, 1013.25, 1.45, float("inf"), float("-inf")]
    ties = [n / 8 for n in range(-400, 400)] + [n / 1000 for n in range(-5000, 5000, 5)]
    free = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 13) for _ in range(3000)]
    means = [sum(rng.randint(0, 9999) / 100 for _ in range(n)) / n
             for n in (2, 4, 6, 8) for _ in range(500)]
    return fixed + ties + free + means


def test_round_equals_python(spark):
    values = numbers()
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (1, 2, 3):
        got = df.select("x", round_exact(F.col("x"), places).alias("r")).collect()
        wrong = [(r.x, r.r) for r in got
                 if r.r != (round(r.x, places) if abs(r.x) * 10 ** places < 2 ** 52 else r.x)]
        assert not wrong, wrong[:5]


def test_one_decimal_takes_exact_ties_away_from_zero(spark):
    values = [v for v in numbers() if abs(v) < 1e12 and v != 0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", one_decimal(F.col("x")).alias("t")).collect():
        want = Decimal(row.x).quantize(Decimal("0.1"), ROUND_HALF_UP)
        assert row.t == f"{want:.1f}", row


def test_one_decimal_has_no_thousands_separator(spark):
    df = spark.createDataFrame([(1013.25,)], "x double")
    assert df.select(one_decimal(F.col("x")).alias("t")).first().t == "1013.3"
