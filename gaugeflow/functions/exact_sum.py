"""Sums of doubles that do not depend on the order of addition, from built-in functions.

A floating sum differs in its last bits with the order in which partitions are added, and
an average that lies on a rounding tie then moves by a whole digit. Here every number is
cut into digits of 28 bits, which is exact; digits are added as integers, which commutes;
and the total is turned into a double once, correctly rounded, as ``math.fsum`` does.

Numbers below 2^84 (1.9e25) are held in steps of 2^-84 (5e-26), finer parts are cut off
number by number, and up to 2^35 numbers can be added. Larger numbers, infinity and NaN
are added as doubles beside the digits. Nulls do not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 28
#: Places of the digits, from the highest to the lowest.
PLACES = [2, 1, 0, -1, -2, -3]
LIMIT = 2.0 ** (BITS * (PLACES[0] + 1))


def _names(column: str) -> list[str]:
    return [f"_{column}_digit{i}" for i in range(len(PLACES))]


def _beyond(column: str) -> str:
    return f"_{column}_beyond"


def digit_names(column: str) -> list[str]:
    """The columns that ``with_digits`` adds and ``digit_sums`` adds up."""
    return [*_names(column), _beyond(column)]


def with_digits(rows: DataFrame, column: str) -> DataFrame:
    """Add the digits of a double column; each step takes one digit off what is left."""
    inside, rest = F.abs(column) < F.lit(LIMIT), f"_{column}_rest"
    rows = rows.withColumns({
        rest: F.when(inside, F.col(column)).when(F.col(column).isNotNull(), F.lit(0.0)),
        _beyond(column): F.when(~inside, F.col(column))})
    for name, place in zip(_names(column), PLACES):
        scale = 2.0 ** (BITS * place)
        rows = rows.withColumn(name, (F.col(rest) * F.lit(1 / scale)).cast("long"))
        rows = rows.withColumn(rest, F.col(rest) - F.col(name) * F.lit(scale))
    return rows.drop(rest)


def digit_sums(column: str) -> list[Column]:
    """Aggregates of the digits under the same names, so they can be added up again."""
    return [F.sum(name).alias(name) for name in digit_names(column)]


def exact_total(column: str) -> Column:
    """The sum as a double, from the added digits; null where no number was added."""
    low_first = f"array({', '.join(reversed(_names(column)))})"
    # what is carried out of the highest place has the sign of the whole
    top = (f"aggregate({low_first}, 0L, (carry, d) -> shiftright(carry + d, {BITS}))")
    weights = ", ".join(f"double({2.0 ** (BITS * p)!r})" for p in [PLACES[0] + 1, *PLACES])
    text = f"""aggregate(
      array(named_struct('sign', if({top} < 0, -1L, 1L))),
      double(null),
      (ignored, s) -> aggregate(
        zip_with(
          aggregate(
            transform({low_first}, d -> d * s.sign),
            named_struct('carry', 0L, 'digits', cast(array() AS array<bigint>)),
            (a, d) -> named_struct('carry', shiftright(a.carry + d, {BITS}),
                                   'digits', concat(array((a.carry + d) & {(1 << BITS) - 1}L), a.digits)),
            a -> concat(array(a.carry), a.digits)),
          array({weights}), (d, w) -> d * w),
        named_struct('high', 0D, 'low', 0D, 'more', false),
        (a, p) -> if(a.low = 0,
          named_struct('high', a.high + p, 'low', p - ((a.high + p) - a.high), 'more', false),
          named_struct('high', a.high, 'low', a.low, 'more', a.more OR p > 0)),
        a -> s.sign * if(a.more AND a.low > 0 AND (a.high + 2 * a.low) - a.high = 2 * a.low,
                         a.high + 2 * a.low, a.high)))"""
    beyond = F.col(_beyond(column))
    return F.when(beyond.isNull(), F.expr(text)).otherwise(
        F.coalesce(F.expr(text), F.lit(0.0)) + beyond)
