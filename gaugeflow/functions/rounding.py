"""Rounding that gives the same digits as Python's ``round``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two halves


def round_exact(col: Column, places: int = 2, ties: str = "even") -> Column:
    """Round the exact binary value of a double; exact ties go to even or ``up``.

    ``F.round`` works on the printed decimal form, so 2.675 becomes 2.68 although
    the stored number lies below the tie. Here the scaled value is kept as a sum
    of two doubles (product and its rounding error), which decides every tie.
    """
    scale = float(10 ** places)
    product = col * F.lit(scale)
    spread = col * F.lit(_SPLIT)
    high = spread - (spread - col)
    error = (high * F.lit(scale) - product) + (col - high) * F.lit(scale)
    base = F.floor(product).cast("double")
    beyond = (product - base) - F.lit(0.5)
    tie_up = F.lit(True) if ties == "up" else base % 2 != 0
    up = (beyond > 0) | ((beyond == 0) & (error > 0)) | (
        (beyond == 0) & (error == 0) & tie_up)
    rounded = (base + up.cast("double")) / F.lit(scale)
    # from 2**52 on the scaled value has no fraction left; such numbers stay as they are
    return F.when(F.abs(product) < F.lit(float(2 ** 52)), rounded).otherwise(col)
