"""Two decimals of a double, rounded on its exact binary value as C and Python format it.

Spark's own rounding and formatting start from the shortest decimal text of a double, which may lie on a tie where the
value itself doesn't.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.chars import let

_SPLIT = float(2**27 + 1)  # cuts a double into two halves of 26 bits


def _hundredths(value: Column) -> Column:
    """The integer nearest to 100 * value, ties to even, for 0 <= value < 2**40.

    The product is taken exactly, as a double and its rounding error; adding the error to the distance from the tie is
    rounded, but keeps its sign.
    """

    def nearest(x: Column) -> Column:
        wide = x * _SPLIT
        high = wide - (wide - x)
        product = x * 100.0
        error = (high * 100.0 - product) + (x - high) * 100.0
        whole = F.floor(product)
        beyond = ((product - whole) - 0.5) + error
        up = (beyond > 0) | ((beyond == 0) & (whole % 2 == 1))
        return whole + F.when(up, 1).otherwise(0)

    return let(value, nearest)


def two_decimals(value: Column) -> Column:
    return _hundredths(value) / F.lit(100.0)


def two_decimal_text(value: Column) -> Column:
    """As ``two_decimals``, written with exactly two decimals; null stays null."""
    cents = _hundredths(value)
    return let(cents, lambda n: F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0")))
