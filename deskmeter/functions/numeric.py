"""Rounding and guarded arithmetic.

Three rounding rules are in play and they differ on ties:

* ``round_scaled``  - what the SQL warehouse does: round(x * 10^n) / 10^n, half away from zero
* ``round_even``    - what array libraries do: rint(x * 10^n) / 10^n
* ``round_binary``  - what Python's ``round`` does: the exact binary value decides a tie
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2^27 + 1, splits a double into two exact halves


def round_scaled(x: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.round(x * scale) / scale


def round_even(x: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    return F.rint(x * scale) / scale


def round_binary(x: Column, digits: int) -> Column:
    """Correctly rounded decimal of the double ``x``.

    The product x * 10^n may land exactly on a half although x itself lies beside the
    tie. The product's rounding error (Dekker's two-product) tells on which side.
    """
    scale = float(10 ** digits)
    wide = _SPLITTER * scale
    scale_hi = wide - (wide - scale)
    scale_lo = scale - scale_hi
    product = x * scale
    x_hi = x * _SPLITTER - (x * _SPLITTER - x)
    x_lo = x - x_hi
    error = ((x_hi * scale_hi - product) + x_hi * scale_lo + x_lo * scale_hi) + x_lo * scale_lo
    below = F.floor(product).cast("double")
    part = product - below
    up = (
        (part > 0.5)
        | ((part == 0.5) & (error > 0))
        | ((part == 0.5) & (error == 0) & (below % 2 != 0))
    )
    return (below + up.cast("double")) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division with 0.0 for a zero or missing denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(flag: Column, digits: int = 1) -> Column:
    return round_scaled(F.avg(flag) * 100, digits)
